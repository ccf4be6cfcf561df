"""Integer arithmetic columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(numerator: Column, denominator: Column | int) -> Column:
    """Integer division that stays in `long` (no detour through double)."""
    return F.call_function("div", numerator, F.lit(denominator))


def bucket_of(count: Column, size: int) -> Column:
    """Histogram bucket number of a count; `size` must be positive."""
    if size <= 0:
        raise ValueError("bucket_size must be positive")
    return int_div(count, size)


def pct_of_total(part: Column, total: Column) -> Column:
    """`part / total * 100`, 0 when the total is 0."""
    return F.when(total == 0, F.lit(0.0)).otherwise(part * F.lit(100.0) / total)


def epoch_micros(column: Column, data_type: str) -> Column:
    """Microseconds since 1970 for a timestamp column of the given type.

    A zone-less timestamp is computed from its own fields, so that neither the
    session time zone nor a daylight-saving jump can move it.
    """
    if data_type == "timestamp_ntz":
        day = F.unix_date(column.cast("date")).cast("bigint")
        seconds = F.hour(column) * 3600 + F.minute(column) * 60
        fraction = (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")
        return day * 86_400_000_000 + seconds.cast("bigint") * 1_000_000 + fraction
    if data_type == "timestamp":
        return F.unix_micros(column)
    return column.cast("bigint")
