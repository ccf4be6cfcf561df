import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from bitextloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A frame of (row_id, text) from a list."""

    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "row_id bigint, text string")

    return make


@pytest.fixture
def numbered_files(spark, tmp_path):
    """Rows 0..99 over several parquet files whose sorted order is the row order, one file empty."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "numbered"
    folder.mkdir()
    start = 0
    for file, rows in enumerate((30, 0, 1, 44, 25)):
        ids = list(range(start, start + rows))
        table = pa.table({"n": pa.array(ids, pa.int64()), "en_text": pa.array([f"text {i}" for i in ids], pa.string())})
        pq.write_table(table, folder / f"part-{file:03d}.parquet", row_group_size=10)
        start += rows
    return str(folder)
