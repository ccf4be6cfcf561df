"""Small tables with every awkward row: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use themselves.
CLASHING = "kept string, keep_id string, copies string, digest string, rep string, score string, ids string, of string, mix_key string"


def words(rng, count):
    return [rng.choice("aeiou") + "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(count)]


def edge_rows():
    rng = random.Random(5)
    long = " ".join(words(rng, 30_000))
    shared = " ".join(words(rng, 70))
    line = "This very line is held by many of the documents here, word for word."
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t ", None, None, 0), (4, "one", "en", "b", 3),
        (5, "One", "en", "b", 3), (6, long, "en", "b", len(long)), (7, long, "en", None, len(long)),
        (8, "x\n\ny\n", "en", "c", 5), (9, "é ▁ \U0001f642 <s>", "fr", "c", 8), (None, "no id at all", "en", "c", 3),
        (None, None, None, None, None), (10, "\x00 nul", "en", "é", 5),
    ]
    base = words(rng, 120)
    for i in range(20, 32):
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(120)] = "changed"
        rows.append((i, " ".join(copy), "en", "a", 0))
    for i in range(40, 48):
        own = " ".join(words(rng, 60))
        rows.append((i, f"{own}\n{line}\n" + (shared if i % 2 else own[:50]), "en", "d", 0))
        rows.append((i + 20, f"  {line.upper()} \n{own}", "en", "d", 0))
    rows += [(90, "said twice in one row", "en", "a", 1), (90, "said twice in one row", "en", "a", 1)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def clashing(spark):
    names = [c.split()[0] for c in CLASHING.split(", ")]
    return spark.createDataFrame([(*r, *(["other"] * len(names))) for r in edge_rows()], f"{COLUMNS}, {CLASHING}")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def small(spark):
    """A few hundred documents of the smallest tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
