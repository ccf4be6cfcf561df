"""Each stage of the pipeline against a plain version on its own input, and the whole on the smallest tables."""

import hashlib
import struct
import sys
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
from bitextloom.llm.catalog import QUERIES, qualities  # noqa: E402
from bitextloom.llm.source_mix import mix_sources, take_mix  # noqa: E402
from bitextloom.llm.toxicity import drop_toxic, score_toxicity  # noqa: E402

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(TABLES).exists(), reason="no tables")


def plain_exact(rows):
    best = {}
    for r in rows:
        text = r.text or ""
        best[text] = max(best.get(text, -1), r.doc_id)
    return {r.doc_id for r in rows if best[r.text or ""] == r.doc_id}


def plain_near(rows):
    sets = {}
    for r in rows:
        w = (r.text or "").encode().lower().split()
        n = min(5, len(w))
        sets[r.doc_id] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return {i for i in sets if top(i) == i}


def test_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "mix", "encode"]
    documents = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    toxicity, exact, near, mix, encode = (stage for _, stage in corpus_pipeline.STAGES)

    kept = toxicity(spark, documents, TABLES)
    predicted = {r.doc_id: r.predicted for r in score_toxicity(documents, labels).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, p in predicted.items() if not p)
    toxic = {r.doc_id for r in labels.filter("toxic = 0").collect()}
    lost = toxic - {r.doc_id for r in kept.collect()}
    assert len(lost) <= 0.05 * len(toxic)

    texts = exact(spark, documents, TABLES)
    assert sorted(r.doc_id for r in texts.collect()) == sorted(plain_exact(documents.collect()))
    single = near(spark, documents, TABLES)
    assert sorted(r.doc_id for r in single.collect()) == sorted(plain_near(documents.collect()))
    assert kept.columns == texts.columns == single.columns == documents.columns

    mixed = mix(spark, documents, TABLES)
    copies = Counter({r.doc_id: r.copies for r in mix_sources(documents, qualities(spark, TABLES)).collect()})
    assert mixed.columns == documents.columns and Counter(r.doc_id for r in mixed.collect()) == +copies

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for r in documents.collect():
        ids = [1, *library.encode(r.text or ""), 2]
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        want[r.doc_id] = (len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode(spark, documents, TABLES).collect()}
    assert got == want


def test_encode_and_decode_run_one_after_the_other_on_small_batches(spark, small, monkeypatch):
    """Their workers are added to those that earlier stages left: no task has both, and none a batch of thousands of texts."""
    seen, name = [], "spark.sql.execution.arrow.maxRecordsPerBatch"

    def stored(df, label, take=corpus_pipeline.stored):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append((plan.count("MapInArrow"), int(spark.conf.get(name))))
        return take(df, label)

    before = spark.conf.get(name)
    monkeypatch.setattr(corpus_pipeline, "stored", stored)
    encoded = corpus_pipeline.encode(spark, small, TABLES)
    assert encoded.count() == small.count() and spark.conf.get(name) == before
    assert [python for python, _ in seen] == [1, 1] and max(rows for _, rows in seen) <= 256


def test_mix_stage_weighs_by_quality(spark):
    documents = spark.read.parquet(f"{TABLES}/documents.parquet")
    mix = dict(corpus_pipeline.STAGES)["mix"]
    weighed, plain = (Counter({r.doc_id: r.copies for r in rows.collect()}) for rows in (QUERIES["op8_source_mix"](spark, TABLES), mix_sources(documents)))
    assert Counter(r.doc_id for r in mix(spark, documents, TABLES).collect()) == +weighed != +plain


def test_run_is_the_stages_one_after_another(spark):
    rows = corpus_pipeline.run(spark, TABLES).collect()
    per = defaultdict(set)
    for r in rows:
        per[r.doc_id].add(r.ids_sha256)
    assert rows and all(len(v) == 1 for v in per.values())
    assert max(Counter(r.doc_id for r in rows).values()) <= 3


def test_queries_are_registered_once_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


ROWS = "doc_id long, text string, source string, digest string, kept string, row string, id string"


def test_dedup_stages_go_by_id_and_text(spark):
    """One id on rows of several texts, rows without an id, repeated rows, empty texts, clashing columns."""
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word59", "other")
    rows = [(1, "copied"), (1, "unique"), (9, "copied"), (9, base), (9, "alone here"), (2, near), (3, "twice"), (3, "twice"),
            (None, "no id"), (None, "no id"), (None, "copied"), (4, None), (5, ""), (6, " "), (7, base)]
    docs = spark.createDataFrame([(i, t, "s", "d", "k", "r", "x") for i, t in rows], ROWS)
    exact, near_stage = (dict(corpus_pipeline.STAGES)[name] for name in ("exact dedup", "near dedup"))

    def left(stage, docs):
        kept = stage(spark, docs, TABLES)
        assert kept.columns == docs.columns and {tuple(r)[2:] for r in kept.collect()} <= {("s", "d", "k", "r", "x")}
        return sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)

    want = [(1, "unique"), (9, "copied"), (9, base), (9, "alone here"), (2, near), (3, "twice"), (None, "no id"), (5, ""), (6, " ")]
    assert left(exact, docs) == sorted(want, key=str)
    want = [(1, "copied"), (1, "unique"), (9, "alone here"), (2, near), (3, "twice"), (None, "no id"), (None, "copied"), (4, None), (5, ""), (6, " ")]
    assert left(near_stage, docs) == sorted(want, key=str)
    for stage in (exact, near_stage):
        assert left(stage, docs.limit(0)) == []


def test_all_stages_on_awkward_tables(spark, edge, none, clashing):
    """Every stage takes what the one before it left, and gives the columns it was given."""
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").limit(0)
    for docs in (edge, none, clashing):
        for name, stage in corpus_pipeline.STAGES[1:3] + corpus_pipeline.STAGES[4:]:
            kept = stage(spark, docs, TABLES)
            assert (kept.columns == docs.columns) == (name != "encode")
            assert kept.count() <= docs.count()
        assert drop_toxic(docs, labels).columns == docs.columns and drop_toxic(docs, labels).count() == docs.count()
        taken = take_mix(docs)
        assert taken.columns == docs.columns and taken.count() <= 3 * docs.count()
