"""Checked queries: enrichment, resume, sinks, incremental runs and whole plans.

Queries that write use fresh folders below the shared folder and return what
they read back.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from bitextloom.catalog.registry import CLASSED, EDGE, SPECIAL, TOKENS, documents, edge_documents, query, table
from bitextloom.catalog.reports import SUMMARY
from bitextloom.catalog.scans import JSON_TEXT, one_row, write_json_lines
from bitextloom.functions.rates import Limits, resolve_limits
from bitextloom.functions.shards import next_shard_id, shard_number
from bitextloom.operators.backends import FaultyBackend, PrefixBackend
from bitextloom.operators.enrich import (
    enrich_report,
    enrich_text,
    enrich_to_table,
    hybrid_enrich,
    rate_budgeted_enrich,
)
from bitextloom.operators.resume import existing_rows, pending_ranges, reassemble_in_order, resume_pending
from bitextloom.plans import (
    filter_corpus,
    profile_corpus,
    profile_frame,
    translate_corpus,
    translate_pending,
    translation_progress,
    translator,
)
from bitextloom.session import scoped_conf, scratch_path
from bitextloom.sinks import reshard_for_publish, shard_manifest, write_by_rows, write_by_size, write_ordered
from bitextloom.sources import StateLog, expand_paths, global_ordinal, is_directory, list_files, stream_jsonl
from bitextloom.sources.paths import remove, rename
from bitextloom.streaming import (
    incremental_enrich,
    incremental_filter,
    live_progress,
    process_appended,
    read_new_files,
    run_state,
    wait_for_stop,
)

# Rows of a file that a query writes for itself, so that files are as many tasks however large the table is.
FILE_ROWS = 20_000
BLANK = "coalesce(text, '') = ''"
PAIR = f"coalesce(text, '') AS text_en, CASE WHEN {BLANK} THEN '' ELSE '[ja] ' || text END AS text_ja"


@query(
    "enrich_text",
    f"""WITH {EDGE} SELECT doc_id, {PAIR}, CASE WHEN {BLANK} THEN 'blank' ELSE 'ok' END AS status,
        CAST(NULL AS VARCHAR) AS error, CASE WHEN {BLANK} THEN 0 ELSE 1 END AS attempts FROM edge""",
)
def enrich_text_query(spark, sf_dir):
    return enrich_text(edge_documents(spark, sf_dir), PrefixBackend(), "doc_id")


FAULTS = FaultyBackend(faults=(("<|endoftext|>", -1), ("<|reserved_201087|>", 2)))


@query(
    "enrich_with_retries",
    f"""WITH {EDGE}, f AS (SELECT *, CASE WHEN {BLANK} THEN 'blank' WHEN contains(text, '<|endoftext|>') THEN 'error' ELSE 'ok' END AS status FROM edge)
        SELECT doc_id, CASE WHEN status = 'error' THEN '' ELSE coalesce(text, '') END AS text_en,
          CASE WHEN status = 'ok' THEN '[ja] ' || text ELSE '' END AS text_ja, status,
          CASE WHEN status = 'error' THEN 'model error' END AS error,
          CASE WHEN status = 'blank' THEN 0 WHEN status = 'error' OR contains(text, '<|reserved_201087|>') THEN 3 ELSE 1 END AS attempts
        FROM f""",
)
def enrich_with_retries_query(spark, sf_dir):
    """Texts with one mark always fail, with another they succeed at the third try."""
    return enrich_text(edge_documents(spark, sf_dir), FAULTS, "doc_id", retry_step=0.0)


HYBRID = [PrefixBackend("gpt-oss", 4), PrefixBackend("openai-api", 4, prefix="[api] ")]


@query(
    "hybrid_enrich",
    f"""WITH {EDGE} SELECT doc_id, coalesce(text, '') AS text_en, coalesce(text, '') AS translated,
        CASE WHEN {BLANK} THEN 'blank' ELSE 'ok' END AS status, NOT ({BLANK}) AS by_a_backend FROM edge""",
)
def hybrid_enrich_query(spark, sf_dir):
    """Which backend takes a row is a matter of speed; each row has the answer of the one it names."""
    both = hybrid_enrich(edge_documents(spark, sf_dir), HYBRID, "doc_id")
    mark = F.when(F.col("backend") == "gpt-oss", "[ja] ").when(F.col("backend") == "openai-api", "[api] ").otherwise("")
    own = F.when(F.startswith("text_ja", mark), F.substring(F.col("text_ja"), F.length(mark) + 1, F.length("text_ja")))
    return both.select("doc_id", "text_en", own.alias("translated"), "status", F.col("backend").isNotNull().alias("by_a_backend"))


@query("rate_budgeted_enrich", "SELECT doc_id, text AS text_en, '[ja] ' || text AS text_ja FROM documents")
def rate_budgeted_enrich_query(spark, sf_dir):
    """A budget that grows with the table, so that the check itself need not wait."""
    rows = documents(spark, sf_dir)
    limits = Limits(rpm=60 * rows.count(), tpm=resolve_limits("5").tpm * rows.count())
    return rate_budgeted_enrich(rows, PrefixBackend(), limits, "doc_id").select("doc_id", "text_en", "text_ja")


@query(
    "enrich_report",
    f"""WITH {EDGE} SELECT CASE WHEN {BLANK} THEN 'blank' WHEN contains(text, '<|endoftext|>') THEN 'error' ELSE 'ok' END AS status,
        count(*) AS rows FROM edge GROUP BY 1""",
)
def enrich_report_query(spark, sf_dir):
    """Counted on the stored result: the model is not called again."""
    enriched = enrich_text(edge_documents(spark, sf_dir), FAULTS, "doc_id", retry_step=0.0)
    return enrich_report(enrich_to_table(enriched, scratch_path(spark, "enriched")))


@query(
    "reassemble_in_order",
    f"""WITH {EDGE} SELECT doc_id, lang, text, CASE WHEN {BLANK} THEN NULL ELSE '[ja] ' || text END AS text_ja
        FROM edge""",
)
def reassemble_in_order_query(spark, sf_dir):
    source = edge_documents(spark, sf_dir).drop("source")
    results = enrich_text(source.where("coalesce(text, '') <> ''"), PrefixBackend(), "doc_id").select("doc_id", "text_ja")
    return reassemble_in_order(source, results, "doc_id")


@query("resume_pending", "SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending_query(spark, sf_dir):
    """Labelled documents count as done."""
    source = documents(spark, sf_dir).select("doc_id", "text")
    return resume_pending(source, table(spark, sf_dir, "labels"), "doc_id")


@query("translate_pending", f"WITH {EDGE} SELECT doc_id, {PAIR} FROM edge")
def translate_pending_query(spark, sf_dir):
    """A first run does the labelled documents, a second the rest, a third nothing."""
    source, out = edge_documents(spark, sf_dir), scratch_path(spark, "pending")
    translate = translator(PrefixBackend(), key="doc_id")
    first = source.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    for rows in (first, source, source):
        stored = translate_pending(rows, out, translate, "doc_id")
    return stored.select("doc_id", "text_en", "text_ja")


@query("existing_rows", "SELECT count(*) AS row_count, true AS several_shards FROM documents")
def existing_rows_query(spark, sf_dir):
    rows, out = documents(spark, sf_dir).select("text"), scratch_path(spark, "shards")
    write_by_rows(rows, out, rows.count() // 4)
    shards = existing_rows(spark, out, "part")
    return shards.agg(F.sum("rows").alias("row_count"), (F.count("*") > 1).alias("several_shards"))


@query(
    "next_shard_id",
    """WITH names AS (SELECT source, CASE doc_id % 3 WHEN 0 THEN printf('%s-%05d.parquet', source, doc_id)
             WHEN 1 THEN source || '-x' || doc_id || '.parquet' ELSE printf('%s-%05d.json', source, doc_id) END AS name FROM documents)
       SELECT source, coalesce(max(TRY_CAST(nullif(regexp_extract(name, '^.*-([0-9]+)[.]parquet$', 1), '') AS BIGINT)) + 1, 0) AS next_id
       FROM names GROUP BY source""",
)
def next_shard_id_query(spark, sf_dir):
    """Shard names per source; a third fit, the others have no number or another ending."""
    number = F.col("doc_id")
    name = (
        F.when(number % 3 == 0, F.format_string("%s-%05d.parquet", "source", "doc_id"))
        .when(number % 3 == 1, F.concat("source", F.lit("-x"), number.cast("string"), F.lit(".parquet")))
        .otherwise(F.format_string("%s-%05d.json", "source", "doc_id"))
    )
    names = documents(spark, sf_dir).select("source", name.alias("name"))
    return names.groupBy("source").agg(next_shard_id(shard_number(F.col("name"))).alias("next_id"))


def write_tenths(spark, sf_dir, label):
    """The table as shards of a tenth of its rows, in row order."""
    out, numbered = scratch_path(spark, label), global_ordinal(documents(spark, sf_dir))
    total = numbered.count()
    write_by_rows(numbered, out, -(-total // 10), "ordinal", total)
    return out


TENTHS = """t AS (SELECT (count(*) + 9) // 10 AS size, count(*) AS total FROM documents)"""


@query(
    "write_by_rows",
    f"WITH {TENTHS} SELECT size AS rows_per_shard, (total + size - 1) // size AS shards, total AS row_count FROM t",
)
def write_by_rows_query(spark, sf_dir):
    """Shards hold exactly the wanted number of consecutive rows, the last one the rest."""
    stored = shard_manifest(spark, write_tenths(spark, sf_dir, "by-rows"), "shard")
    return stored.agg(
        F.max("rows").alias("rows_per_shard"), F.count("*").alias("shards"), F.sum("rows").alias("row_count")
    )


@query(
    "write_by_size",
    f"""WITH {EDGE} SELECT doc_id, text, true AS several_shards, true AS sized
        FROM edge WHERE text IS NOT NULL AND {TOKENS} < 512""",
)
def write_by_size_query(spark, sf_dir):
    """A limit of a quarter of what the rows take up when stored: several shards, none above it."""
    rows = edge_documents(spark, sf_dir).where(f"text IS NOT NULL AND octet_length(text) < {512 * 3}")
    source, out = scratch_path(spark, "by-size-source"), scratch_path(spark, "by-size")
    rows.repartition(16).write.option("compression", "zstd").parquet(source)
    limit = list_files(spark, source, "*.parquet").agg(F.sum("bytes")).first()[0] // 4
    write_by_size(spark.read.parquet(source), out, limit / 2**20)
    shards = shard_manifest(spark, out).agg(F.count("*").alias("n"), F.max("bytes").alias("largest")).first()
    flags = F.lit(shards["n"] > 2).alias("several_shards"), F.lit(shards["largest"] <= limit).alias("sized")
    return spark.read.parquet(out).select("doc_id", "text", *flags)


@query(
    "pending_ranges",
    """WITH n AS (SELECT 30 * count(*) AS total FROM documents),
       done AS (SELECT doc_id * 37 % total AS first, doc_id * 37 % total + n_chars % 40 AS last FROM documents, n),
       open AS (SELECT pos FROM (SELECT unnest(generate_series(0, (SELECT total - 1 FROM n))) AS pos)
                WHERE NOT EXISTS (SELECT 1 FROM done WHERE pos >= first AND pos < last)),
       runs AS (SELECT pos, pos - row_number() OVER (ORDER BY pos) AS run FROM open),
       cut AS (SELECT pos, run, (pos - min(pos) OVER (PARTITION BY run)) // 25 AS piece FROM runs)
       SELECT min(pos) AS first, max(pos) + 1 AS last FROM cut GROUP BY run, piece""",
)
def pending_ranges_query(spark, sf_dir):
    """What overlapping done ranges leave of thirty positions a document, in pieces of 25 at most."""
    rows = documents(spark, sf_dir)
    total = 30 * rows.count()
    first = F.col("doc_id") * 37 % total
    return pending_ranges(rows.select(first.alias("first"), (first + F.col("n_chars") % 40).alias("last")), total, 25)


@query(
    "shard_manifest",
    f"""WITH {TENTHS}, n AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // (SELECT size FROM t) AS shard_id FROM documents)
       SELECT shard_id + 7 AS shard_id, printf('corpus-%05d.parquet', shard_id + 7) AS shard, count(*) AS rows FROM n GROUP BY shard_id""",
)
def shard_manifest_query(spark, sf_dir):
    """Numbering continues after seven earlier shards, in row order."""
    out = write_tenths(spark, sf_dir, "manifest")
    return shard_manifest(spark, out, "corpus", start_id=7).select("shard_id", "shard", "rows")


@query("ordered_output", "SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) - 1 AS ordinal FROM documents")
def ordered_output_query(spark, sf_dir):
    """The table written back to front: read in file order, rows stand reversed."""
    numbered = global_ordinal(documents(spark, sf_dir))
    rows = numbered.count()
    out = scratch_path(spark, "ordered")
    write_ordered(numbered.withColumn("place", F.lit(rows - 1) - F.col("ordinal")), out, "place", total_rows=rows, files=5)
    return global_ordinal(spark.read.parquet(out).drop("ordinal")).select("doc_id", "ordinal")


@query("sort_inputs", "SELECT lang, dense_rank() OVER (ORDER BY lang) AS place FROM documents GROUP BY lang")
def sort_inputs_query(spark, sf_dir):
    """Folders of the listed files, placed by path order."""
    root = scratch_path(spark, "sorted")
    documents(spark, sf_dir).select("doc_id", "lang").write.partitionBy("lang").parquet(root)
    folders = list_files(spark, root, "*.parquet").select(F.regexp_extract("path", "lang=([^/]*)/", 1).alias("lang")).distinct()
    return folders.select("lang", F.row_number().over(Window.orderBy("lang")).cast("bigint").alias("place"))


@query(
    "write_state",
    """SELECT count(*) AS processed, count(*) AS written, 3::BIGINT AS shard_id, 2::BIGINT AS version
       FROM documents""",
)
def write_state_query(spark, sf_dir):
    """Three saves; the newest holds."""
    log, rows = StateLog(spark, scratch_path(spark, "state")), documents(spark, sf_dir).count()
    for shard, part in enumerate((rows // 3, rows // 2, rows), start=1):
        log.append(processed=part, written=part, shard_id=shard)
    newest = log.latest()
    return log.read().where(F.col("version") == newest["version"]).drop("updated_at")


REPORT = f"""WITH {CLASSED}, s AS (SELECT {SUMMARY} FROM counted),
  b AS (SELECT n // 200 AS bucket, count(*) AS cnt FROM counted GROUP BY 1),
  bars AS (SELECT g.bucket, coalesce(cnt, 0) AS cnt, (SELECT count(*) FROM counted) AS total
           FROM (SELECT unnest(generate_series(0, (SELECT max(bucket) FROM b))) AS bucket) g LEFT JOIN b USING (bucket))
SELECT place, line FROM (
  SELECT 1 AS place, 'samples: ' || samples AS line FROM s
  UNION ALL SELECT 2, 'missing_text: ' || missing_text FROM s
  UNION ALL SELECT 3, 'empty_text: ' || empty_text FROM s
  UNION ALL SELECT 4, 'skipped_special: ' || skipped_special FROM s
  UNION ALL SELECT 5, printf('min: %d max: %d mean: %.2f', min_tokens, max_tokens, mean_tokens) FROM s
  UNION ALL SELECT 6, printf('p50: %.1f p90: %.1f p95: %.1f p99: %.1f', p50, p90, p95, p99) FROM s
  UNION ALL SELECT 7, 'histogram:' FROM s
  UNION ALL SELECT CAST(8 + bucket AS INTEGER), lpad(CAST(bucket * 200 AS VARCHAR), 6, ' ') || '-' || rpad(CAST(bucket * 200 + 199 AS VARCHAR), 6, ' ')
    || ' ' || lpad(CAST(cnt AS VARCHAR), 6, ' ') || ' (' || lpad(printf('%.1f', 100.0::DOUBLE * cnt / total), 5, ' ') || '%)' FROM bars)"""


@query("print_report", REPORT)
def print_report_query(spark, sf_dir):
    """Every line of the text report, in order."""
    text = profile_frame(edge_documents(spark, sf_dir)).report()
    return spark.createDataFrame(list(enumerate(text.split("\n"), 1)), "place int, line string")


@query(
    "reshard_for_publish",
    """SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, text, true AS several_shards, true AS sized
       FROM documents""",
)
def reshard_for_publish_query(spark, sf_dir):
    """Shards of at most an eighth of the stored bytes hold the rows in input order."""
    source, out = f"{sf_dir}/documents.parquet", scratch_path(spark, "publish")
    stored = list_files(spark, source).agg(F.sum("bytes")).first()[0]
    manifest = reshard_for_publish(spark, source, out, "train", stored // 8)
    shards = manifest.agg(F.count("*").alias("n"), F.max("bytes").alias("largest")).first()
    flags = F.lit(shards["n"] >= 8).alias("several_shards"), F.lit(shards["largest"] <= stored // 8).alias("sized")
    return global_ordinal(spark.read.parquet(f"{out}/train")).select("doc_id", "ordinal", "text", *flags)


def document_stream(spark, sf_dir):
    path = f"{sf_dir}/documents.parquet"
    schema = "doc_id bigint, text string, lang string"
    if is_directory(spark, path):
        return read_new_files(spark, path, schema)
    return read_new_files(spark, sf_dir, schema, "documents.parquet")


@query("incremental_enrich", "SELECT doc_id, text AS text_en, '[ja] ' || text AS text_ja, 'ok' AS status FROM documents")
def incremental_enrich_query(spark, sf_dir):
    """Two runs on one checkpoint: the second finds nothing new."""
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-mark")
    state = StateLog(spark, scratch_path(spark, "stream-state"))
    for _ in range(2):
        stream = document_stream(spark, sf_dir)
        incremental_enrich(stream, PrefixBackend(), out, checkpoint, "doc_id", state=state).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "text_en", "text_ja", "status")


@query("incremental_filter", f"SELECT doc_id, text AS en_text FROM documents WHERE NOT {SPECIAL} AND {TOKENS} < 512")
def incremental_filter_query(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "stream-kept"), scratch_path(spark, "stream-mark")
    for _ in range(2):
        incremental_filter(document_stream(spark, sf_dir), out, checkpoint, keep=("doc_id",)).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "en_text")


@query(
    "incremental_filter_jsonl",
    f"""WITH j AS (SELECT doc_id, {JSON_TEXT} AS text FROM documents)
        SELECT doc_id, text AS en_text FROM j WHERE text IS NOT NULL AND NOT {SPECIAL} AND {TOKENS} < 512""",
)
def incremental_filter_jsonl_query(spark, sf_dir):
    """JSON lines in two deliveries; the second run reads only the second."""
    out, checkpoint = scratch_path(spark, "stream-kept"), scratch_path(spark, "stream-mark")
    folder = write_json_lines(spark, sf_dir, "delivered", "doc_id % 2 = 0", gzip=True)
    for later in (None, "doc_id % 2 = 1"):
        if later:
            write_json_lines(spark, sf_dir, "delivered", later, path=folder)
        stream = stream_jsonl(spark, folder, keep="doc_id bigint", pattern="*.txt*")
        incremental_filter(stream, out, checkpoint, keep=("doc_id",)).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "en_text")


@query(
    "live_progress",
    f"""SELECT count(*) AS processed, count(*) FILTER (WHERE text IS NULL) AS skipped, count(*) FILTER (WHERE {SPECIAL}) AS skipped_special,
        count(*) FILTER (WHERE NOT {SPECIAL} AND {TOKENS} < 512) AS kept FROM documents""",
)
def live_progress_query(spark, sf_dir):
    """One batch per file and fewer batches kept by Spark than there are."""
    source, progress = scratch_path(spark, "stream-source"), scratch_path(spark, "stream-progress")
    documents(spark, sf_dir).select("doc_id", "text").repartition(6).write.parquet(source)
    with scoped_conf(spark, spark__sql__streaming__numRecentProgressUpdates="2"):
        stream = read_new_files(spark, source, "doc_id bigint, text string", files_per_batch=1)
        out, mark = scratch_path(spark, "stream-kept"), scratch_path(spark, "stream-mark")
        incremental_filter(stream, out, mark, progress=progress).awaitTermination()
    seen = live_progress(spark, progress)
    return seen.agg(*(F.sum(name).alias(name) for name in ("processed", "skipped", "skipped_special", "kept")))


def put_lines(spark, rows, folder, name, files):
    """Rows, dealt over so many JSON-lines files of `folder` and in each in the order of their ids, in the place of what was there."""
    staged, place = scratch_path(spark, "line-files"), F.pmod(F.xxhash64("doc_id"), F.lit(files)).cast("int")
    dealt = rows.withColumn("place", place).repartitionById(files, "place").sortWithinPartitions("place", "doc_id", "text")
    dealt.write.partitionBy("place").option("ignoreNullFields", False).json(staged)
    for file in list_files(spark, staged, "part-*").select("path").toLocalIterator():
        target = f"{folder}/{name}-{file['path'].split('place=')[1].split('/')[0]}.json"
        remove(spark, target)
        rename(spark, file["path"], target)


@query("appended_lines", "SELECT doc_id, text, CAST(CASE WHEN doc_id % 4 = 3 THEN 1 ELSE 0 END AS BIGINT) AS run FROM documents")
def appended_lines_query(spark, sf_dir):
    """Files, of which half have grown before the second run, which takes what was appended and nothing else."""
    rows, folder = documents(spark, sf_dir).select("doc_id", "text"), scratch_path(spark, "growing")
    out, state = scratch_path(spark, "appended"), scratch_path(spark, "appended-state")
    late = F.when(F.col("doc_id") % 4 == 3, F.col("doc_id") + 10**12).otherwise(F.col("doc_id"))
    rows.limit(0).write.parquet(folder)
    files = max(1, -(-rows.count() // FILE_ROWS))
    put_lines(spark, rows.where("doc_id % 4 = 0"), folder, "a", files)
    put_lines(spark, rows.where("doc_id % 4 IN (1, 2)"), folder, "b", files)

    def parse(lines):
        return lines.select(F.from_json("value", "doc_id bigint, text string").alias("r")).select("r.*")

    process_appended(spark, folder, out, state, parse)
    put_lines(spark, rows.where("doc_id % 4 > 0").withColumn("doc_id", late), folder, "b", files)
    process_appended(spark, folder, out, state, parse)
    taken = spark.read.parquet(out)
    return taken.select((F.col("doc_id") % 10**12).alias("doc_id"), "text", F.col("run").cast("bigint").alias("run"))


@query(
    "run_state",
    """SELECT false AS alive, 4::BIGINT AS files_done, 0::BIGINT AS files_in_flight, 2::BIGINT AS files_pending,
        count(*) AS rows_done, 0::BIGINT AS rows_in_flight, count(*) FILTER (WHERE doc_id % 5 = 0) AS rows_pending FROM documents""",
)
def run_state_query(spark, sf_dir):
    """A watched run over four files of the table, and two files that came after it."""
    source, watch = scratch_path(spark, "watched-source"), scratch_path(spark, "watch")
    rows = documents(spark, sf_dir).select("doc_id", "text")
    rows.repartition(4).write.parquet(source)
    stream = read_new_files(spark, source, "doc_id bigint, text string", files_per_batch=2)
    incremental_filter(stream, scratch_path(spark, "watched-kept"), scratch_path(spark, "watched-mark"), watch=watch).awaitTermination()
    wait_for_stop(spark, watch)
    rows.where("doc_id % 5 = 0").repartition(2).write.mode("append").parquet(source)
    return run_state(spark, watch, source)


@query(
    "filter_corpus",
    f"""SELECT count(*) AS processed, count(*) FILTER (WHERE {SPECIAL}) AS skipped_special,
        count(*) FILTER (WHERE NOT {SPECIAL} AND {TOKENS} < 512) AS kept, count(*) FILTER (WHERE NOT {SPECIAL} AND {TOKENS} < 512) AS stored FROM documents""",
)
def filter_corpus_query(spark, sf_dir):
    """Parquet to filtered parquet in one scan; counters are observed while writing."""
    out = scratch_path(spark, "filtered")
    seen = filter_corpus(spark, f"{sf_dir}/documents.parquet", out)
    stored = spark.read.parquet(out).count()
    counters = {name: seen[name] for name in ("processed", "skipped_special", "kept")}
    return one_row(spark, **counters, stored=stored)


@query("profile_corpus", f"WITH {CLASSED} SELECT {SUMMARY} FROM counted")
def profile_corpus_query(spark, sf_dir):
    """Files found by a pattern, their format by its spelling, under a cap that all rows fit in."""
    source = scratch_path(spark, "profiled")
    rows = edge_documents(spark, sf_dir).select("text")
    total = rows.count()
    rows.repartition(max(3, -(-total // FILE_ROWS))).write.parquet(source)
    return profile_corpus(spark, f"{source}/*.parquet", max_samples=total).summary


@query(
    "translate_corpus",
    f"""WITH {EDGE}, f AS (SELECT *, contains(coalesce(text, ''), '<|endoftext|>') AS failed FROM edge)
        SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, CASE WHEN failed THEN '' ELSE coalesce(text, '') END AS en,
          CASE WHEN failed OR {BLANK} THEN '' ELSE '[ja] ' || text END AS ja, 'en,ja' AS stored_columns,
          count(*) FILTER (WHERE failed) OVER () AS errors FROM f""",
)
def translate_corpus_query(spark, sf_dir):
    """A source of several files, one of them empty, stopped after part of the rows and started again; some rows fail."""
    source, out, state = (scratch_path(spark, label) for label in ("sources", "pairs", "progress"))
    rows = documents(spark, sf_dir).count()
    numbered = edge_documents(spark, sf_dir).join(global_ordinal(documents(spark, sf_dir)).select("doc_id", "ordinal"), "doc_id")
    halves = ((0, rows // 3), (rows // 3, rows // 3), (rows // 3, rows))
    for name, (first, last) in zip(("a b", "b", "é"), halves):
        part = numbered.where(F.col("ordinal").between(first, last - 1)).select((F.col("ordinal") - first).alias("ordinal"), "text")
        write_ordered(part, f"{source}/{name}", total_rows=last - first, files=max(2, -(-(last - first) // FILE_ROWS)), keep_ordinal=False)
    names = {"input_column": "text", "source_name": "en", "target_name": "ja"}
    translate = lambda rows: enrich_text(rows, FAULTS, "ordinal", retry_step=0.0)
    for cap in (rows // 4, -1):
        translate_corpus(
            spark, f"{source}/*/*.parquet", out, translate, state, max_samples=cap, slice_rows=-(-rows // 3), **names
        )
    stored = spark.read.parquet(*expand_paths(spark, f"{out}/slice=*/*.parquet"))
    errors = translation_progress(spark, state).first()["errors"]
    columns = F.lit(",".join(stored.columns))
    return global_ordinal(stored).select("ordinal", "en", "ja", columns.alias("stored_columns"), F.lit(errors).cast("bigint").alias("errors"))
