"""One query per corpus operator over its whole table, with production parameters, next to its SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitextloom.llm.conversation_repair import repair_conversations
from bitextloom.llm.embedding_dedup import vector_groups
from bitextloom.llm.exact_dedup import exact_groups
from bitextloom.llm.license_scan import TEMPLATES, scan_licenses
from bitextloom.llm.line_dedup import dedup_lines
from bitextloom.llm.merkle_manifest import merkle_manifest
from bitextloom.llm.minhash_dedup import near_groups
from bitextloom.llm.passage_dedup import repeated_passages
from bitextloom.llm.piece_codec import decode_ids, encode_texts
from bitextloom.llm.source_mix import mix_sources
from bitextloom.llm.suffix_dedup import strip_repeats
from bitextloom.llm.token_count import count_tokens
from bitextloom.llm.toxicity import score_toxicity

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
repeated AS (
  SELECT k, max(doc_id) AS keep_id FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, i, line, keep_id IS NOT NULL AND doc_id <> keep_id AS lost FROM lines LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query("op2_line_dedup", LINES_SQL)
def op2_line_dedup(spark, sf_dir):
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", sha256("text").alias("kept_sha256"))


@query(
    "op4_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op4_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


MIX_SQL = r"""
WITH RECURSIVE quality AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
sizes AS (
  SELECT d.doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
             / 4503599627370496) / (1.0::DOUBLE + coalesce(quality, 0)) AS key
  FROM documents d LEFT JOIN quality q ON d.doc_id = q.doc_id),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM sizes GROUP BY source),
-- Each round caps every source whose share of what is left is above three times its size.
rounds AS (
  SELECT 0 AS n, source, source_size, weight, FALSE AS capped, FALSE AS before FROM sources
  UNION ALL
  SELECT n + 1, source, source_size, weight,
         capped OR weight * left_size / nullif(left_weight, 0) > 3 * source_size, capped
  FROM (SELECT *, (sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE AS left_size,
               sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS left_weight FROM rounds) WHERE n < 40),
last_round AS (SELECT * FROM rounds WHERE n = 40),
targets AS (
  SELECT source, source_size, CASE WHEN capped THEN 3.0::DOUBLE * source_size ELSE
         weight * ((sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE
         / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0)) END AS target FROM last_round),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least(3, floor(target / source_size + 1e-12)) AS BIGINT) ELSE 0 END AS epochs FROM targets),
ordered AS (
  SELECT s.*, source_size, target, epochs, target - epochs * source_size AS budget,
         sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id) AS upto
  FROM sizes s JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target,
       epochs + CAST(budget > 1e-6 AND upto - size / 2.0 <= budget AS BIGINT) AS copies,
       size * (epochs + CAST(budget > 1e-6 AND upto - size / 2.0 <= budget AS BIGINT)) AS taken
FROM ordered"""


def qualities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and quality, the weight of a document in the mix."""
    return table(spark, sf_dir, "labels").groupBy("doc_id").agg((1.0 + F.max("quality")).alias("quality"))


@query("op8_source_mix", MIX_SQL)
def op8_source_mix(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"), qualities(spark, sf_dir))


LICENSE_VALUES = ", ".join("({}, {})".format(*("'" + part.replace("'", "''") + "'" for part in pair)) for pair in TEMPLATES)

LICENSES_SQL = rf"""
WITH normal AS (
  SELECT doc_id, string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10)) AS lines
  FROM documents),
lines AS (
  SELECT doc_id, i - 1 AS i, regexp_extract_all(line, '[0-9a-z\x{{80}}-\x{{10ffff}}]+') AS w
  FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM normal)),
full_lines AS (
  SELECT doc_id, i, w, sum(CASE WHEN len(w) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM lines),
numbered AS (
  SELECT doc_id, i, w, dense_rank() OVER (PARTITION BY doc_id ORDER BY gap) - 1 AS block FROM full_lines WHERE len(w) > 0),
units AS (
  SELECT doc_id, 'line' AS level, i AS position, w FROM numbered
  UNION ALL
  SELECT doc_id, 'block', block, flatten(list(w ORDER BY i)) FROM numbered GROUP BY doc_id, block HAVING count(*) > 1
  UNION ALL
  SELECT doc_id, 'text', 0, flatten(list(w ORDER BY i)) FROM numbered GROUP BY doc_id HAVING count(DISTINCT block) > 1),
grams AS (
  SELECT doc_id, level, position,
         list_distinct(list_transform(generate_series(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1])) AS g FROM units WHERE len(w) > 1),
templates AS (
  SELECT row_number() OVER () AS n, license, list_distinct(list_transform(generate_series(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1])) AS t, len(w) AS m
  FROM (SELECT license, regexp_extract_all(lower(body), '[0-9a-z]+') AS w FROM (VALUES {LICENSE_VALUES}) v(license, body))),
-- Windows of as many words as a template, in texts that have two thirds of its bigrams.
whole AS (
  SELECT doc_id, list_transform(generate_series(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1]) AS b
  FROM (SELECT doc_id, flatten(list(w ORDER BY i)) AS w FROM numbered GROUP BY doc_id) WHERE len(w) > 1),
likely AS (SELECT doc_id, n, license, b, t, m FROM whole, templates WHERE len(b) + 1 > m AND len(list_intersect(b, t)) >= len(t) * 0.66),
windows AS (
  SELECT doc_id, n, license, i, t, m, list_distinct(b[i + 1:i + m - 1]) AS g FROM (SELECT *, unnest(generate_series(0, len(b) + 1 - m)) AS i FROM likely)),
good AS (
  SELECT *, i - lag(i) OVER (PARTITION BY doc_id, n ORDER BY i) AS step
  FROM (SELECT doc_id, n, license, i, m, len(g) AS size, 2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice FROM windows) WHERE dice >= 0.8),
grouped AS (SELECT *, sum(CASE WHEN step <= m THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, n ORDER BY i) AS island FROM good),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, n, island ORDER BY dice DESC, i) AS place FROM grouped)
SELECT doc_id, license, 'window' AS level, CAST(i AS INTEGER) AS position, CAST(size AS INTEGER) AS n_bigrams, dice FROM best WHERE place = 1
UNION ALL
SELECT * FROM (
  SELECT doc_id, license, level, CAST(position AS INTEGER) AS position, CAST(len(g) AS INTEGER) AS n_bigrams,
         2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice
  FROM grams, templates WHERE len(g) BETWEEN len(t) * 0.66 AND len(t) * 1.51)
WHERE dice >= 0.8"""


@query("op1_license_scan", LICENSES_SQL)
def op1_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op3_token_count")
def op3_token_count(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), PIECE_MODEL)


@query("op7_piece_codec")
def op7_piece_codec(spark, sf_dir):
    coded = decode_ids(encode_texts(table(spark, sf_dir, "documents"), PIECE_MODEL), PIECE_MODEL)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        sha256("text").alias("decoded_sha256"),
    )


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
         ELSE list_transform(generate_series(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1]) END) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
-- The rarest fifth of a set and one more must meet that of any set similar enough.
ranked AS (
  SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS r
  FROM shingles JOIN sizes USING (doc_id) JOIN (SELECT s, count(*) AS f FROM shingles GROUP BY s) USING (s)),
starts AS (SELECT doc_id, s, n FROM ranked WHERE r <= n - ceil(0.8 * n) + 1),
candidates AS (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM starts x JOIN starts y ON x.s = y.s AND x.doc_id < y.doc_id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
links AS (
  SELECT a, b FROM candidates JOIN shingles x ON x.doc_id = a JOIN shingles y ON y.doc_id = b AND y.s = x.s
  JOIN sizes na ON na.doc_id = a JOIN sizes nb ON nb.doc_id = b
  GROUP BY a, b, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS node, a AS met FROM both_ways UNION SELECT node, b FROM reach JOIN both_ways ON met = a),
least_of AS (SELECT node, min(met) AS component FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
       coalesce(component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON node = d.doc_id"""


@query("op9_minhash_dedup", NEAR_SQL)
def op9_minhash_dedup(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"), width=2)


VECTORS_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
reach AS (SELECT a AS node, a AS met FROM links UNION SELECT node, b FROM reach JOIN links ON met = a),
least_of AS (SELECT node, min(met) AS component FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts ON a = vec_id LEFT JOIN least_of ON node = vec_id"""


@query("op10_embedding_dedup", VECTORS_SQL)
def op10_embedding_dedup(spark, sf_dir):
    return vector_groups(table(spark, sf_dir, "embeddings"))


@query("op5_passage_dedup")
def op5_passage_dedup(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))


def crc32_sql(value: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    step = "xor(b >> 1, CASE WHEN b & 1 = 1 THEN 3988292384 ELSE 0 END)"
    bits = f"list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda b, y: {step}, xor(a, x))"
    codes = f"list_transform(string_split({value}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda a, x: {bits}, CAST(4294967295 AS BIGINT)), 4294967295)"


def field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


MANIFEST_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, leaf, came FROM (
    SELECT doc_id, source, sha256({" || ".join(map(field_sql, ("doc_id", "source", "lang", "n_chars", "text")))}) AS leaf,
           CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN sha256({" || ".join(map(field_sql, (
               "doc_id", "source", "lang", "n_chars", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")))}) END AS came
    FROM documents)),
inner_nodes AS (
  SELECT 0 AS level, source, place, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT level + 1, source, place // 16, sha256(string_agg(h, '' ORDER BY place)), (n + 15) // 16
  FROM inner_nodes WHERE n > 1 GROUP BY level, source, place // 16, n),
subroots AS (SELECT source, h, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place FROM inner_nodes WHERE n = 1),
outer_nodes AS (
  SELECT 0 AS level, place, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, place // 16, sha256(string_agg(h, '' ORDER BY place)), (n + 15) // 16
  FROM outer_nodes WHERE n > 1 GROUP BY level, place // 16, n),
inner_runs AS (
  SELECT level, coalesce('=' || source, '') AS tree, place // 16 AS run, list(h ORDER BY place) AS hs
  FROM inner_nodes WHERE n > 1 GROUP BY ALL),
outer_runs AS (SELECT level, place // 16 AS run, list(h ORDER BY place) AS hs FROM outer_nodes WHERE n > 1 GROUP BY ALL),
first_fold AS (
  SELECT doc_id, leaf, coalesce('=' || source, '') AS tree, 0 AS level, place, '' AS proof, coalesce(came, leaf) AS f, leaf AS own FROM leaves
  UNION ALL
  SELECT doc_id, leaf, tree, level + 1, place // 16,
         proof || array_to_string(hs[:place % 16], '') || array_to_string(hs[place % 16 + 2:], ''),
         sha256(array_to_string(hs[:place % 16], '') || f || array_to_string(hs[place % 16 + 2:], '')),
         sha256(array_to_string(hs, ''))
  FROM first_fold JOIN inner_runs USING (level, tree) WHERE run = place // 16),
in_source AS (SELECT *, max(level) OVER (PARTITION BY tree) AS last FROM first_fold),
second_fold AS (
  SELECT doc_id, leaf, own AS subroot, 0 AS level, s.place, proof, f
  FROM in_source JOIN subroots s ON tree = coalesce('=' || s.source, '') WHERE level = last
  UNION ALL
  SELECT doc_id, leaf, subroot, level + 1, place // 16,
         proof || array_to_string(hs[:place % 16], '') || array_to_string(hs[place % 16 + 2:], ''),
         sha256(array_to_string(hs[:place % 16], '') || f || array_to_string(hs[place % 16 + 2:], ''))
  FROM second_fold JOIN outer_runs USING (level) WHERE run = place // 16)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM second_fold, (SELECT h AS root, level AS top FROM outer_nodes WHERE n = 1) WHERE level = top"""


def lower_case(column):
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc32(column):
    return F.crc32(column.cast("string").cast("binary"))


@query("op11_merkle_manifest", MANIFEST_SQL)
def op11_merkle_manifest(spark, sf_dir):
    text = F.col("text")
    received = F.when(crc32(F.col("doc_id")) % 5 == 0, lower_case(text)).otherwise(text)
    proofs = merkle_manifest(table(spark, sf_dir, "documents"), received)
    proof = F.sha2(F.array_join("proof", ""), 256)
    return proofs.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with known damage by a hash of conversation and turn: lost, emptied, without stops, said twice, user's."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    turns = turns.withColumn("damage", crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).filter("damage > 0")
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(space("role"))
    times = F.explode(F.when(F.col("damage") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def edit_sql(state: int) -> str:
    """The least (cost, audit) of the edits that take the next row in a grammar state: 0 none yet, 1 s, 2 u, 3 a."""
    kept = {0: "CASE role WHEN 's' THEN {0} WHEN 'u' THEN {1} END", 1: "CASE role WHEN 'u' THEN {1} END",
            2: "CASE role WHEN 'a' THEN {2} END", 3: "CASE role WHEN 'u' THEN {1} END"}[state]
    onward = kept.format(*(f"{{'c': c{s} + cut, 'a': 'K' || a{s}}}" for s in (1, 2, 3)))
    made = 3 if state == 2 else 2
    return f"""least({{'c': c{state} + 2, 'a': 'D' || a{state}}},
      CASE WHEN fault NOT IN (1, 2) THEN {{'c': c{made} + 1 + cut, 'a': 'R' || a{made}}} END, CASE WHEN fault NOT IN (1, 2) THEN {onward} END)"""


def insert_sql(state: int) -> str:
    made = 3 if state == 2 else 2
    return f"least(e{state}, {{'c': e{made}.c + 5, 'a': 'I' || e{made}.a}}) AS e{state}"


INSERTS_SQL = ", ".join(map(insert_sql, range(4)))

REPAIR_SQL = f"""
WITH RECURSIVE hurt AS (
  SELECT conv_id, turn, unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS time,
         CASE WHEN d = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM (SELECT *, {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS d FROM conversations)
  WHERE d > 0),
rows AS (
  SELECT coalesce('=' || conv_id, '') AS conv, turn, role AS full_role, text,
         CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'o' END AS role,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM hurt),
marked AS (
  SELECT *, CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv, full_role, text ORDER BY i) > 1 THEN 2
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(role) OVER (PARTITION BY conv ORDER BY i) AS before FROM rows),
steps AS (SELECT *, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS cut FROM marked),
-- From the last row to the first: for each grammar state the cheapest way to the end.
togo AS (
  SELECT DISTINCT conv, n + 1 AS i, 0::BIGINT AS c0, '' AS a0, 10::BIGINT AS c1, 'II' AS a1, 5::BIGINT AS c2, 'I' AS a2, 0::BIGINT AS c3, '' AS a3 FROM rows
  UNION ALL
  SELECT conv, i, e0.c, e0.a, e1.c, e1.a, e2.c, e2.a, e3.c, e3.a FROM (
    SELECT conv, i, {INSERTS_SQL} FROM (
      SELECT conv, i, {INSERTS_SQL} FROM (
        SELECT conv, s.i, {", ".join(f"{edit_sql(s)} AS e{s}" for s in range(4))}
        FROM togo t JOIN steps s USING (conv) WHERE s.i = t.i - 1)))),
best AS (SELECT conv, c0 AS cost, a0 AS audit FROM togo WHERE i = 1),
-- The edits in order, with the row that each takes and the state that each leaves.
walk AS (
  SELECT conv, audit, 1 AS k, 0 AS i, 0 AS state, '' AS edit FROM best
  UNION ALL
  SELECT conv, audit, k + 1, w.i + CAST(substr(audit, k, 1) <> 'I' AS INTEGER),
         CASE substr(audit, k, 1) WHEN 'D' THEN state WHEN 'K' THEN CASE s.role WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
              ELSE CASE WHEN state = 2 THEN 3 ELSE 2 END END, substr(audit, k, 1)
  FROM walk w LEFT JOIN (SELECT conv, i AS at, role FROM steps) s USING (conv)
  WHERE k <= length(audit) AND (s.at = w.i + 1 OR (s.at = 1 AND w.i = (SELECT max(z.n) FROM rows z WHERE z.conv = w.conv)))),
repaired AS (
  SELECT w.conv, sha256(string_agg(CASE edit WHEN 'K' THEN full_role || ':' || text WHEN 'R' THEN made || ':' || text ELSE made || ':' END, chr(10) ORDER BY k)) AS h
  FROM (SELECT *, CASE WHEN state = 3 THEN 'assistant' ELSE 'user' END AS made FROM walk WHERE edit IN ('K', 'R', 'I')) w
  LEFT JOIN steps s ON s.conv = w.conv AND s.i = w.i AND edit <> 'I' GROUP BY w.conv),
counted AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || role NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS conv FROM conversations)
LEFT JOIN counted USING (conv) LEFT JOIN best USING (conv) LEFT JOIN repaired USING (conv)"""


@query("op12_conversation_repair", REPAIR_SQL)
def op12_conversation_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return repair_conversations(damaged(turns), turns)


SUFFIX_SQL = """
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS b FROM documents),
windows AS (
  SELECT row, i, md5(b[i:i + 399]) AS h FROM (SELECT row, b, unnest(generate_series(1, octet_length(b) - 399)) AS i FROM texts)),
starts AS (SELECT row, i FROM windows JOIN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1) USING (h)),
islands AS (
  SELECT row, i, sum(fresh) OVER (PARTITION BY row ORDER BY i) AS island
  FROM (SELECT row, i, CAST(coalesce(i - lag(i) OVER (PARTITION BY row ORDER BY i) > 400, TRUE) AS INTEGER) AS fresh FROM starts)),
spans AS (SELECT row, min(i) AS a, max(i) + 399 AS z FROM islands GROUP BY row, island),
-- What stays: up to each span from the one before it, and what is behind the last.
pieces AS (
  SELECT row, a, coalesce(lag(z) OVER (PARTITION BY row ORDER BY a), 0) + 1 AS low, a - 1 AS high FROM spans
  UNION ALL SELECT row, max(z) + 1, max(z) + 1, octet_length(any_value(b)) FROM spans JOIN texts USING (row) GROUP BY row),
kept AS (
  SELECT row, unhex(string_agg(CASE WHEN low > high THEN '' ELSE hex(b[low:high]) END, '' ORDER BY a)) AS b FROM pieces JOIN texts USING (row) GROUP BY row),
removed AS (SELECT row, CAST(sum(z - a + 1) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY row)
SELECT doc_id, CAST(octet_length(t.b) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(k.b, t.b)) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (row) LEFT JOIN removed USING (row)"""


@query("op13_suffix_dedup", SUFFIX_SQL)
def op13_suffix_dedup(spark, sf_dir):
    kept = strip_repeats(table(spark, sf_dir, "documents"))
    spans = F.size("spans").cast("long").alias("n_spans")
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed")
    return kept.select("doc_id", "n_bytes", removed, spans, F.sha2("kept", 256).alias("kept_sha256"))
