"""The corpus operators as queries over the given tables, and their DuckDB twins where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import alignment, bpe, fingerprints, kernel_quality, lines, mixing, near_dedup, quality, repeats, secrets, sharding, toxicity, vector_codes
from footfall.llm.common import documents


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def _count(kind: str) -> F.Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def _joined(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", _count("assign"), _count("access"), _count("hex"), _count("random"),
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), n_words=4)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(documents(spark, sf_dir))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(documents(spark, sf_dir))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"), "kept_sha256")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("doc.text", F.lit("")), 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = toxicity.score(docs, toxicity.fit(docs, _labels(spark, sf_dir)))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(documents(spark, sf_dir), _labels(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(documents(spark, sf_dir))


def op11_kernel_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = kernel_quality.rate(documents(spark, sf_dir), _labels(spark, sf_dir))
    return scored.select("doc_id", kernel_quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
    return vector_codes.label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), digests=True).withColumnRenamed("groups", "groups_sha256")


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_near_dedup, op3_bpe, op4_repeats, op5_mixing, op6_line_dedup,
                                   op7_toxicity, op8_sharding, op9_quality, op10_fingerprints, op11_kernel_quality, op12_vector_codes, op13_alignment)}

_WORDS = r"length(regexp_replace(regexp_replace(' ' || coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g'))"

#: Sorts each source by the same hash; the operator finds the threshold by histograms.
_OP5 = rf"""
WITH rows AS (
  SELECT doc_id, source, {_WORDS} AS size, CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15) AS BIGINT) AS h FROM documents
), src AS (
  SELECT source, sum(size) AS s, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM rows GROUP BY source
), weighed AS (SELECT *, [3, 1, 2][(sid - 1) % 3 + 1] AS w FROM src
), levels AS (
  SELECT *, (1.5 * sum(s) OVER () - coalesce(sum(2 * s) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY 2 * s / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (SELECT level FROM levels WHERE 2 * s / w >= level ORDER BY 2 * s / w, sid LIMIT 1
), t AS (SELECT source, s, least(2.0 * s, coalesce(w * (SELECT level FROM final), 2.0 * s))::DOUBLE AS target FROM levels
), sums AS (
  SELECT r.*, t.s, t.target, CASE WHEN t.target >= t.s THEN 1 ELSE 0 END AS base,
    sum(size) OVER (PARTITION BY r.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY r.source, h) AS own
  FROM rows r JOIN t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, s::BIGINT AS source_size, target,
  (size * (base + CASE WHEN upto <= target - base * s OR 2 * (target - base * s - upto + own) >= own AND target - base * s - upto + own >= 0
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sums
"""

_OP6 = r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), doomed AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.*, d.keeper IS NOT NULL AND d.keeper <> l.doc_id AS gone FROM lines l LEFT JOIN doomed d ON l.key = d.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: All pairs that share a shingle, and reachability over the links.
_OP2 = r"""
WITH RECURSIVE told AS (
  SELECT doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS w FROM documents
), words AS (SELECT doc_id, CASE WHEN w = [''] THEN [] ELSE w END AS w FROM told
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN [md5(array_to_string(w[i:i + 3], ' ')) for i in range(1, len(w) - 2)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM sets
), elements AS (SELECT doc_id, unnest(s) AS e FROM sets
), shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * common >= 80 * (x.n + y.n - common)
), steps AS (SELECT u, v FROM links UNION SELECT v, u FROM links
), reach AS (
  SELECT doc_id AS d, doc_id AS r FROM sizes
  UNION
  SELECT d, v FROM reach JOIN steps ON r = u
)
SELECT doc_id, n AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept FROM sizes JOIN reach ON d = doc_id GROUP BY doc_id, n
"""


def _op12(rounds: int = 2) -> str:
    """Every part against every entry, round by round."""
    parts = """
WITH kept AS (
  SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS x FROM kept, range(16) t(p)
), books0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts WHERE vec_id IN (SELECT DISTINCT vec_id FROM kept ORDER BY vec_id LIMIT 64)
)"""
    for k in range(rounds + 1):
        parts += f""", near{k} AS MATERIALIZED (
  SELECT vec_id, p, x, min(struct_pack(d := CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x, c)]) AS BIGINT), e := e)) AS best
  FROM parts JOIN books{k} USING (p) GROUP BY vec_id, p, x)"""
        if k < rounds:
            parts += f""", sums{k} AS (
  SELECT p, e, list(total ORDER BY i) AS c FROM (
    SELECT p, best.e AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS total FROM near{k}, range(1, 1 + (SELECT max(len(x)) FROM parts)) t(i) GROUP BY ALL) GROUP BY p, e
), books{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(s.c, b.c) AS c FROM books{k} b LEFT JOIN sums{k} s USING (p, e))"""
    return parts + f""", coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id
), own AS (SELECT vec_id, label, code, error FROM coded JOIN kept USING (vec_id))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM books{rounds}) AS codebooks_sha256
FROM own
"""


ORACLE = {"op2_near_dedup": _OP2, "op5_mixing": _OP5, "op6_line_dedup": _OP6, "op12_vector_codes": _op12()}
