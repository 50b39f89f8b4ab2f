"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.llm import bitmask_codes, boosted, byte_bpe, chat_tree, hnsw, minhash, packing, personal, phrases, ppm, range_coder, spelling, spotsigs
from lociflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Only op12 has an exact SQL form that is quick on whole tables; the others are tested against brute force instead.
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@_query
def op3_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.kept_words(table(spark, sf_dir, "documents"))


@_query
def op4_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.predictions(table(spark, sf_dir, "documents"))


@_query
def op5_range_coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_coder.read_ids(range_coder.write_ids(table(spark, sf_dir, "documents")))


@_query
def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints_and_edits(table(spark, sf_dir, "documents"))


@_query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), n=2)


@_query
def op8_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], told.schema)
    return chat_tree.format_and_read(told.union(added))


@_query
def op9_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosted.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@_query
def op12_bitmask_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmask_codes.compressed(table(spark, sf_dir, "embeddings"))


@_query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(table(spark, sf_dir, "documents"))


def _codes_sql(parts: int = bitmask_codes.PARTS, entries: int = bitmask_codes.ENTRIES, rounds: int = bitmask_codes.ROUNDS) -> str:
    """Plain comparison with every entry, for vectors of one length."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
away{r} AS MATERIALIZED (
  SELECT c.row_id, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v))::BIGINT AS d
  FROM cells c JOIN book{r} b ON c.part = b.part AND c.pos = b.pos GROUP BY ALL),
near{r} AS MATERIALIZED (
  SELECT row_id, part, entry, d FROM away{r}
  QUALIFY row_number() OVER (PARTITION BY row_id, part ORDER BY d, entry) = 1)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS (
  SELECT part, entry, pos, sum(v)::BIGINT AS s, count(*) AS n FROM cells JOIN near{r} USING (row_id, part) GROUP BY ALL),
book{r + 1} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN m.n IS NULL THEN b.v ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS v
  FROM book{r} b LEFT JOIN mean{r} m USING (part, entry, pos))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row_id, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT row_id, (i - 1) // (len(embedding) // {parts}) AS part, (i - 1) % (len(embedding) // {parts}) AS pos,
    floor(256 * embedding[i]::DOUBLE)::BIGINT AS v
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, row_id - 1 AS entry, pos, v FROM cells WHERE row_id <= {entries}),
{",".join(steps)},
coded AS (
  SELECT row_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY row_id)
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM coded c JOIN kept k USING (row_id)
"""


SQL["op12_bitmask_codes"] = _codes_sql()
