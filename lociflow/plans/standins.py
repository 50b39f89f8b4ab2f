"""Stand-in views: the driver's tables in the shapes of the study's inputs.

The SQL runs unchanged in Spark and DuckDB, so the same text feeds the queries
and the check SQL.  Every view maps whole tables; products are reduced modulo
the coordinate range first, so that large keys cannot overflow.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..scale import shared_dir

_BP = "({k} % 200000000) * (({k} * 7919 + 104729) % 200000000) % 200000000 + 1"
_A1 = "CASE {k} % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'G' ELSE 'T' END"
_A2 = "CASE {k} % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'T' WHEN 2 THEN 'A' ELSE 'C' END"
_STUDY = "'S' || CAST({k} % 6 AS string)"


def _variant(k: str) -> dict[str, str]:
    return {"bp": _BP.format(k=k), "a1": _A1.format(k=k), "a2": _A2.format(k=k)}


_L, _P = _variant("l_partkey"), _variant("p_partkey")

# name -> (tables read, SQL)
VIEWS: dict[str, tuple[list[str], str]] = {
    # one row per (study, variant) report
    "assoc": (
        ["lineitem"],
        f"""SELECT 'rs' || CAST(l_partkey AS string) AS snp,
       CAST(l_partkey % 22 + 1 AS int) AS chr,
       CAST({_L['bp']} AS bigint) AS bp,
       {_L['a1']} AS a1, {_L['a2']} AS a2,
       l_quantity / 51.0 AS frq,
       exp((l_discount - 0.05) * 30) AS odds_ratio,
       exp((l_discount - 0.05) * 30 - 1.96 * (0.01 + l_tax)) AS l95,
       exp((l_discount - 0.05) * 30 + 1.96 * (0.01 + l_tax)) AS u95,
       power(10.0, -(l_extendedprice / 8000.0)) AS p,
       {_STUDY.format(k='l_suppkey')} AS study,
       l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey AS supp_id
FROM lineitem""",
    ),
    # reports already placed in a locus and an LD locus, either of them missing
    # at times; one stretch in five is reported by the two newest studies only
    "located": (
        ["lineitem"],
        f"""SELECT 'rs' || CAST(l_partkey AS string) AS snp,
       CAST(l_partkey % 22 + 1 AS int) AS chr,
       CAST({_L['bp']} AS bigint) AS bp,
       CASE WHEN l_quantity >= 50 THEN NULL
            ELSE 'L' || CAST(l_partkey % 22 + 1 AS string) || '_'
                 || CAST(CAST(floor(({_L['bp']}) / 2000000) AS bigint) AS string) END AS locus,
       CASE WHEN l_tax >= 0.075 THEN NULL ELSE CAST(floor(l_partkey / 3) AS bigint) END AS locus_ld,
       l_quantity / 51.0 AS frq,
       exp((l_discount - 0.05) * 30) AS odds_ratio,
       power(10.0, -(l_extendedprice / 8000.0)) AS p,
       CASE WHEN floor(({_L['bp']}) / 2000000) % 5 = 0 THEN 'S' || CAST(4 + l_suppkey % 2 AS string)
            ELSE {_STUDY.format(k='l_suppkey')} END AS study,
       l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey AS supp_id
FROM lineitem""",
    ),
    "study_meta": (
        ["supplier"],
        f"""SELECT {_STUDY.format(k='s_suppkey')} AS study,
       CAST(2013 + min(s_suppkey % 6) AS int) AS study_year,
       CAST(count(*) * 1000 + 500 AS bigint) AS n_ca,
       CAST(count(*) * 3000 + min(s_suppkey % 6) * 700 AS bigint) AS n_cn
FROM supplier GROUP BY 1""",
    ),
    # one study per supplier, so that the number of studies grows; some have no cases
    "cohorts": (
        ["supplier"],
        """SELECT 'C' || CAST(s_suppkey AS string) AS study, CAST(2000 + s_nationkey AS int) AS study_year,
       CASE WHEN s_suppkey % 9 = 4 THEN 0 ELSE CAST(floor(abs(s_acctbal)) * 10 + 500 AS bigint) END AS n_ca,
       CAST(floor(abs(s_acctbal)) * 30 + s_nationkey * 700 + 900 AS bigint) AS n_cn
FROM supplier""",
    ),
    "genes": (
        ["part"],
        """SELECT p_partkey AS gene_ord, 'G' || CAST(p_partkey AS string) AS gene_name,
       CAST(p_partkey % 22 + 1 AS int) AS g_chr,
       CAST((p_partkey * 15485863) % 200000000 + 1 AS bigint) AS g_start,
       CAST((p_partkey * 15485863) % 200000000 + 1 + p_size * 2000 AS bigint) AS g_end
FROM part""",
    ),
    # contiguous bands, so a point on an edge matches two
    "bands": (
        ["nation"],
        """SELECT CAST(a.n_nationkey + 1 AS int) AS b_chr,
       CAST((b.n_nationkey - b.n_nationkey % 5) * 8000000 AS bigint) AS band_start,
       CAST((b.n_nationkey - b.n_nationkey % 5 + 5) * 8000000 AS bigint) AS band_end,
       'q' || CAST(b.n_nationkey AS string) AS band
FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey""",
    ),
    # population frequencies; every third variant lists the alleles the other
    # way round, and some sites sit one position off and so match nothing
    "sites": (
        ["part"],
        f"""SELECT 'rs' || CAST(p_partkey AS string) AS id,
       CAST(p_partkey % 22 + 1 AS int) AS chr,
       CAST({_P['bp']} + CASE WHEN p_size = 7 THEN 1 ELSE 0 END AS bigint) AS bp,
       CASE WHEN p_partkey % 3 = 0 THEN {_P['a2']} ELSE {_P['a1']} END AS ref,
       CASE WHEN p_partkey % 3 = 0 THEN {_P['a1']} ELSE {_P['a2']} END AS alt,
       CAST(p_size AS double) / 51 AS af
FROM part""",
    ),
    # two transcripts per variant: allele|annotation|impact|gene|biotype|change
    "ann": (
        ["part"],
        """SELECT 'rs' || CAST(p_partkey AS string) AS snp,
       concat_ws(',',
         concat_ws('|', CASE p_partkey % 2 WHEN 0 THEN 'A' ELSE 'C' END, 'intron_variant', 'MODIFIER',
                   p_brand, CASE p_partkey % 3 WHEN 0 THEN 'lncRNA' ELSE 'protein_coding' END, ''),
         concat_ws('|', CASE p_partkey % 2 WHEN 0 THEN 'A' ELSE 'C' END, 'missense_variant', 'MODERATE',
                   p_brand, CASE p_partkey % 5 WHEN 0 THEN '' ELSE 'protein_coding' END,
                   'p.Arg' || CAST(p_size AS string) || 'Ile')) AS ann
FROM part""",
    ),
    # one genotype per (sample, variant), for LD; the samples grow with the root of the orders
    "dosage": (
        ["lineitem"],
        f"""SELECT CAST(floor(sqrt(l_orderkey)) AS bigint) AS sample_id,
       CAST(l_partkey % 22 + 1 AS int) AS chr,
       CAST({_L['bp']} AS bigint) AS bp,
       'rs' || CAST(l_partkey AS string) AS snp,
       CAST(max(l_linenumber % 3) AS int) AS dosage
FROM lineitem GROUP BY 1, 2, 3, 4""",
    ),
    # the same before the largest of a sample and variant is taken, which bit planes do by themselves
    "calls": (
        ["lineitem"],
        f"""SELECT CAST(floor(sqrt(l_orderkey)) AS bigint) AS sample_id,
       CAST(l_partkey % 22 + 1 AS int) AS chr,
       CAST({_L['bp']} AS bigint) AS bp,
       'rs' || CAST(l_partkey AS string) AS snp,
       CAST(l_linenumber % 3 AS int) AS dosage
FROM lineitem""",
    ),
    # prioritised genes with a tier
    "tiers": (
        ["part"],
        """SELECT 'G' || CAST(p_partkey AS string) AS gene,
       CASE WHEN p_size <= 12 THEN 'Tier 1' WHEN p_size <= 30 THEN 'Tier 2' END AS tier,
       CAST(p_partkey % 22 + 1 AS string) || '_' || p_brand AS locus
FROM part""",
    ),
}


class Views:
    """Getter of stand-in views and tables, with a folder for written tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def folder(self, name: str) -> str:
        """A new path under the folder that all executors share."""
        return f"{shared_dir(self.spark)}/tables/{uuid.uuid4().hex}/{name}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stand-in view, or a plain table, over the parquet files of ``sf_dir``."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tables, sql = VIEWS[name]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(sql, **frames)


def ctes(*names: str) -> str:
    """The views as leading CTEs of a check query."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in names)
