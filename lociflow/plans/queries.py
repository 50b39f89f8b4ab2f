"""The registered queries, each with its check SQL beside it.

Both read the whole tables through the same stand-in views.  Doubles are
rounded to six places, integer sums are bigint, and every pick has a total
order, so that the two engines give equal rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, genetics, nulls, text
from ..operators import harmonise as harm
from ..operators import intervals, joins, ld, membership, pick, reshape, scans, summarise
from ..operators.nearest import nearest, nearest_in_sets
from ..scale import settle
from ..sources import blockgzip, delimited, genome, sites, variants
from ..sources.schemas import schema_of
from . import annotate, power, report, study
from .standins import _BP, Views, ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TIES = ["order_id", "line_no", "supp_id"]
STUDIES = ["S0", "S1", "S2", "S3", "S4", "S5"]


def query(name: str, sql: str | None = None):
    """Register a function (Views) -> DataFrame under a name."""

    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return fn

    return wrap


def r6(c, name: str | None = None):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(name or c)


def positions(v) -> DataFrame:
    """Distinct variants of the association reports."""
    return v("assoc").select("snp", "chr", "bp").distinct()


# --- loci -----------------------------------------------------------------

_SIG = "sig AS (SELECT * FROM assoc WHERE p < 5e-8)"
_LOCI = """spans AS (SELECT DISTINCT chr, CASE WHEN bp - 500000 < 0 THEN 1 ELSE bp - 500000 END AS s, bp + 500000 AS e
  FROM sig),
marked AS (SELECT chr, s, e, CASE WHEN s <= max(e) OVER (PARTITION BY chr ORDER BY s, e
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f FROM spans),
islands AS (SELECT chr, s, e, sum(f) OVER (PARTITION BY chr ORDER BY s, e) AS i FROM marked),
loci AS (SELECT chr AS l_chr, min(s) AS l_start, max(e) AS l_end,
  'chr' || CAST(chr AS string) || ':' || CAST(min(s) AS string) || '-' || CAST(max(e) AS string) AS locus
  FROM islands GROUP BY chr, i)"""


@query(
    "loci_per_study",
    f"""{ctes('assoc')}, {_SIG}, {_LOCI}
SELECT study, CAST(count(DISTINCT locus) AS bigint) AS n_loci
FROM sig JOIN loci ON chr = l_chr AND bp <= l_end AND bp + 1 >= l_start GROUP BY study""",
)
def _(v):
    return report.loci_per_study(genetics.significant(v("assoc")))


@query(
    "merge_intervals",
    f"""{ctes('assoc')}, {_SIG}, {_LOCI}
SELECT l_chr AS chr, l_start AS "start", l_end AS "end", locus FROM loci""",
)
def _(v):
    return intervals.define_loci(genetics.significant(v("assoc")))


@query(
    "overlap_band",
    f"""{ctes('assoc', 'bands')}, pts AS (SELECT DISTINCT snp, chr, bp FROM assoc)
SELECT snp, chr, bp, CAST(chr AS string) || band AS cytoband
FROM pts LEFT JOIN bands ON chr = b_chr AND bp <= band_end AND bp + 1 >= band_start""",
)
def _(v):
    bands = reshape.unite(v("bands").withColumn("c", F.col("b_chr")), "cytoband", ["c", "band"], "")
    hit = intervals.overlap_join(positions(v), bands, right_on=("b_chr", "band_start", "band_end"))
    return hit.select("snp", "chr", "bp", "cytoband")


@query(
    "overlap_region_gene",
    f"""{ctes('assoc', 'genes')}, regions AS (SELECT DISTINCT chr, CASE WHEN bp - 500000 < 0 THEN 1 ELSE bp - 500000 END AS s,
  bp + 500000 AS e FROM assoc)
SELECT chr, s, e, gene_name FROM regions JOIN genes ON chr = g_chr AND s <= g_end AND e >= g_start""",
)
def _(v):
    regions = intervals.flank(positions(v).select("chr", "bp"), start="s", end="e").drop("bp").distinct()
    genes = v("genes").drop("gene_ord")
    hit = intervals.overlap_join(regions, genes, ("chr", "s", "e"), ("g_chr", "g_start", "g_end"), how="inner")
    return hit.select("chr", "s", "e", "gene_name")


@query(
    "first_overlapping_gene",
    f"""{ctes('assoc', 'genes')}, pts AS (SELECT DISTINCT chr, bp FROM assoc),
hits AS (SELECT chr, bp, gene_name, row_number() OVER (PARTITION BY chr, bp ORDER BY gene_ord) AS rn
  FROM pts JOIN genes ON chr = g_chr AND bp <= g_end AND bp + 1 >= g_start)
SELECT p.chr, p.bp, h.gene_name FROM pts p LEFT JOIN hits h ON p.chr = h.chr AND p.bp = h.bp AND h.rn = 1""",
)
def _(v):
    pts = positions(v).select("chr", "bp").distinct()
    hit = intervals.overlap_join(pts, v("genes"), right_on=("g_chr", "g_start", "g_end"), first_by=["gene_ord"])
    return hit.select("chr", "bp", "gene_name")


_NEAREST = f"""{ctes('assoc', 'genes')}, pts AS (SELECT DISTINCT snp, chr, bp FROM assoc),
scored AS (SELECT snp, chr, bp, gene_ord, gene_name, g_end,
  CASE WHEN bp BETWEEN g_start AND g_end THEN 0 ELSE least(abs(bp - g_start), abs(bp - g_end)) END AS d
  FROM pts JOIN genes ON chr = g_chr),
best AS (SELECT *, row_number() OVER (PARTITION BY snp, chr, bp ORDER BY d, gene_ord) AS rn FROM scored)"""
_DIRECTION = "CASE WHEN d = 0 THEN 'intragenic' WHEN bp > g_end THEN 'downstream' ELSE 'upstream' END AS direction"


@query(
    "nearest_gene",
    f"{_NEAREST} SELECT snp, chr, bp, gene_name, CAST(d AS bigint) AS dist, {_DIRECTION} FROM best WHERE rn = 1",
)
def _(v):
    return nearest(positions(v), v("genes"), interval_on=("g_chr", "g_start", "g_end"))


@query(
    "nearest_gene_capped",
    f"""{_NEAREST} SELECT snp, chr, bp, CASE WHEN d <= 500000 THEN gene_name END AS gene_name,
CASE WHEN d <= 500000 THEN CAST(d AS bigint) END AS dist, {_DIRECTION} FROM best WHERE rn = 1""",
)
def _(v):
    return nearest(positions(v), v("genes"), interval_on=("g_chr", "g_start", "g_end"), max_dist=500_000)


@query(
    "gene_list_coordinates",
    f"""{ctes('genes', 'tiers')} SELECT gene, tier, g_chr, g_start, g_end
FROM (SELECT gene || CASE WHEN tier = 'Tier 2' THEN 'x' ELSE '' END AS gene, tier FROM tiers WHERE tier IS NOT NULL) t
LEFT JOIN genes ON gene = gene_name""",
)
def _(v):
    listed = v("tiers").filter("tier IS NOT NULL").select(
        F.concat("gene", F.when(F.col("tier") == "Tier 2", "x").otherwise("")).alias("gene"), "tier"
    )
    genes = v("genes").withColumnRenamed("gene_name", "gene")
    return joins.lookup_join(listed, genes, "gene").select("gene", "tier", "g_chr", "g_start", "g_end")


# --- formulas -------------------------------------------------------------


@query(
    "se_z_from_ci",
    f"""{ctes('assoc')} SELECT snp, study, round(ln(odds_ratio), 6) AS beta,
round((ln(odds_ratio) - ln(l95)) / 1.96, 6) AS se,
round(ln(odds_ratio) / ((ln(odds_ratio) - ln(l95)) / 1.96), 6) AS z FROM assoc""",
)
def _(v):
    return genetics.with_effect_cols(v("assoc")).select("snp", "study", r6("beta"), r6("se"), r6("z"))


@query(
    "beta_from_z",
    f"""{ctes('assoc')}, m AS (SELECT snp, study, least(frq, 0.98) AS f, ln(odds_ratio) * 10 AS z FROM assoc)
SELECT snp, study, round(z / sqrt(2 * f * (1 - f) * (50000 + z * z)), 6) AS beta,
round(exp(z / sqrt(2 * f * (1 - f) * (50000 + z * z))), 6) AS odds_ratio FROM m""",
)
def _(v):
    z = F.log("odds_ratio") * 10
    beta = genetics.beta_from_z(z, F.least("frq", F.lit(0.98)), F.lit(50000))
    return v("assoc").select("snp", "study", r6(beta, "beta"), r6(F.exp(beta), "odds_ratio"))


@query(
    "neff",
    f"""{ctes('cohorts')} SELECT study, study_year, round(4 / (1.0 / n_ca + 1.0 / n_cn), 6) AS neff,
round((n_ca + n_cn) * (n_ca / (n_ca + n_cn)) * (1 - n_ca / (n_ca + n_cn)), 6) AS neff_power FROM cohorts""",
)
def _(v):
    n = F.col("n_ca") + F.col("n_cn")
    return v("cohorts").select(
        "study", "study_year", r6(genetics.neff_4("n_ca", "n_cn"), "neff"), r6(genetics.neff_phi(n, "n_ca"), "neff_power")
    )


@query(
    "fold_maf",
    f"""{ctes('sites')} SELECT id, round(CASE WHEN af > 0.5 THEN 1 - af ELSE af END, 6) AS maf,
CASE WHEN af > 0.5 THEN ref ELSE alt END AS minor_allele,
CASE WHEN af > 0.5 THEN alt ELSE ref END AS db_major, CASE WHEN af < 0.5 THEN alt ELSE ref END AS db_minor FROM sites""",
)
def _(v):
    maf, minor = genetics.fold_maf("af", "ref", "alt")
    major_db, minor_db = genetics.major_minor("af", "ref", "alt")
    return v("sites").select(
        "id", r6(maf, "maf"), minor.alias("minor_allele"), major_db.alias("db_major"), minor_db.alias("db_minor")
    )


@query(
    "orient_to_minor",
    f"""{ctes('assoc')} SELECT snp, study, round(CASE WHEN frq > 0.5 THEN 1 - frq ELSE frq END, 6) AS maf,
round(CASE WHEN frq > 0.5 THEN -ln(odds_ratio) ELSE ln(odds_ratio) END, 6) + 0.0 AS beta,
round(CASE WHEN frq > 0.5 THEN 1 / odds_ratio ELSE odds_ratio END, 6) AS odds_ratio FROM assoc""",
)
def _(v):
    out = genetics.orient_to_minor(v("assoc").withColumn("beta", F.log("odds_ratio")))
    return out.select("snp", "study", r6("maf"), (F.round("beta", 6) + F.lit(0.0)).alias("beta"), r6("odds_ratio"))


_MINOR = "minors AS (SELECT id, CASE WHEN af > 0.9 THEN NULL WHEN af > 0.5 THEN ref ELSE alt END AS minor FROM sites)"
_FLIP = "minor <> a2 AND length(minor) = 1 AND NOT (frq BETWEEN 0.42 AND 0.58)"


@query(
    "align_to_minor",
    f"""{ctes('assoc', 'sites')}, {_MINOR},
j AS (SELECT a.*, minor, {_FLIP} AS flip FROM assoc a LEFT JOIN minors ON snp = id)
SELECT snp, study,
 round(CASE WHEN flip IS NULL THEN NULL WHEN flip THEN 1 - frq ELSE frq END, 6) AS frq,
 round(CASE WHEN flip IS NULL THEN NULL WHEN flip THEN 1 / odds_ratio ELSE odds_ratio END, 6) AS odds_ratio,
 CASE WHEN flip IS NULL THEN NULL WHEN flip THEN a2 ELSE a1 END AS a1,
 CASE WHEN flip IS NULL THEN NULL WHEN flip THEN minor ELSE a2 END AS a2 FROM j""",
)
def _(v):
    _, minor = genetics.fold_maf("af", "ref", "alt")
    minors = v("sites").select(F.col("id").alias("snp"), F.when(F.col("af") <= 0.9, minor).alias("minor"))
    out = genetics.align_to_minor(joins.lookup_join(v("assoc"), minors, "snp"))
    return out.select("snp", "study", r6("frq"), r6("odds_ratio"), "a1", "a2")


@query(
    "orient_freq",
    f"""{ctes('assoc', 'sites')} SELECT snp, study,
round(CASE WHEN a2 <> alt THEN 1 - frq WHEN a2 = alt THEN frq END, 6) AS frq FROM assoc LEFT JOIN sites ON snp = id""",
)
def _(v):
    tested = v("sites").select(F.col("id").alias("snp"), "alt")
    out = joins.lookup_join(v("assoc"), tested, "snp")
    return out.select("snp", "study", r6(genetics.orient_freq("frq", "a2", "alt"), "frq"))


@query(
    "flip_listed",
    f"""{ctes('assoc')}, f AS (SELECT *, snp IN ('rs1', 'rs7', 'rs42') AS flip FROM assoc)
SELECT snp, study, CASE WHEN flip THEN a2 ELSE a1 END AS a1, CASE WHEN flip THEN a1 ELSE a2 END AS a2,
round(CASE WHEN flip THEN 1 - frq ELSE frq END, 6) AS frq, round(CASE WHEN flip THEN -ln(odds_ratio) ELSE ln(odds_ratio) END, 6) + 0.0 AS beta FROM f""",
)
def _(v):
    out = genetics.flip_listed(v("assoc").withColumn("beta", F.log("odds_ratio")), ["rs1", "rs7", "rs42"])
    return out.select("snp", "study", "a1", "a2", r6("frq"), (F.round("beta", 6) + F.lit(0.0)).alias("beta"))


@query(
    "harmonise",
    f"""{ctes('assoc', 'sites')},
pairs AS (SELECT chr AS s_chr, bp AS s_bp, least(ref, alt) AS x, greatest(ref, alt) AS y, min(ref) AS ref,
  CASE WHEN min(ref) = least(ref, alt) THEN greatest(ref, alt) ELSE least(ref, alt) END AS alt
  FROM sites GROUP BY chr, bp, least(ref, alt), greatest(ref, alt)),
j AS (SELECT a.*, ref, alt, ref IS NOT NULL AS matched, coalesce(a1 <> ref, false) AS rev,
  row_number() OVER (PARTITION BY chr, bp, least(a1, a2), greatest(a1, a2) ORDER BY order_id, line_no, supp_id) AS rn
  FROM assoc a LEFT JOIN pairs ON chr = s_chr AND bp = s_bp AND least(a1, a2) = x AND greatest(a1, a2) = y)
SELECT snp, chr, bp, coalesce(ref, a1) AS a1, coalesce(alt, a2) AS a2,
 round(CASE WHEN rev THEN 1 - frq ELSE frq END, 6) AS frq,
 round(CASE WHEN rev THEN 1 / odds_ratio ELSE odds_ratio END, 6) AS odds_ratio, matched FROM j WHERE rn = 1""",
)
def _(v):
    out = harm.harmonise(v("assoc"), v("sites"), TIES)
    return out.select("snp", "chr", "bp", "a1", "a2", r6("frq"), r6("odds_ratio"), "matched")


@query(
    "harmonise_strict",
    f"""{ctes('assoc', 'sites')},
many AS (SELECT chr, bp FROM sites GROUP BY chr, bp HAVING count(DISTINCT alt) > 1),
j AS (SELECT a.snp, a.chr, a.bp, s.ref AS a1, s.alt AS a2,
  row_number() OVER (PARTITION BY a.chr, a.bp, least(a1, a2), greatest(a1, a2) ORDER BY order_id, line_no, supp_id) AS rn
  FROM assoc a JOIN sites s ON a.chr = s.chr AND a.bp = s.bp AND least(a1, a2) = least(ref, alt) AND greatest(a1, a2) = greatest(ref, alt)
  WHERE NOT EXISTS (SELECT 1 FROM many m WHERE m.chr = a.chr AND m.bp = a.bp))
SELECT snp, chr, bp, a1, a2 FROM j WHERE rn = 1""",
)
def _(v):
    out = harm.harmonise(v("assoc"), v("sites"), TIES, drop_unmatched=True, biallelic=True)
    return out.select("snp", "chr", "bp", "a1", "a2")


@query(
    "liftover",
    f"""{ctes('assoc', 'genes')}, pts AS (SELECT DISTINCT snp, chr, bp FROM assoc),
seg AS (SELECT b_chr, lo, lo + 3999999 AS hi, n % 2 AS odd FROM
  (SELECT g_chr AS b_chr, CAST(floor(g_start / 8000000) AS bigint) * 8000000 AS lo,
   CAST(floor(g_start / 8000000) AS bigint) AS n FROM genes GROUP BY 1, 2, 3) t)
SELECT snp, chr, bp, b_chr AS lifted_chr,
 CASE WHEN b_chr IS NULL THEN NULL WHEN odd = 1 THEN lo + 250000 + (hi - bp) ELSE lo + 250000 + (bp - lo) END AS lifted_bp
FROM pts LEFT JOIN seg ON chr = b_chr AND bp BETWEEN lo AND hi""",
)
def _(v):
    n = F.floor(F.col("g_start") / 8000000).cast("long")
    seg = v("genes").select(F.col("g_chr").alias("src_chr"), n.alias("n")).distinct()
    seg = seg.select(
        "src_chr",
        (F.col("n") * 8000000).alias("src_start"),
        (F.col("n") * 8000000 + 3999999).alias("src_end"),
        F.col("src_chr").alias("dst_chr"),
        (F.col("n") * 8000000 + 250000).alias("dst_start"),
        F.when(F.col("n") % 2 == 1, "-").otherwise("+").alias("strand"),
    )
    return intervals.liftover(positions(v), seg)


# two chains a stretch of genes: one of three blocks with gaps on both sides, every other one reversed, and a
# shorter one over its middle that is better at times
_CHAIN_BLOCKS = [(0, 0, 1000000), (1500000, 1300000, 800000), (2300000, 2300000, 700000)]
_CHAIN_SQL = f"""heads AS (SELECT DISTINCT g_chr AS c, CAST(floor(g_start / 8000000) AS bigint) AS n FROM genes),
seg AS (SELECT c, n * 8000000 + t + 1 AS s, n * 8000000 + t + len AS e, c % 22 + 1 AS d, CASE WHEN n % 2 = 1 THEN '-' ELSE '+' END AS strand,
  CASE WHEN n % 2 = 1 THEN 300000000 - (n * 8000000 + 250000 + q) - len ELSE n * 8000000 + 250000 + q END + 1 AS ds, 5000 AS score
  FROM heads, (VALUES {', '.join(map(str, _CHAIN_BLOCKS))}) b(t, q, len)
  UNION ALL SELECT c, n * 8000000 + 600000 + 1, n * 8000000 + 1700000, c, '+', n * 8000000 + 11 + 1, CASE WHEN n % 3 = 0 THEN 9000 ELSE 100 END FROM heads),
pts AS (SELECT DISTINCT snp, chr, bp, a1 FROM assoc),
hit AS (SELECT p.*, d, strand, CASE WHEN strand = '-' THEN ds + (e - bp) ELSE ds + (bp - s) END AS lifted_bp,
  row_number() OVER (PARTITION BY snp, chr, bp, a1 ORDER BY score DESC) AS rn FROM pts p LEFT JOIN seg ON chr = c AND bp BETWEEN s AND e)"""


@query(
    "chain_liftover",
    f"""{ctes('assoc', 'genes')}, {_CHAIN_SQL} SELECT snp, chr, bp, CAST(d AS int) AS lifted_chr, lifted_bp,
CASE WHEN strand = '-' THEN translate(a1, 'ACGT', 'TGCA') ELSE a1 END AS a1 FROM hit WHERE rn = 1""",
)
def _(v):
    path = v.folder("builds.chain")
    n, c = F.col("n"), F.col("c")
    heads = v("genes").select(F.col("g_chr").alias("c"), F.floor(F.col("g_start") / 8000000).cast("long").alias("n")).distinct()
    strand = F.when(n % 2 == 1, "-").otherwise("+")
    (_, _, one), (t2, q2, two), (t3, q3, three) = _CHAIN_BLOCKS
    low = n * 8000000
    number = c * 1000 + n
    long = F.concat_ws(" ", F.lit("chain 5000"), F.concat(F.lit("chr"), c), F.lit(300000000), F.lit("+"), low, low + t3 + three,
                       F.concat(F.lit("chr"), c % 22 + 1), F.lit(300000000), strand, low + 250000, low + 250000 + q3 + three, number)
    blocks = f"\n{one} {t2 - one} {q2 - one}\n{two}\t{t3 - t2 - two}\t{q3 - q2 - two}\n{three}\n"
    short = F.concat_ws(" ", F.lit("chain"), F.when(n % 3 == 0, 9000).otherwise(100), F.concat(F.lit("chr"), c), F.lit(300000000), F.lit("+"),
                        low + 600000, low + 1700000, F.concat(F.lit("chr"), c), F.lit(300000000), F.lit("+"), low + 11, low + 1100011, number + 100000)
    heads.select(F.concat(long, F.lit(blocks), F.lit("\n"), short, F.lit("\n1100000\n")).alias("value")).write.text(path)
    points = v("assoc").select("snp", "chr", "bp", "a1").distinct()
    lifted = intervals.liftover(points, genome.read_chains(v.spark, path), alleles=("a1",))
    return lifted.select("snp", "chr", "bp", "lifted_chr", "lifted_bp", "a1")


# --- picks, joins, null rules ----------------------------------------------


@query(
    "best_p_per_variant",
    f"""{ctes('assoc')}, r AS (SELECT *, row_number() OVER (PARTITION BY snp ORDER BY p, order_id, line_no, supp_id) AS rn FROM assoc)
SELECT snp, study, order_id, line_no, round(p * 1e8, 6) AS p_e8 FROM r WHERE rn = 1""",
)
def _(v):
    out = pick.best_per(v("assoc"), ["snp"], "p", TIES)
    return out.select("snp", "study", "order_id", "line_no", r6(F.col("p") * 1e8, "p_e8"))


@query(
    "best_neff_per_position",
    f"""{ctes('assoc', 'study_meta')}, r AS (SELECT a.*, row_number() OVER (PARTITION BY chr, bp
  ORDER BY 4 / (1.0 / n_ca + 1.0 / n_cn) DESC, order_id, line_no, supp_id) AS rn FROM assoc a JOIN study_meta m ON a.study = m.study)
SELECT snp, chr, bp, study, order_id, line_no FROM r WHERE rn = 1""",
)
def _(v):
    meta = v("study_meta").select("study", genetics.neff_4("n_ca", "n_cn").alias("neff"))
    rows = joins.lookup_join(v("assoc"), meta, "study")
    out = pick.best_per(rows, ["chr", "bp"], "neff", TIES, highest=True)
    return out.select("snp", "chr", "bp", "study", "order_id", "line_no")


@query(
    "distinct_on",
    f"""{ctes('assoc')}, r AS (SELECT *, row_number() OVER (PARTITION BY study, snp ORDER BY order_id, line_no, supp_id) AS rn FROM assoc)
SELECT study, snp, order_id, line_no, supp_id FROM r WHERE rn = 1""",
)
def _(v):
    return pick.distinct_on(v("assoc"), ["study", "snp"], TIES).select("study", "snp", *TIES)


_TRANSCRIPTS = f"""{ctes('ann')},
t AS (SELECT snp, string_split(ann, ',') AS parts FROM ann),
e AS (SELECT snp, generate_subscripts(parts, 1) AS place, unnest(parts) AS one FROM t),
f AS (SELECT snp, place, string_split(one, '|') AS f FROM e),
w AS (SELECT snp, f[1] AS allele, f[2] AS annotation, f[3] AS annotation_impact, f[4] AS gene_name, f[5] AS biotype,
  f[6] AS hgvs_p, row_number() OVER (PARTITION BY snp ORDER BY place) AS rn FROM f WHERE f[5] IN ('', 'protein_coding'))"""
_FIELDS = ["allele", "annotation", "annotation_impact", "gene_name", "biotype", "hgvs_p"]


@query("first_transcript", f"{_TRANSCRIPTS} SELECT snp, {', '.join(_FIELDS)} FROM w WHERE rn = 1")
def _(v):
    return annotate.annotate_consequence(v("ann"), _FIELDS)


@query(
    "explode_transcripts",
    f"""{_TRANSCRIPTS} SELECT snp, CAST(place - 1 AS int) AS place, f[2] AS annotation, f[5] AS biotype FROM f""",
)
def _(v):
    rows = reshape.explode_list(v("ann"), "ann", ",", "place")
    return reshape.separate(rows, "ann", _FIELDS, r"\|").select("snp", "place", "annotation", "biotype")


_CODES = "".join(f"replace(" for _ in text.AMINO_ACIDS) + "regexp_replace(c, '^p\\.', '')" + "".join(
    f", '{k}', '{a}')" for k, a in text.AMINO_ACIDS.items()
)
_CHANGES = """SELECT snp, split_part(split_part(ann, ',', 2), '|', 6) AS c,
 CASE WHEN length(snp) % 3 = 0 THEN 'A' ELSE 'C' END AS minor, split_part(split_part(ann, ',', 2), '|', 1) AS allele FROM ann"""


@query("short_hgvs", f"{ctes('ann')}, c AS ({_CHANGES}) SELECT snp, {_CODES} AS hgvs_p FROM c")
def _(v):
    last = F.element_at(F.split("ann", r"\|"), -1)
    return v("ann").select("snp", text.short_hgvs(last).alias("hgvs_p"))


@query(
    "orient_hgvs",
    f"""{ctes('ann')}, c AS ({_CHANGES}), s AS (SELECT snp, minor, allele, {_CODES} AS h FROM c),
d AS (SELECT *, regexp_extract(h, '[0-9]+') AS n FROM s)
SELECT snp, h AS hgvs_p, CASE WHEN minor = allele THEN split_part(h, n, 1) || n || split_part(h, n, 2)
 ELSE split_part(h, n, 2) || n || split_part(h, n, 1) END AS hgvs_p_new FROM d""",
)
def _(v):
    rows = v("ann").select(
        "snp",
        F.element_at(F.split("ann", r"\|"), -1).alias("hgvs_p"),
        F.substring("ann", 1, 1).alias("allele"),
        F.when(F.length("snp") % 3 == 0, "A").otherwise("C").alias("minor"),
    )
    return annotate.with_protein_change(rows).select("snp", "hgvs_p", "hgvs_p_new")


@query(
    "match_sites",
    f"""{ctes('assoc', 'sites')}, vars AS (SELECT DISTINCT snp, chr, bp, a1, a2 FROM assoc)
SELECT snp, v.chr, v.bp, a1, a2, round(af, 6) AS af FROM vars v JOIN sites s ON v.chr = s.chr AND v.bp = s.bp AND a1 = ref AND a2 = alt
UNION ALL SELECT snp, v.chr, v.bp, a1, a2, round(af, 6) AS af FROM vars v
LEFT JOIN (SELECT * FROM sites WHERE (chr, bp) IN (SELECT (chr, bp) FROM vars)) s ON snp = id WHERE snp IN ('rs3', 'rs6', 'rs7', 'rs99')""",
)
def _(v):
    variants = v("assoc").select("snp", "chr", "bp", "a1", "a2").distinct()
    return joins.match_sites(variants, v("sites"), ["rs3", "rs6", "rs7", "rs99"]).withColumn("af", r6("af"))


@query(
    "annotate_frequency",
    f"""{ctes('assoc', 'sites')}, vars AS (SELECT DISTINCT snp, chr, bp, a1, a2 FROM assoc),
pop AS (SELECT *, CASE WHEN af > 0.5 THEN 1 - af ELSE af END AS maf, CASE WHEN af > 0.5 THEN ref ELSE alt END AS minor FROM sites),
hit AS (SELECT snp, v.chr, v.bp, a1, a2, minor, af, maf FROM vars v JOIN pop s ON v.chr = s.chr AND v.bp = s.bp AND a1 = ref AND a2 = alt
  UNION ALL SELECT snp, v.chr, v.bp, a1, a2, minor, af, maf FROM vars v
  LEFT JOIN (SELECT * FROM pop WHERE (chr, bp) IN (SELECT (chr, bp) FROM vars)) s ON snp = id WHERE snp IN ('rs3', 'rs9'))
SELECT snp, chr, bp, a1, a2, minor AS gnomad_minor, round(af, 6) AS gnomad_af, round(maf, 6) AS gnomad_maf FROM hit""",
)
def _(v):
    variants = v("assoc").select("snp", "chr", "bp", "a1", "a2").distinct()
    out = annotate.annotate_frequency(variants, v("sites"), ["rs3", "rs9"])
    return out.withColumns({"gnomad_af": r6("gnomad_af"), "gnomad_maf": r6("gnomad_maf")})


@query(
    "database_frequency",
    f"""{ctes('assoc')}, rec AS (SELECT snp, CASE WHEN frq < 0.1 THEN '' ELSE 'G' || study END AS gene, study, a1, a2, frq, order_id FROM assoc),
r AS (SELECT snp, study, a1, a2, frq, min(gene) AS gene FROM rec WHERE study = 'S2' GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY snp ORDER BY frq DESC, a2) AS rn FROM r)
SELECT snp, nullif(gene, '') AS dbsnp_gene, study, a1 AS ref_seq, CASE WHEN frq > 0.5 THEN a2 ELSE a1 END AS major,
 CASE WHEN frq < 0.5 THEN a2 ELSE a1 END AS minor, round(CASE WHEN frq > 0.5 THEN 1 - frq ELSE frq END, 6) AS maf,
 round(frq, 6) AS af FROM b WHERE rn = 1""",
)
def _(v):
    rec = v("assoc").select(
        "snp",
        F.when(F.col("frq") < 0.1, "").otherwise(F.concat(F.lit("G"), "study")).alias("gene"),
        "study",
        F.col("a1").alias("ref_seq"),
        F.col("a2").alias("minor"),
        F.col("frq").alias("maf"),
    )
    return annotate.database_frequency(rec, "S2").withColumns({"maf": r6("maf"), "af": r6("af")})


@query(
    "restore_dropped",
    f"""{ctes('assoc', 'sites')}, clean AS (SELECT DISTINCT snp, CASE WHEN chr = 9 THEN NULL ELSE chr END AS chr, bp FROM assoc),
qc AS (SELECT id AS snp, CASE WHEN chr = 9 THEN NULL ELSE chr END AS chr, bp, round(af, 6) AS af FROM sites)
SELECT snp, chr, bp, af FROM qc UNION ALL
SELECT snp, chr, bp, NULL AS af FROM clean c WHERE NOT EXISTS (SELECT 1 FROM qc WHERE qc.chr IS NOT DISTINCT FROM c.chr AND qc.bp IS NOT DISTINCT FROM c.bp)""",
)
def _(v):
    known = F.when(F.col("chr") != 9, F.col("chr")).alias("chr")
    qc = v("sites").select(F.col("id").alias("snp"), known, "bp", r6("af"))
    return joins.restore_dropped(positions(v).select("snp", known, "bp"), qc, ["chr", "bp"])


@query(
    "apply_overrides",
    f"""{ctes('assoc')} SELECT snp, study, order_id, line_no, supp_id,
CASE snp WHEN 'rs1' THEN 203743439 WHEN 'rs5' THEN 32583099 ELSE bp END AS bp,
CASE snp WHEN 'rs5' THEN 'TT' ELSE a1 END AS a1 FROM assoc""",
)
def _(v):
    fixes = [("rs1", "bp", 203743439), ("rs5", "bp", 32583099), ("rs5", "a1", "TT")]
    return joins.apply_overrides(v("assoc"), fixes, "snp").select("snp", "study", *TIES, "bp", "a1")


@query(
    "inherit_locus",
    f"""{ctes('located')}, src AS (SELECT {{'l': locus, 'i': locus_ld}} AS s FROM located WHERE snp = 'rs8' ORDER BY locus NULLS FIRST, locus_ld NULLS FIRST LIMIT 1)
SELECT snp, study, order_id, line_no, supp_id, CASE WHEN snp LIKE 'rs10%' THEN s.l ELSE locus END AS locus,
CASE WHEN snp LIKE 'rs10%' THEN s.i ELSE locus_ld END AS locus_ld FROM located, src""",
)
def _(v):
    rows = v("located").select("snp", "study", *TIES, "locus", "locus_ld")
    return joins.inherit_from(rows, rows, "^rs10", "rs8", ["locus", "locus_ld"])


@query(
    "flag_in_set",
    f"""{ctes('genes', 'tiers')} SELECT gene_name AS gene, coalesce(t.tier = 'Tier 1', false) AS listed,
CASE WHEN t.tier = 'Tier 1' THEN t.locus END AS locus FROM genes LEFT JOIN tiers t ON gene_name = gene""",
)
def _(v):
    members = v("tiers").filter("tier = 'Tier 1'").select("gene", "locus")
    genes = v("genes").select(F.col("gene_name").alias("gene"))
    return joins.flag_in_set(genes, members, "gene", "listed", ("locus",))


@query(
    "genes_that_pass",
    f"""{ctes('genes', 'tiers')} SELECT gene_name, g_chr, g_start FROM genes
WHERE gene_name IN (SELECT gene FROM tiers WHERE tier = 'Tier 1')""",
)
def _(v):
    passing = v("tiers").filter("tier = 'Tier 1'").select(F.col("gene").alias("gene_name"))
    return v("genes").join(passing, "gene_name", "left_semi").select("gene_name", "g_chr", "g_start")


@query(
    "extract_sites",
    f"""{ctes('assoc', 'sites')} SELECT id, chr, bp, ref, alt, round(af, 6) AS af FROM sites s
WHERE EXISTS (SELECT 1 FROM assoc a WHERE p < 5e-8 AND a.chr = s.chr AND a.bp = s.bp)""",
)
def _(v):
    wanted = genetics.significant(v("assoc"))
    return joins.extract_sites(v("sites"), wanted).withColumn("af", r6("af"))


@query(
    "natural_left_join",
    f"""{ctes('located')}, cells AS (SELECT study, locus, count(*) AS n FROM located GROUP BY 1, 2),
places AS (SELECT locus, min(bp) AS bp FROM located GROUP BY 1)
SELECT study, c.locus, CAST(n AS bigint) AS n, bp FROM cells c LEFT JOIN places p ON c.locus IS NOT DISTINCT FROM p.locus""",
)
def _(v):
    cells = v("located").groupBy("study", "locus").agg(F.count(F.lit(1)).alias("n"))
    places = v("located").groupBy("locus").agg(F.min("bp").alias("bp"))
    return joins.natural_left_join(cells, places).select("study", "locus", "n", "bp")


@query(
    "full_join",
    f"""{ctes('assoc', 'sites')}, a AS (SELECT chr, bp, count(*) AS n FROM assoc GROUP BY 1, 2)
SELECT coalesce(a.chr, s.chr) AS chr, coalesce(a.bp, s.bp) AS bp, CAST(n AS bigint) AS n, id
FROM a FULL JOIN sites s ON a.chr = s.chr AND a.bp = s.bp""",
)
def _(v):
    a = v("assoc").groupBy("chr", "bp").agg(F.count(F.lit(1)).alias("n"))
    s = v("sites").select("chr", "bp", "id")
    return joins.null_safe_join(a, s, ["chr", "bp"], "full").select("chr", "bp", "n", "id")


@query(
    "get_dupes",
    f"""{ctes('located')} SELECT order_id, line_no, supp_id, locus, CAST(n AS bigint) AS dupe_count FROM
(SELECT *, count(*) OVER (PARTITION BY order_id, line_no) AS n FROM located) t WHERE n > 1""",
)
def _(v):
    return pick.get_dupes(v("located").select(*TIES, "locus"), ["order_id", "line_no"])


@query(
    "n_distinct_null",
    f"""{ctes('located')} SELECT study, CAST(count(DISTINCT locus) + max(CASE WHEN locus IS NULL THEN 1 ELSE 0 END) AS bigint) AS n_loci,
CAST(count(DISTINCT locus_ld) + max(CASE WHEN locus_ld IS NULL THEN 1 ELSE 0 END) AS bigint) AS n_variants FROM located GROUP BY study""",
)
def _(v):
    return v("located").groupBy("study").agg(
        nulls.n_distinct("locus").alias("n_loci"), nulls.n_distinct("locus_ld").alias("n_variants")
    )


@query(
    "count_distinct_per",
    f"""{ctes('located')} SELECT study, CAST(count(*) AS bigint) AS n FROM (SELECT DISTINCT study, locus_ld FROM located) t GROUP BY study""",
)
def _(v):
    return summarise.count_distinct_per(v("located"), "study", "locus_ld")


@query(
    "null_kept_membership",
    f"""{ctes('located')} SELECT study, CAST(count(*) AS bigint) AS n_rows FROM located
WHERE locus IS NULL OR locus NOT IN ('L1_0', 'L2_1', 'L3_2') GROUP BY study""",
)
def _(v):
    kept = v("located").filter(nulls.not_in_("locus", ["L1_0", "L2_1", "L3_2"]))
    return kept.groupBy("study").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "text_filters",
    f"""{ctes('located', 'study_meta')} SELECT l.study, CAST(count(*) AS bigint) AS n_rows FROM located l
WHERE regexp_matches(snp, '^rs[1-4]') AND length(snp) <= 5 AND frq BETWEEN 0.1 AND 0.4 AND locus IS NOT NULL AND line_no <> 3
GROUP BY l.study""",
)
def _(v):
    rows = v("located").filter(
        F.col("snp").rlike("^rs[1-4]")
        & (F.length("snp") <= 5)
        & F.col("frq").between(0.1, 0.4)
        & F.col("locus").isNotNull()
        & (F.col("line_no") != 3)
    )
    return rows.groupBy("study").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "sum_or_null",
    f"""{ctes('located')} SELECT study, line_no, CASE WHEN count(*) = count(locus_ld) THEN CAST(sum(locus_ld) AS bigint) END AS strict,
CAST(coalesce(sum(locus_ld), 0) AS bigint) AS lenient, CAST(sum(coalesce(locus_ld, 0) + line_no) AS bigint) AS across FROM located
GROUP BY study, line_no""",
)
def _(v):
    return v("located").groupBy("study", "line_no").agg(
        nulls.sum_or_null("locus_ld").alias("strict"),
        F.coalesce(F.sum("locus_ld"), F.lit(0)).alias("lenient"),
        F.sum(nulls.row_sum("locus_ld", "line_no")).alias("across"),
    )


# --- scans and group numbers ------------------------------------------------

_GAPPY = """gappy AS (SELECT study, order_id, min(line_no) AS ln, CASE WHEN min(frq) < 0.5 THEN max(odds_ratio) END AS x
  FROM assoc GROUP BY 1, 2)"""


@query(
    "fill_up",
    f"""{ctes('assoc')}, {_GAPPY} SELECT study, order_id, round(coalesce(x, first_value(x IGNORE NULLS) OVER (PARTITION BY study
ORDER BY order_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)), 6) AS x FROM gappy""",
)
def _(v):
    return scans.fill(_gappy(v), "x", ["study"], "order_id", "up").select("study", "order_id", r6("x"))


@query(
    "fill_down",
    f"""{ctes('assoc')}, {_GAPPY} SELECT study, order_id, round(last_value(x IGNORE NULLS) OVER (PARTITION BY study
ORDER BY order_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS x FROM gappy""",
)
def _(v):
    return scans.fill(_gappy(v), "x", ["study"], "order_id").select("study", "order_id", r6("x"))


def _gappy(v):
    return v("assoc").groupBy("study", "order_id").agg(
        F.when(F.min("frq") < 0.5, F.max("odds_ratio")).alias("x")
    )


@query(
    "first_seen_id",
    f"""{ctes('located')}, g AS (SELECT locus, min((chr, bp, snp)) AS place FROM located WHERE locus IS NOT NULL GROUP BY locus)
SELECT locus, CAST(row_number() OVER (ORDER BY place, locus) AS bigint) AS locus_n FROM g""",
)
def _(v):
    rows = v("located").filter("locus IS NOT NULL").select("locus", "chr", "bp", "snp")
    return pick.first_seen_id(rows, "locus", ["chr", "bp", "snp"], "locus_n").select("locus", "locus_n").distinct()


@query(
    "fill_missing_group",
    f"""{ctes('located')} SELECT order_id, line_no, supp_id, snp, locus_ld FROM located WHERE locus_ld IS NOT NULL UNION ALL
SELECT order_id, line_no, supp_id, snp, -row_number() OVER (ORDER BY order_id, line_no, supp_id, snp) AS locus_ld FROM located WHERE locus_ld IS NULL""",
)
def _(v):
    rows = v("located").select(*TIES, "snp", "locus_ld")
    return pick.fill_missing_group(rows, "locus_ld", [*TIES, "snp"])


@query(
    "number_rows",
    f"""{ctes('located')}, l AS (SELECT locus, min(chr) AS chr, min(bp) AS bp FROM located GROUP BY locus)
SELECT locus, CAST(row_number() OVER (ORDER BY chr, bp, locus NULLS FIRST) AS bigint) AS position FROM l""",
)
def _(v):
    rows = v("located").groupBy("locus").agg(F.min("chr").alias("chr"), F.min("bp").alias("bp"))
    return scans.number_rows(rows, ["chr", "bp", "locus"], "position").select("locus", F.col("position").cast("long"))


# --- reshaping and text -----------------------------------------------------


@query(
    "standardise_headers",
    f"""{ctes('assoc')} SELECT snp AS SNP, chr AS CHR, bp AS BP, a1 AS A1, a2 AS A2, round(frq, 6) AS FRQ,
round(odds_ratio, 6) AS OR_, study AS STUDY FROM assoc""",
)
def _(v):
    raw = v("assoc").select(
        F.col("snp").alias("rsid"), F.col("chr").alias("CHROM"), F.col("bp").alias("POS"), F.col("a1").alias("otherAllele"),
        F.col("a2").alias("effectAllele"), r6("frq", "EAF"), r6("odds_ratio", "or"), "study",
    )
    return reshape.standardise_headers(raw).withColumnRenamed("OR", "OR_")


@query(
    "clean_names",
    """SELECT p_partkey AS part_key, p_brand AS c_dna_pos_c_dna_length, p_type AS hgvs_p, p_size AS size_2,
p_name AS errors_warnings_info FROM part""",
)
def _(v):
    raw = v("part").select(
        F.col("p_partkey").alias("partKey"), F.col("p_brand").alias("cDNA.pos / cDNA.length"), F.col("p_type").alias("HGVS.p"),
        F.col("p_size").alias("Size 2"), F.col("p_name").alias("ERRORS / WARNINGS / INFO"),
    )
    return reshape.clean_names(raw)


@query(
    "select_any",
    "SELECT p_partkey, p_size, CAST(NULL AS string) AS p_gene FROM part",
)
def _(v):
    return reshape.select_any(v("part"), ["p_partkey"], {"p_size": "int", "p_gene": "string"})


@query(
    "cast_matching",
    """SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS double) AS brand_percent,
TRY_CAST(CASE WHEN p_size > 25 THEN 'n/a' ELSE CAST(p_size AS string) END AS double) AS size_percent FROM part""",
)
def _(v):
    raw = v("part").select(
        "p_partkey",
        F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("brand_percent"),
        F.when(F.col("p_size") > 25, "n/a").otherwise(F.col("p_size").cast("string")).alias("size_percent"),
    )
    return reshape.cast_matching(raw, "percent$", "double")


@query(
    "unite",
    f"""{ctes('located')} SELECT order_id, line_no, supp_id, snp || '_' || study AS snp_study,
coalesce(locus, 'NA') || ':' || coalesce(CAST(locus_ld AS string), 'NA') AS place FROM located""",
)
def _(v):
    rows = reshape.unite(v("located").select(*TIES, "snp", "study", "locus", "locus_ld"), "snp_study", ["snp", "study"])
    return reshape.unite(rows, "place", ["locus", "locus_ld"], ":")


@query(
    "separate",
    """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS rank, nullif(split_part(o_orderpriority, '-', 2), '') AS word,
CASE WHEN o_orderpriority LIKE '%NOT%' THEN 'SPECIFIED' END AS third FROM orders""",
)
def _(v):
    rows = v("orders").select("o_orderkey", "o_orderpriority")
    halves = reshape.separate(rows, "o_orderpriority", ["rank", "word"], "-", regex=False, keep=True)
    return reshape.separate(halves, "o_orderpriority", ["first", "second", "third"]).select("o_orderkey", "rank", "word", "third")


@query(
    "pivot_wider",
    f"""{ctes('located')} SELECT locus, CAST(count(*) FILTER (study = 'S0') AS bigint) AS s0, CAST(count(*) FILTER (study = 'S1') AS bigint) AS s1,
CAST(count(*) FILTER (study = 'S2') AS bigint) AS s2 FROM located GROUP BY locus""",
)
def _(v):
    counts = v("located").groupBy("locus", "study").agg(F.count(F.lit(1)).alias("n"))
    wide = reshape.pivot_wider(counts, ["locus"], "study", "n", ["S0", "S1", "S2"])
    return wide.select("locus", *[F.coalesce(c, F.lit(0)).alias(c.lower()) for c in ["S0", "S1", "S2"]])


@query(
    "pivot_longer",
    """SELECT s_suppkey, 'nation' AS name, CAST(s_nationkey AS double) AS value FROM supplier UNION ALL
SELECT s_suppkey, 'balance' AS name, round(s_acctbal, 2) AS value FROM supplier""",
)
def _(v):
    wide = v("supplier").select(
        "s_suppkey", F.col("s_nationkey").cast("double").alias("nation"), F.round("s_acctbal", 2).alias("balance")
    )
    return reshape.pivot_longer(wide, ["s_suppkey"], ["nation", "balance"], "name", "value")


@query(
    "expand_grid",
    f"""{ctes('located')} SELECT s.study, l.locus FROM (SELECT DISTINCT study FROM located) s CROSS JOIN (SELECT DISTINCT locus FROM located) l""",
)
def _(v):
    return joins.expand(v("located"), "study", "locus")


@query(
    "with_level",
    f"""{ctes('assoc')} SELECT study, CAST(count(*) AS bigint) AS n, min(CASE study WHEN 'S3' THEN 1 WHEN 'S0' THEN 2 WHEN 'S5' THEN 3 END) AS level
FROM assoc GROUP BY study""",
)
def _(v):
    levelled = reshape.with_level(v("assoc"), "study", ["S3", "S0", "S5"], "level")
    return levelled.groupBy("study").agg(F.count(F.lit(1)).alias("n"), F.min("level").alias("level"))


@query(
    "parse_sci",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 7 THEN NULL
ELSE round(CAST(CAST(CAST(l_quantity AS int) AS string) || '.5e-' || CAST(l_linenumber AS string) AS double), 9) END AS p FROM lineitem""",
)
def _(v):
    shown = F.concat(
        F.col("l_quantity").cast("int"),
        F.lit(".5"),
        F.when(F.col("l_linenumber") % 2 == 0, "!×!10−").when(F.col("l_linenumber") == 7, "!?").otherwise(" × 10−"),
        F.col("l_linenumber"),
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return v("lineitem").select(*keys, F.round(text.parse_sci(shown), 9).alias("p"))


@query(
    "floor_and_cap",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN 1e-300 ELSE p_size / 100.0 END < 1e-200 AS floored,
round(CASE WHEN p_size % 10 = 0 THEN 500.0::double ELSE p_size * 1.5::double END, 6) AS z FROM part""",
)
def _(v):
    shown = F.when(F.col("p_size") > 40, "<1e-9x").otherwise((F.col("p_size") / 100).cast("string"))
    z = F.when(F.col("p_size") % 10 == 0, F.lit(float("inf")) * F.when(F.col("p_size") % 20 == 0, -1).otherwise(1))
    z = z.otherwise(F.col("p_size") * 1.5)
    return v("part").select("p_partkey", (text.floor_p(shown) < 1e-200).alias("floored"), r6(text.cap_infinite(z, 500), "z"))


@query(
    "signif",
    """SELECT s_suppkey, CASE WHEN s_acctbal = 0 THEN s_acctbal ELSE round(round_even(s_acctbal / power(10.0, k - 2), 0) * power(10.0, k - 2), 4) END AS three,
round(round_even(s_acctbal / 100, 0), 4) AS hundreds FROM
(SELECT *, floor(log10(CASE WHEN s_acctbal = 0 THEN 1 ELSE abs(s_acctbal) END)) AS k FROM supplier) t""",
)
def _(v):
    return v("supplier").select(
        "s_suppkey",
        F.round(text.signif("s_acctbal", 3), 4).alias("three"),
        F.round(text.round_even(F.col("s_acctbal") / 100), 4).alias("hundreds"),
    )


@query(
    "text_functions",
    r"""SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '_') AS first_only, regexp_replace(p_name, '[aeiou]', '_', 'g') AS all_of_them,
nullif(regexp_extract(p_brand, '#([0-9]+)', 1), '') AS brand_no, upper(p_name) AS shout, CAST(length(p_name) AS int) AS n_chars,
'chr' || CAST(p_size AS string) || ':' || p_type AS label, coalesce(nullif(CASE WHEN p_size < 9 THEN '' ELSE p_type END, ''), p_brand) AS filled FROM part""",
)
def _(v):
    return v("part").select(
        "p_partkey",
        text.replace_first("p_name", "[aeiou]", "_").alias("first_only"),
        F.regexp_replace("p_name", "[aeiou]", "_").alias("all_of_them"),
        text.first_match("p_brand", "#([0-9]+)", 1).alias("brand_no"),
        F.upper("p_name").alias("shout"),
        F.length("p_name").alias("n_chars"),
        F.concat(F.lit("chr"), "p_size", F.lit(":"), "p_type").alias("label"),
        nulls.coalesce_blank(F.when(F.col("p_size") < 9, "").otherwise(F.col("p_type")), F.col("p_brand")).alias("filled"),
    )


@query(
    "chrom_to_int",
    """SELECT p_partkey, CASE p_size % 30 WHEN 23 THEN 23 WHEN 24 THEN 24 WHEN 25 THEN 25 WHEN 26 THEN 25 WHEN 27 THEN NULL
WHEN 28 THEN 23 ELSE p_size % 30 END AS chr FROM part""",
)
def _(v):
    n = F.col("p_size") % 30
    label = (
        F.when(n == 23, "chrX").when(n == 24, "Y").when(n == 25, "chrM").when(n == 26, "MT").when(n == 27, "chr6_apd")
        .when(n == 28, "X").otherwise(F.concat(F.lit("chr"), n))
    )
    return v("part").select("p_partkey", text.chrom_to_int(label).alias("chr"))


@query(
    "first_rows",
    f"""{ctes('located')} SELECT snp, study, order_id, line_no, supp_id FROM located
ORDER BY chr, bp, order_id, line_no, supp_id LIMIT 100""",
)
def _(v):
    return reshape.sort_genomic(v("located"), "chr", "bp", *TIES).limit(100).select("snp", "study", *TIES)


@query(
    "append_rows",
    f"""{ctes('assoc')} SELECT snp, chr, bp, study, CAST(count(*) AS bigint) AS n FROM (SELECT snp, chr, bp, study FROM assoc UNION ALL
SELECT 'rs1', 7, 28168746, NULL UNION ALL SELECT 'extra', 19, 45412079, NULL) t GROUP BY 1, 2, 3, 4""",
)
def _(v):
    rows = [{"snp": "rs1", "chr": 7, "bp": 28168746}, {"snp": "extra", "chr": 19, "bp": 45412079}]
    both = reshape.append_rows(v("assoc").select("snp", "chr", "bp", "study"), rows, "snp string, chr int, bp bigint")
    return both.groupBy("snp", "chr", "bp", "study").agg(F.count(F.lit(1)).alias("n"))


@query(
    "nest_unnest",
    f"""{ctes('genes')}, k AS (SELECT *, CAST(floor(g_start / 1000000) AS bigint) AS mb FROM genes)
SELECT k.g_chr, k.mb, gene_name, g_start, n FROM k JOIN (SELECT g_chr, mb, CAST(count(*) AS int) AS n FROM k GROUP BY 1, 2) c
ON k.g_chr = c.g_chr AND k.mb = c.mb""",
)
def _(v):
    rows = v("genes").select("g_chr", F.floor(F.col("g_start") / 1000000).cast("long").alias("mb"), "gene_name", "g_start")
    nested = reshape.nest(rows, ["g_chr", "mb"], max_rows=3)
    sizes = nested.groupBy("g_chr", "mb").agg(F.sum(F.size("data")).cast("int").alias("n"))
    return reshape.unnest(nested.drop("part").join(sizes, ["g_chr", "mb"]), "data")


# --- classes and labels -------------------------------------------------------

_CLASSED = f"""{ctes('assoc')}, c AS (SELECT snp, study, frq / 10 AS maf, odds_ratio AS o,
  CASE WHEN odds_ratio > 1 THEN odds_ratio ELSE 1 / odds_ratio END AS effect FROM assoc)"""


def _classed(v):
    return genetics.with_direction(v("assoc").withColumn("maf", F.col("frq") / 10))


@query(
    "architecture_class",
    f"""{_CLASSED} SELECT snp, study, CASE
{' '.join(f"WHEN {fc} AND {ec} THEN '{fl}, {el}'" for fc, fl in [('maf > 0.05', 'Common'), ('maf BETWEEN 0.01 AND 0.05', 'Low'), ('maf BETWEEN 0.001 AND 0.01', 'Rare'), ('maf < 0.001', 'Very Rare')] for ec, el in [('effect > 3', 'High'), ('effect BETWEEN 1.5 AND 3', 'Intermediate'), ('effect BETWEEN 1.1 AND 1.5', 'Moderate'), ('effect < 1.1', 'Low')])}
END AS architecture FROM c""",
)
def _(v):
    return _classed(v).select("snp", "study", classify.architecture_class("maf", "effect").alias("architecture"))


@query(
    "architecture_class_v1",
    f"""{_CLASSED} SELECT snp, study, CASE WHEN (o >= 1.6 OR o <= 0.6) AND maf < 0.001 THEN 'Rare, Moderate'
WHEN (o >= 1.6 OR o <= 0.6) AND maf < 0.05 THEN 'Low, Moderate' WHEN o < 1.6 AND o > 0.6 AND maf < 0.05 THEN 'Low, Low'
WHEN (o > 1.6 OR o < 0.6) AND maf > 0.05 THEN 'Common, High' WHEN o < 1.6 AND o > 0.6 AND maf > 0.05 THEN 'Common, Low' END AS architecture FROM c""",
)
def _(v):
    return _classed(v).select("snp", "study", classify.architecture_class_v1("odds_ratio", "maf").alias("architecture"))


@query(
    "direction_and_effect_bins",
    f"""{_CLASSED} SELECT snp, study, CASE WHEN o > 1 THEN 'risk' ELSE 'protective' END AS dir, round(effect, 6) AS effect,
round(CASE WHEN effect < 1.2 THEN 1 ELSE effect END, 6) AS size,
CASE WHEN effect > 1 AND effect <= 1.1 THEN '1-1.1' WHEN effect > 1.1 AND effect <= 1.2 THEN '1.1-1.2'
WHEN effect > 1.2 AND effect <= 1.3 THEN '1.2-1.3' WHEN effect > 1.3 AND effect <= 1.5 THEN '1.3-1.5'
WHEN effect > 1.5 AND effect <= 2 THEN '1.5-2' WHEN effect > 2 AND effect <= 2.5 THEN '2-2.5'
WHEN effect > 2.5 AND effect <= 3 THEN '2.5-3' WHEN effect > 3 AND effect <= 3.5 THEN '3-3.5' WHEN effect > 3.5 THEN '>4' END AS category FROM c""",
)
def _(v):
    return _classed(v).select("snp", "study", "dir", r6("effect"), r6("size"), classify.effect_bin("effect").alias("category"))


_ANNOTATED = f"""{_TRANSCRIPTS}, q AS (SELECT w.*, substr(snp, 3) AS key, TRY_CAST(substr(snp, 3) AS bigint) % 100 / 1000.0 AS maf,
  0.5 + TRY_CAST(substr(snp, 3) AS bigint) % 20 / 10.0 AS o FROM w WHERE rn = 1),
q2 AS (SELECT *, CASE WHEN o > 1 THEN o ELSE 1 / o END AS effect FROM q)"""


def _annotated(v):
    rows = annotate.annotate_consequence(v("ann"), _FIELDS)
    n = F.substr("snp", F.lit(3)).cast("long")
    return genetics.with_direction(rows.withColumns({"maf": n % 100 / 1000, "odds_ratio": 0.5 + n % 20 / 10}))


@query(
    "group_consequence",
    f"""{_ANNOTATED} SELECT snp, CASE WHEN o < 1.3 AND o > 0.75 AND maf > 0.05 THEN 'Low effect size common variant' ELSE annotation END AS consequence FROM q2""",
)
def _(v):
    return _annotated(v).select("snp", classify.group_consequence("annotation", "odds_ratio", "maf").alias("consequence"))


@query(
    "rare_coding",
    f"""{_ANNOTATED} SELECT snp, gene_name, annotation_impact, round(maf, 6) AS maf FROM q2
WHERE annotation_impact IN ('HIGH', 'MODERATE', 'LOW') AND maf < 0.05""",
)
def _(v):
    return classify.rare_coding(_annotated(v)).select("snp", "gene_name", "annotation_impact", r6("maf"))


_LABEL = """CASE WHEN annotation_impact IN ('HIGH', 'MODERATE', 'LOW') AND maf < 0.05 AND gene_name IN ('Brand#1', 'Brand#2', 'Brand#13')
 THEN gene_name || ' ' || hgvs_p WHEN gene_name LIKE 'Brand#7%' THEN gene_name WHEN gene_name = 'Brand#5' THEN 'Five'
 WHEN gene_name IN ('Brand#1', 'Brand#2', 'Brand#13') THEN gene_name ELSE '' END"""


@query(
    "label_and_highlight",
    f"""{_ANNOTATED}, l AS (SELECT *, {_LABEL} AS label FROM q2) SELECT snp, label,
(label <> 'Brand#2' AND annotation_impact IN ('HIGH', 'MODERATE', 'LOW') AND maf < 0.05 AND effect > 1.3) OR label LIKE 'Brand#7%' AS shp FROM l""",
)
def _(v):
    rows = _annotated(v).withColumns({"gene": F.col("gene_name"), "hgvs_p_new": F.col("hgvs_p")})
    labelled = classify.label_variants(rows, ["Brand#1", "Brand#2", "Brand#13"], "^Brand#7", aliases={"Brand#5": "Five"})
    return classify.highlight(labelled, "^Brand#7", ("Brand#2",)).select("snp", "label", "shp")


# --- power -------------------------------------------------------------------

_META = "meta AS (SELECT *, n_ca + n_cn AS n, (n_ca + n_cn) * (n_ca / (n_ca + n_cn)) * (1 - n_ca / (n_ca + n_cn)) AS neff FROM study_meta)"
_CURVE = f"""{ctes('study_meta', 'cohorts')}, {_META},
grid AS (SELECT i AS place, 1e-7 + i * CAST((0.01 - 1e-7) / 999 AS double) AS maf FROM range(1000) t(i) UNION ALL
  SELECT 1000 + i, 0.01 + i * CAST(0.49 / 499 AS double) FROM range(500) t(i)),
b AS (SELECT study, place, maf, floor(sqrt({power.detectable_ncp()!r}::double / (2 * maf * (1 - maf) * neff)) / (4.0 / 1499)::double) + 1 AS i FROM meta, grid),
curve AS (SELECT study, place, maf, CASE WHEN i <= 1499 THEN i * (4.0 / 1499)::double END AS beta FROM b)"""


def _curve(v, studies: str = "study_meta"):
    n = F.col("n_ca") + F.col("n_cn")
    return power.power_curve(v(studies).withColumn("neff", genetics.neff_phi(n, "n_ca")))


@query(
    "power_curve",
    f"""{_CURVE.replace('FROM study_meta)', 'FROM cohorts)')} SELECT study, CAST(place AS int) AS place, round(maf, 9) AS maf, round(beta, 6) AS beta, round(exp(beta), 6) AS odds_ratio FROM curve""",
)
def _(v):
    return _curve(v, "cohorts").select("study", "place", F.round("maf", 9).alias("maf"), r6("beta"), r6("or", "odds_ratio"))


@query(
    "clean_curve",
    f"""{_CURVE}, f AS (SELECT study, place, maf, beta, first_value(exp(beta) IGNORE NULLS) OVER (PARTITION BY study ORDER BY place
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS o FROM curve),
r AS (SELECT *, row_number() OVER (PARTITION BY study, maf, o ORDER BY place) AS rn FROM f)
SELECT study, round(maf, 9) AS maf, round(o, 6) AS odds_ratio, round(1 / exp(beta), 6) AS inv_or FROM r WHERE rn = 1""",
)
def _(v):
    out = power.clean_curve(_curve(v), STUDIES)
    return out.select("study", F.round("maf", 9).alias("maf"), r6("or", "odds_ratio"), r6("inv_or"))


@query(
    "curve_ribbon",
    f"""{_CURVE}, f AS (SELECT study, place, maf, exp(beta) AS o FROM curve WHERE study IN ('S1', 'S4'))
SELECT round(maf, 9) AS maf, round(max(o) FILTER (study = 'S1'), 6) AS s1, round(max(o) FILTER (study = 'S4'), 6) AS s4 FROM f GROUP BY f.maf""",
)
def _(v):
    out = power.curve_ribbon(_curve(v), "S1", "S4")
    return out.select(F.round("maf", 9).alias("maf"), r6("S1", "s1"), r6("S4", "s4"))


# --- reports -----------------------------------------------------------------

@query(
    "novel_loci",
    f"""{ctes('located')}, SELECT locus, string_agg(DISTINCT CASE WHEN study IN ('S4', 'S5') THEN study END, '&' ORDER BY CASE WHEN study IN ('S4', 'S5') THEN study END) AS found_by
FROM located GROUP BY locus HAVING NOT bool_or(study NOT IN ('S4', 'S5'))""",
)
def _(v):
    return report.novel_loci(v("located"), ["S4", "S5"]).select("locus", "found_by")


@query(
    "novel_loci_by_study",
    f"""{ctes('located')}, nov AS (SELECT locus FROM located GROUP BY locus HAVING NOT bool_or(study NOT IN ('S4', 'S5')))
SELECT study, CAST(count(*) AS bigint) AS n FROM (SELECT DISTINCT s.study, s.locus FROM located s JOIN nov ON s.locus IS NOT DISTINCT FROM nov.locus) t GROUP BY study""",
)
def _(v):
    return report.novel_loci_by_study(v("located"), ["S4", "S5"])


@query(
    "shared_loci",
    f"""{ctes('located')}, SELECT DISTINCT locus FROM located WHERE study = 'S4' INTERSECT SELECT locus FROM located WHERE study = 'S5'""",
)
def _(v):
    return report.shared_loci(v("located"), ["S4", "S5"])


@query(
    "lead_variants",
    f"""{ctes('located', 'study_meta')}, k AS (SELECT * FROM located WHERE locus_ld IS NOT NULL UNION ALL
  SELECT * REPLACE (-row_number() OVER (ORDER BY order_id, line_no, supp_id, snp) AS locus_ld) FROM located WHERE locus_ld IS NULL),
r AS (SELECT k.*, row_number() OVER (PARTITION BY locus_ld ORDER BY 4 / (1.0 / n_ca + 1.0 / n_cn) DESC, order_id, line_no, supp_id, snp) AS rn
  FROM k JOIN study_meta m ON k.study = m.study)
SELECT snp, study, locus, locus_ld, order_id, line_no FROM r WHERE rn = 1 AND (locus IS NULL OR locus <> 'L19_9') UNION ALL
SELECT snp, study, locus, locus_ld, order_id, line_no FROM located WHERE snp LIKE 'rs44%'""",
)
def _(v):
    meta = v("study_meta").select("study", genetics.neff_4("n_ca", "n_cn").alias("neff"))
    out = report.lead_variants(v("located"), meta, [*TIES, "snp"], ["L19_9"], "^rs44")
    return out.select("snp", "study", "locus", "locus_ld", "order_id", "line_no")


@query(
    "discovery_year",
    f"""{ctes('located', 'study_meta')}, k AS (SELECT * FROM located WHERE locus_ld IS NOT NULL UNION ALL
  SELECT * REPLACE (-row_number() OVER (ORDER BY order_id, line_no, supp_id, snp) AS locus_ld) FROM located WHERE locus_ld IS NULL),
r AS (SELECT k.*, study_year, row_number() OVER (PARTITION BY locus_ld ORDER BY study_year, order_id, line_no, supp_id, snp) AS rn
  FROM k JOIN study_meta m ON k.study = m.study)
SELECT locus_ld, snp, study, study_year FROM r WHERE rn = 1""",
)
def _(v):
    return report.discovery_year(v("located"), v("study_meta"), [*TIES, "snp"]).select("locus_ld", "snp", "study", "study_year")


_UPSET = f"""{ctes('located')},
r AS (SELECT study, chr, bp, order_id, line_no, supp_id, CASE WHEN line_no = 7 THEN NULL ELSE p END AS p, CASE WHEN locus IS NOT NULL THEN
  'chr' || CAST(chr AS string) || ':' || CAST(CAST(floor(bp / 2000000) AS bigint) * 2000000 + 12345 AS string) || '-' || CAST(CAST(floor(bp / 2000000) AS bigint) * 2000000 + 1999999 AS string) END AS locus,
  CASE WHEN order_id % 4 = 0 THEN 'V' || CAST(chr AS string) END AS gvc_gene, 'N' || snp AS gencode_gene,
  CASE study WHEN 'S2' THEN 1 WHEN 'S0' THEN 2 WHEN 'S1' THEN 3 WHEN 'S4' THEN 4 WHEN 'S3' THEN 5 WHEN 'S5' THEN 6 END AS y FROM located),
k AS (SELECT * FROM r WHERE locus IS NOT NULL AND y IS NOT NULL),
named AS (SELECT locus, coalesce(gvc_gene, gencode_gene) AS gene, row_number() OVER (ORDER BY chr, bp, locus) AS position FROM
  (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY locus ORDER BY y DESC, order_id, line_no, supp_id, bp) = 1) t),
cells AS (SELECT study, locus, count(*) AS n, count(p) AS hits FROM k GROUP BY 1, 2),
g AS (SELECT s.study, named.*, CASE WHEN gene = 'V7' THEN greatest(coalesce(n, 1), 1) ELSE coalesce(hits, 0) END AS n_sig,
  string_split_regex(named.locus, '[^0-9A-Za-z]+') AS f
  FROM (SELECT DISTINCT study FROM k) s CROSS JOIN named LEFT JOIN cells c ON c.study = s.study AND c.locus = named.locus)"""


def _upset(v):
    start = F.floor(F.col("bp") / 2000000).cast("long") * 2000000
    place = F.concat(F.lit("chr"), "chr", F.lit(":"), start + 12345, F.lit("-"), start + 1999999)
    rows = v("located").select(
        "study", "chr", "bp", *TIES, F.when(F.col("line_no") != 7, F.col("p")).alias("p"),
        F.when(F.col("locus").isNotNull(), place).alias("locus"),
        F.when(F.col("order_id") % 4 == 0, F.concat(F.lit("V"), "chr")).alias("gvc_gene"), F.concat(F.lit("N"), "snp").alias("gencode_gene"),
    )
    return report.upset_table(rows, ["S2", "S0", "S1", "S4", "S3", "S5"], [*TIES, "bp"], always=("V7",))


@query(
    "upset_table",
    f"""{_UPSET} SELECT study, locus, CAST(n_sig AS bigint) AS n_sig, n_sig > 0 AS significant, gene, locus || ' (' || gene || ')' AS label,
f[1] || ':' || regexp_replace(CAST(round_even(CAST(f[2] AS double) / 1000000, 2) AS string), '\\.0$', '') || '-' ||
 regexp_replace(CAST(round_even(CAST(f[3] AS double) / 1000000, 2) AS string), '\\.0$', '') AS short_locus, CAST(position AS bigint) AS position FROM g""",
)
def _(v):
    return _upset(v)


@query(
    "upset_segments",
    f"""{_UPSET}, seg AS (SELECT locus, study, CASE study WHEN 'S3' THEN 1 WHEN 'S1' THEN 2 WHEN 'S2' THEN 3 WHEN 'S0' THEN 4 WHEN 'S5' THEN 5 WHEN 'S4' THEN 6 END AS r FROM g WHERE n_sig > 0)
SELECT locus, arg_min(study, r) AS start_study, arg_max(study, r) AS end_study FROM seg WHERE r IS NOT NULL GROUP BY locus""",
)
def _(v):
    return report.upset_segments(_upset(v), ["S3", "S1", "S2", "S0", "S5", "S4"])


_MEMBERS = f"""{ctes('located')}, m AS (SELECT locus, list_sort(list(DISTINCT study)) AS s FROM located WHERE locus IS NOT NULL GROUP BY locus)"""


@query(
    "membership_reports",
    f"""{_MEMBERS}, g AS (SELECT array_to_string(s, '&') AS region, count(*) AS n FROM m GROUP BY 1)
SELECT locus, array_to_string(s, '&') AS region, NOT list_has_any(s, ['S0', 'S1', 'S2', 'S3']) AS novel, list_has_all(s, ['S4', 'S5']) AS shared,
  CAST(n AS bigint) AS region_loci FROM m JOIN g ON region = array_to_string(s, '&')""",
)
def _(v):
    """Novelty, sharing and regions from one bitmap a locus."""
    seen = membership.study_membership(v("located"), STUDIES)
    new = membership.novel(seen, ["S4", "S5"], STUDIES).select("locus", F.lit(True).alias("novel"))
    sizes = membership.regions(seen, STUDIES).withColumnRenamed("n", "region_loci")
    shared = membership.seen_by_all(["S4", "S5"], STUDIES)
    told = seen.select("locus", F.array_join(membership.names_of(STUDIES), "&").alias("region"), shared.alias("shared"))
    told = told.join(new, "locus", "left").withColumn("novel", F.coalesce("novel", F.lit(False)))
    return joins.lookup_join(told, sizes, ["region"], "inner").select("locus", "region", "novel", "shared", "region_loci")


@query(
    "membership_grid",
    f"""{_MEMBERS} SELECT locus, study, list_contains(s, study) AS reported FROM m, (VALUES ('S0'), ('S1'), ('S2'), ('S3'), ('S4'), ('S5')) t(study)""",
)
def _(v):
    return membership.grid(membership.study_membership(v("located"), STUDIES), STUDIES)


@query(
    "set_regions",
    """SELECT region, CAST(count(*) AS bigint) AS n FROM (SELECT user_id, string_agg(DISTINCT event_type, '&' ORDER BY event_type) AS region
FROM events GROUP BY user_id) t GROUP BY region""",
)
def _(v):
    return summarise.set_regions(v("events"), "user_id", "event_type")


@query(
    "set_regions_by_day",
    """SELECT region, CAST(count(*) AS bigint) AS n FROM (SELECT CAST(user_id AS string) || '_' || CAST(CAST(ts AS date) AS string) AS id,
string_agg(DISTINCT event_type, '&' ORDER BY event_type) AS region FROM events GROUP BY 1) t GROUP BY region""",
)
def _(v):
    rows = v("events").select(F.concat_ws("_", "user_id", F.to_date("ts")).alias("id"), "event_type")
    return summarise.set_regions(rows, "id", "event_type")


@query(
    "expand_members",
    f"""{ctes('study_meta')} SELECT study, study || '_' || CAST(i AS string) AS member FROM study_meta, LATERAL (SELECT unnest(range(1, n_ca + 1)) AS i) t""",
)
def _(v):
    return summarise.expand_members(v("study_meta"), "study", "n_ca")


@query(
    "study_sizes",
    f"""{ctes('study_meta')}, {_META}, l AS (SELECT study || ', ' || CAST(study_year AS string) AS label, study, n, 4 / (1.0 / n_ca + 1.0 / n_cn) AS ne FROM meta)
SELECT label, study, 'Total n' AS model, round(CAST(n AS double), 6) AS sample_size FROM l UNION ALL
SELECT label, study, 'Effective n' AS model, round(ne, 6) AS sample_size FROM l UNION ALL
SELECT label, study, 'Remaining n' AS model, round(n - ne, 6) AS sample_size FROM l""",
)
def _(v):
    meta = v("study_meta").withColumns({"n": F.col("n_ca") + F.col("n_cn"), "neff": genetics.neff_4("n_ca", "n_cn")})
    both = report.study_sizes(meta).unionByName(report.study_sizes(meta, stacked=True).filter("model = 'Remaining n'"))
    return both.withColumn("sample_size", r6("sample_size"))


_TIERS = f"""{ctes('tiers')}, one AS (SELECT gene, min(tier) AS tier, min(locus) AS locus FROM tiers WHERE tier IS NOT NULL GROUP BY gene)"""


@query(
    "tier_categories",
    f"""{_TIERS}, c AS (SELECT locus, count(*) FILTER (tier = 'Tier 1') AS a, count(*) FILTER (tier = 'Tier 2') AS b FROM one GROUP BY locus)
SELECT category, CAST(count(*) AS bigint) AS n FROM (SELECT CASE WHEN a = 1 AND b = 0 THEN 'Tier 1 only' WHEN a = 1 AND b = 1 THEN 'Tier 1 + 2'
WHEN a = 1 AND b > 1 THEN 'Tier 1 + multi Tier 2' WHEN a = 0 AND b = 1 THEN 'Tier 2 only' WHEN a = 0 AND b > 1 THEN 'multi Tier 2' END AS category FROM c) t GROUP BY category""",
)
def _(v):
    return summarise.tier_categories(v("tiers"), "locus")


@query(
    "tier_summary",
    f"""{_TIERS} SELECT t.tier, CAST(count(DISTINCT t.gene) AS bigint) AS n_genes, CAST(count(DISTINCT t.locus) AS bigint) AS n_loci
FROM tiers t JOIN one ON t.gene = one.gene AND t.tier = one.tier GROUP BY t.tier""",
)
def _(v):
    return summarise.tier_summary(v("tiers"), "locus")


@query(
    "collapsed_loci",
    f"""{ctes('located')}, o AS (SELECT DISTINCT snp, 'O' || CAST(locus_ld AS string) AS orig_locus FROM located WHERE locus_ld IS NOT NULL),
m AS (SELECT DISTINCT snp, locus FROM located WHERE locus IS NOT NULL), b AS (SELECT coalesce(o.snp, m.snp) AS snp, orig_locus, locus FROM o FULL JOIN m ON o.snp = m.snp)
SELECT snp, orig_locus, b.locus, CAST(n AS bigint) AS dupe_count FROM b JOIN (SELECT locus, count(*) AS n FROM b GROUP BY locus HAVING count(*) > 1) d
ON b.locus IS NOT DISTINCT FROM d.locus""",
)
def _(v):
    known = v("located")
    original = known.filter("locus_ld IS NOT NULL").select("snp", F.concat(F.lit("O"), "locus_ld").alias("orig_locus")).distinct()
    merged = known.filter("locus IS NOT NULL").select("snp", "locus").distinct()
    return report.collapsed_loci(original, merged).select("snp", "orig_locus", "locus", "dupe_count")


@query(
    "table_s1",
    f"""{ctes('located')}, k AS (SELECT *, floor(log10(frq)) AS kf, floor(log10(odds_ratio)) AS ko FROM located WHERE study NOT IN ('S1', 'S2'))
SELECT locus, locus_ld, snp, chr, bp, round(round_even(frq * power(10.0, 2 - kf), 0) / power(10.0, 2 - kf), 6) AS frq,
 round(round_even(odds_ratio * power(10.0, 2 - ko), 0) / power(10.0, 2 - ko), 6) AS odds_ratio, study FROM k""",
)
def _(v):
    out = report.table_s1(v("located"), ["S1", "S2"])
    return out.select("locus", "locus_ld", "snp", "chr", "bp", r6("frq"), r6("odds_ratio"), "study")


@query(
    "cohort_totals",
    """SELECT data, stage, CAST(sum(cases) AS bigint) AS cases, CASE WHEN count(*) = count(controls) THEN CAST(sum(controls) AS bigint) END AS controls_strict
FROM (SELECT p_brand AS data, p_type AS stage, CAST(p_size AS bigint) AS cases, CASE WHEN p_size < 49 THEN CAST(p_size AS bigint) END AS controls FROM part) t GROUP BY 1, 2""",
)
def _(v):
    size = F.col("p_size").cast("long")
    rows = v("part").select(
        F.col("p_brand").alias("data"), F.col("p_type").alias("stage"), size.alias("cases"), F.when(size < 49, size).alias("controls")
    )
    strict = report.cohort_totals(rows, strict=True).select("data", "stage", F.col("controls").alias("controls_strict"))
    return report.cohort_totals(rows).select("data", "stage", "cases").join(strict, ["data", "stage"])


@query(
    "global_totals",
    """SELECT CAST(sum(p_size) AS bigint) AS cases, CAST(sum(p_size) FILTER (p_size < 49) AS bigint) AS controls FROM part""",
)
def _(v):
    size = F.col("p_size").cast("long")
    return report.cohort_totals(v("part").select(size.alias("cases"), F.when(size < 49, size).alias("controls")), by=())


# --- linkage disequilibrium -----------------------------------------------------

_LD = f"""{ctes('dosage')},
sums AS (SELECT a.chr, a.snp AS snp_a, a.bp AS bp_a, b.snp AS snp_b, b.bp AS bp_b, CAST(count(*) AS bigint) AS n,
  CAST(sum(a.dosage) AS bigint) AS x, CAST(sum(b.dosage) AS bigint) AS y, CAST(sum(a.dosage * b.dosage) AS bigint) AS xy,
  CAST(sum(a.dosage * a.dosage) AS bigint) AS xx, CAST(sum(b.dosage * b.dosage) AS bigint) AS yy
  FROM dosage a JOIN dosage b ON a.sample_id = b.sample_id AND a.chr = b.chr AND b.bp - a.bp BETWEEN 0 AND 1000000
  AND (a.bp < b.bp OR a.snp < b.snp) GROUP BY ALL),
pairs AS (SELECT chr, snp_a, bp_a, snp_b, bp_b, n, CASE WHEN n * xx - x * x > 0 AND n * yy - y * y > 0
  THEN CAST(n * xy - x * y AS double) * (n * xy - x * y) / (CAST(n * xx - x * x AS double) * (n * yy - y * y)) END AS r2 FROM sums),
freq AS (SELECT chr, bp, snp, sum(dosage) / (2 * count(*)) AS f FROM dosage GROUP BY ALL),
panel AS (SELECT chr, bp, snp, least(f, 1 - f) AS maf FROM freq)"""
_CLIP = _LD.replace("WITH ", "WITH RECURSIVE ", 1) + """,
usable AS (SELECT * FROM panel WHERE maf >= 0.001),
edges AS (SELECT p.* FROM pairs p JOIN usable a ON snp_a = a.snp AND p.chr = a.chr JOIN usable b ON snp_b = b.snp AND p.chr = b.chr WHERE r2 >= 0.1),
before AS (SELECT chr, snp_b AS snp, list(snp_a ORDER BY bp_a, snp_a) AS earlier FROM edges GROUP BY ALL),
queue AS (SELECT u.chr, u.snp, coalesce(earlier, []) AS earlier, row_number() OVER (PARTITION BY u.chr ORDER BY bp, u.snp) AS i
  FROM usable u LEFT JOIN before b ON u.chr = b.chr AND u.snp = b.snp),
walk AS (SELECT DISTINCT chr, CAST(0 AS bigint) AS i, CAST([] AS varchar[]) AS kept FROM queue UNION ALL
  SELECT w.chr, q.i, CASE WHEN list_has_any(w.kept, q.earlier) THEN w.kept ELSE list_append(w.kept, q.snp) END
  FROM walk w JOIN queue q ON q.chr = w.chr AND q.i = w.i + 1),
last AS (SELECT chr, kept FROM walk QUALIFY row_number() OVER (PARTITION BY chr ORDER BY i DESC) = 1),
clip AS (SELECT p.chr, p.bp, p.snp, maf, coalesce(list_contains(l.kept, p.snp), false) AS kept,
  CASE WHEN NOT list_contains(l.kept, p.snp) THEN list_filter(earlier, lambda e: list_contains(l.kept, e))[1] END AS keeper
  FROM panel p LEFT JOIN last l ON p.chr = l.chr LEFT JOIN queue q ON q.chr = p.chr AND q.snp = p.snp)"""


# pairs further apart than this are not looked at
_WINDOW = 1_000_000


def _clip(v):
    # pairs and frequencies read one set of planes
    planes = settle(ld.planes(v("calls")))
    pairs = ld.ld_pairs_of_planes(planes, _WINDOW, min_r2=ld.R2_THRESHOLD, min_maf=ld.MAF_THRESHOLD)
    return ld.ld_clip(ld.maf_of_planes(planes), pairs)


@query("ld_pairs", f"{_LD} SELECT chr, snp_a, bp_a, snp_b, bp_b, n, round(r2, 6) AS r2 FROM pairs")
def _(v):
    return ld.ld_pairs(v("calls"), _WINDOW).withColumn("r2", r6("r2"))


@query("ld_maf", f"{_LD} SELECT chr, bp, snp, round(maf, 6) AS maf FROM panel")
def _(v):
    return ld.allele_maf(v("dosage")).withColumn("maf", r6("maf"))


@query("ld_clip", f"{_CLIP} SELECT chr, bp, snp, kept, keeper FROM clip")
def _(v):
    return _clip(v).select("chr", "bp", "snp", "kept", "keeper")


@query(
    "ld_tags",
    f"""{_CLIP}, listed AS (SELECT DISTINCT snp, chr, bp FROM dosage UNION ALL SELECT 'new' || snp, chr, bp + 5 FROM (SELECT DISTINCT snp, chr, bp FROM dosage) t WHERE bp < 20000000)
SELECT l.snp, l.chr, l.bp, coalesce(keeper, l.snp) AS tag, c.snp IS NOT NULL AS in_panel FROM listed l LEFT JOIN clip c ON c.snp = l.snp""",
)
def _(v):
    sites = v("calls").select("snp", "chr", "bp").distinct()
    absent = sites.filter("bp < 20000000").select(F.concat(F.lit("new"), "snp").alias("snp"), "chr", (F.col("bp") + 5).alias("bp"))
    return ld.with_tags(_clip(v), sites.unionByName(absent)).select("snp", "chr", "bp", "tag", "in_panel")


# a panel of all parts: more samples where there are more suppliers, all kinds of genotypes
# Text of the panel that one of its files holds, about.
PANEL_BYTES = 1 << 28
_PANEL_SAMPLES = "200 + (SELECT count(*) FROM supplier)"
_GENOTYPES = [("0|0", 0), ("0|1", 1), ("1|1", 2), ("./.", None), ("1", 1), ("0/1", 1), ("0/0", 0), ("1/2", 2), ("./1", None)]
_PANEL_SQL = f"""WITH points AS (SELECT p_partkey AS k, CAST(p_partkey % 22 + 1 AS int) AS chr, CAST({_BP.format(k='p_partkey')} AS bigint) AS bp FROM part),
calls AS (SELECT *, (k * 7 + i * 13 + (k * i) % 11) % 9 AS g FROM points CROSS JOIN (SELECT unnest(range(0, CAST({_PANEL_SAMPLES} AS bigint))) AS i) s),
dosage AS (SELECT i AS sample_id, chr, bp, 'rs' || CAST(k AS string) AS snp,
  CASE g {' '.join(f"WHEN {i} THEN {d}" for i, (_, d) in enumerate(_GENOTYPES) if d is not None)} END AS dosage FROM calls),
known AS (SELECT * FROM dosage WHERE dosage IS NOT NULL)"""


@query(
    "genotype_ld",
    _LD.replace(ctes("dosage"), _PANEL_SQL).replace("FROM dosage a JOIN dosage b", "FROM known a JOIN known b")
    + " SELECT chr, snp_a, bp_a, snp_b, bp_b, n, round(r2, 6) AS r2 FROM pairs",
)
def _(v):
    """A panel in a variant file, read to bit planes inside its rows, to LD."""
    path = v.folder("panel.vcf")
    n = 200 + v("supplier").count()
    k = F.col("p_partkey")
    call = lambda i: (k * 7 + i * 13 + (k * i) % 11) % 9
    samples = lambda m: F.array_join(
        F.transform(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")), lambda i: F.concat(F.lit("9:"), F.get(F.lit([g for g, _ in _GENOTYPES]), call(i).cast("int")))), "\t"
    )
    # a variant's calls come again after 99 samples, the period of the remainders by 9 and 11 while no key is below 0
    whole, rest = divmod(n, 99)
    again = F.array_join(F.array_repeat(samples(99), whole), "\t")
    texts = F.when(k >= 0, F.concat_ws("\t", again, samples(rest)) if rest else again).otherwise(samples(n))
    # unsplittable as they are packed, the files are as many as there are tasks to read them
    files = max(v.spark.sparkContext.defaultParallelism, v("part").count() * n * 6 // PANEL_BYTES)
    bp = F.expr(_BP.format(k="p_partkey"))
    v("part").repartition(files).select(
        F.concat_ws("\t", k % 22 + 1, bp, F.concat(F.lit("rs"), k), F.lit("A"), F.lit("C,G"), F.lit("."), F.lit("PASS"), F.lit("."),
                    F.lit("DP:GT"), texts).alias("value")
    ).write.text(path, compression="gzip")
    planes = ld.planes_in_row(variants.read_genotypes(v.spark, path))
    return ld.ld_pairs_of_planes(planes, _WINDOW).withColumn("r2", r6("r2"))


_TAGGED = """tagged AS (SELECT snp, chr, bp, 'rs' || CAST(k - k % 3 AS string) AS tag, k % 10 <> 3 AS in_panel
  FROM (SELECT DISTINCT snp, chr, bp, CAST(substr(snp, 3) AS bigint) AS k FROM assoc) t),
firsts AS (SELECT tag, min((CASE WHEN in_panel THEN 0 ELSE 1 END, chr, bp, snp)) AS place FROM tagged GROUP BY tag),
numbered AS (SELECT tag, CAST(row_number() OVER (ORDER BY place, tag) AS bigint) AS locus_ld FROM firsts),
numbers AS (SELECT t.*, locus_ld FROM tagged t JOIN numbered n ON t.tag = n.tag)"""


def _tagged(v, points: DataFrame | None = None):
    k = F.substr("snp", F.lit(3)).cast("long")
    rows = (points or positions(v)).withColumns({"tag": F.concat(F.lit("rs"), k - k % 3), "in_panel": k % 10 != 3})
    return ld.ld_locus_id(rows).withColumn("locus_ld", F.col("locus_ld").cast("long"))


@query("ld_locus_id", f"{ctes('assoc')}, {_TAGGED} SELECT snp, chr, bp, tag, locus_ld FROM numbers")
def _(v):
    return _tagged(v).select("snp", "chr", "bp", "tag", "locus_ld")


@query(
    "clump_leads",
    f"""{ctes('assoc')}, {_TAGGED}, lows AS (SELECT snp, min(p) AS p FROM assoc GROUP BY snp),
r AS (SELECT locus_ld, n.snp, row_number() OVER (PARTITION BY locus_ld ORDER BY p NULLS LAST, chr, bp, n.snp) AS rn FROM numbers n LEFT JOIN lows l ON n.snp = l.snp)
SELECT n.snp, tag, n.locus_ld, r.snp AS tag_clump FROM numbers n JOIN r ON n.locus_ld = r.locus_ld AND rn = 1""",
)
def _(v):
    return ld.clump_leads(_tagged(v), v("assoc")).select("snp", "tag", "locus_ld", "tag_clump")


# --- files: each query writes with one sink and reads back with one source ------

_ASSOC_OUT = """SELECT snp AS SNP, chr AS CHR, bp AS BP, CASE WHEN a1 = 'C' THEN NULL ELSE a1 END AS A1, a2 AS A2,
round(frq, 6) AS FRQ, round(odds_ratio, 6) AS "OR" FROM assoc"""


def _file_rows(v):
    return v("assoc").select(
        F.col("snp").alias("SNP"), F.col("chr").alias("CHR"), F.col("bp").alias("BP"),
        F.when(F.col("a1") != "C", F.col("a1")).alias("A1"), F.col("a2").alias("A2"), r6("frq", "FRQ"), r6("odds_ratio", "OR"),
    )


@query("csv_round_trip", f"{ctes('assoc')} {_ASSOC_OUT}")
def _(v):
    path = v.folder("assoc.csv")
    delimited.write_table(_file_rows(v), path)
    return delimited.read_assoc(v.spark, path, schema_of(["SNP", "CHR", "BP", "A1", "A2", "FRQ", "OR"]))


@query("headerless_tsv_round_trip", f"{ctes('assoc')} {_ASSOC_OUT}")
def _(v):
    path = v.folder("assoc.tsv")
    delimited.write_table(_file_rows(v), path, sep="\t", header=False)
    return delimited.read_assoc(v.spark, path, schema_of(["SNP", "CHR", "BP", "A1", "A2", "FRQ", "OR"]), "\t", header=False)


@query("gzip_sumstats", f"{ctes('assoc')} {_ASSOC_OUT}")
def _(v):
    path = v.folder("sumstats.tsv.gz")
    delimited.write_table(_file_rows(v), path, sep="\t", compression="gzip")
    return delimited.read_sumstats(v.spark, path, schema_of(["SNP", "CHR", "BP", "A1", "A2", "FRQ", "OR"]))


_BLOCKED = ["SNP", "CHR", "BP", "A1", "A2", "FRQ", "OR"]


@query("block_gzip_sumstats", f"{ctes('assoc')} {_ASSOC_OUT}")
def _(v):
    """Gzip in blocks: several tasks read one file."""
    path = v.folder("sumstats")
    blockgzip.write_block_gzip(_file_rows(v), path)
    return blockgzip.read_block_gzip(v.spark, path, schema_of(_BLOCKED), split_bytes=1 << 16)


@query("block_gzip_regions", f"{ctes('assoc')} {_ASSOC_OUT} WHERE (chr = 3 AND bp BETWEEN 20000000 AND 60000000) OR (chr = 7 AND bp >= 150000000) OR (chr = 9 AND bp <= 30000000)")
def _(v):
    """Only the blocks that meet the regions are read."""
    path = v.folder("sumstats")
    blockgzip.write_block_gzip(_file_rows(v).repartitionByRange("CHR", "BP"), path)
    regions = [(3, 20_000_000, 60_000_000), (7, 150_000_000, None), (9, None, 30_000_000)]
    return blockgzip.read_block_gzip(v.spark, path, schema_of(_BLOCKED), regions)


@query(
    "extract_sites_by_place",
    f"""{ctes('assoc', 'sites')} SELECT id, chr, bp, ref, alt, round(af, 6) AS af FROM sites s
WHERE EXISTS (SELECT 1 FROM assoc a WHERE p < 5e-8 AND a.chr = s.chr AND a.bp = s.bp AND a.chr <= 4)""",
)
def _(v):
    """From a layout by place, of which a list of four chromosomes reads the files of these."""
    path = v.folder("sites")
    sites.write_sites(v("sites"), path)
    wanted = genetics.significant(v("assoc")).filter("chr <= 4")
    return sites.sites_at(v.spark, path, wanted).withColumn("af", r6("af"))


@query(
    "match_sites_by_place",
    f"""{ctes('assoc', 'sites')}, vars AS (SELECT DISTINCT snp, chr, bp, a1, a2 FROM assoc WHERE chr <= 4)
SELECT snp, v.chr, v.bp, a1, a2, round(af, 6) AS af FROM vars v JOIN sites s ON v.chr = s.chr AND v.bp = s.bp AND a1 = ref AND a2 = alt
UNION ALL SELECT snp, v.chr, v.bp, a1, a2, round(af, 6) AS af FROM vars v
LEFT JOIN (SELECT * FROM sites WHERE (chr, bp) IN (SELECT (chr, bp) FROM vars)) s ON snp = id WHERE snp IN ('rs3', 'rs6', 'rs7', 'rs99')""",
)
def _(v):
    path = v.folder("sites")
    sites.write_sites(v("sites"), path)
    variants = v("assoc").filter("chr <= 4").select("snp", "chr", "bp", "a1", "a2").distinct()
    near = sites.sites_at(v.spark, path, variants)
    return joins.match_sites(variants, near, ["rs3", "rs6", "rs7", "rs99"]).withColumn("af", r6("af"))


@query(
    "read_studies",
    f"""{ctes('assoc')} SELECT snp AS SNP, chr AS CHR, bp AS BP, a1 AS A1, a2 AS A2, round(frq, 6) AS FRQ, round(odds_ratio, 6) AS "OR",
round(p * 1e8, 6) AS P, CASE WHEN study IN ('S0', 'S1') THEN NULL ELSE 'g' || snp END AS GENE, study FROM assoc""",
)
def _(v):
    names = ["SNP", "CHR", "BP", "A1", "A2", "FRQ", "OR", "P"]
    files = {}
    rows = v("assoc")
    for study in STUDIES:
        own = rows.filter(F.col("study") == study).select(
            F.col("snp").alias("SNP"), F.col("chr").alias("CHR"), F.col("bp").alias("BP"), F.col("a1").alias("A1"),
            F.col("a2").alias("A2"), r6("frq", "FRQ"), r6("odds_ratio", "OR"), r6(F.col("p") * 1e8, "P"),
            F.concat(F.lit("g"), "snp").alias("GENE"),
        )
        columns = names if study in ("S0", "S1") else [*names, "GENE"]
        path = v.folder(f"{study}.csv")
        delimited.write_table(own.select(*columns), path)
        files[study] = (path, schema_of(columns))
    return delimited.read_studies(v.spark, files)


@query(
    "vcf_round_trip",
    f"""{ctes('assoc')}, r AS (SELECT *, row_number() OVER (PARTITION BY snp ORDER BY order_id, line_no, supp_id) AS rn FROM assoc)
SELECT CAST(chr AS string) AS chrom, bp AS pos, a1 AS ref, a2 AS alt, snp, study, round(odds_ratio, 6) AS odds_ratio FROM r WHERE rn = 1""",
)
def _(v):
    path = v.folder("variants.vcf")
    rows = pick.first_per(v("assoc"), ["snp"], TIES).withColumns({"or": r6("odds_ratio")})
    variants.write_vcf(rows.select("chr", "bp", "a1", "a2", "snp", "or", "study"), path, ["snp", "or", "study"])
    sample = F.get("samples", F.lit(0))
    return variants.read_vcf(v.spark, path).select(
        "chrom", "pos", "ref", "alt", sample["SNP"].alias("snp"), sample["STUDY"].alias("study"),
        sample["OR"].cast("double").alias("odds_ratio"),
    )


@query("vcf_consequence", f"{_TRANSCRIPTS} SELECT snp, {', '.join(_FIELDS)} FROM w WHERE rn = 1")
def _(v):
    path = v.folder("annotated.vcf")
    shown = " | ".join(["Allele", "Annotation", "Annotation_Impact", "Gene_Name", "BioType", "HGVS.p"])
    head = [f"##INFO=<ID=ANN,Number=.,Type=String,Description=\"Annotations: '{shown}' \">"]
    lines = v("ann").select(
        F.concat_ws("\t", F.lit("1"), F.lit("1"), F.lit("."), F.lit("A"), F.lit("C"), F.lit("."), F.lit("."),
                    F.concat(F.lit("DB;ANN="), "ann"), F.lit("SNP"), "snp").alias("value")
    )
    lines.unionByName(v.spark.createDataFrame([(h,) for h in head], "value string")).write.text(path)
    fields = variants.ann_fields(variants.vcf_header(v.spark, path))
    rows = variants.read_vcf(v.spark, path).select(
        F.get("samples", F.lit(0))["SNP"].alias("snp"), F.col("info")["ANN"].alias("ann")
    )
    out = annotate.annotate_consequence(rows, fields, biotype="BioType")
    return reshape.clean_names(out.withColumnsRenamed({"BioType": "biotype", "HGVS.p": "hgvs_p"}))


@query(
    "vcf_site_frequency",
    f"""{ctes('sites')} SELECT chr, bp, id, ref, alt, round(af, 6) AS af, CASE WHEN af > 0.5 THEN round(af / 2, 6) END AS af_afr FROM sites""",
)
def _(v):
    path = v.folder("sites.vcf")
    info = F.concat_ws(
        ";", F.lit("DB"), F.concat(F.lit("AF="), r6("af")), F.when(F.col("af") > 0.5, F.concat(F.lit("AF_afr="), r6(F.col("af") / 2, "h")))
    )
    v("sites").select(
        F.concat_ws("\t", "chr", "bp", "id", "ref", "alt", F.lit("."), F.lit("PASS"), info).alias("value")
    ).write.text(path)
    return variants.site_frequencies(variants.read_vcf(v.spark, path), ["AF", "AF_afr"])


@query(
    "gtf_genes",
    f"""{ctes('genes')} SELECT CASE WHEN g_chr = 20 THEN 23 ELSE g_chr END AS chr, g_start AS "start", g_end AS "end", gene_name, 'HGNC:' || CAST(gene_ord AS string) AS hgnc_id
FROM genes WHERE gene_ord % 4 <> 1 AND g_chr <> 22 AND gene_ord % 5 <> 2""",
)
def _(v):
    path = v.folder("genes.gtf")
    n = F.col("gene_ord")
    chrom = F.when(F.col("g_chr") == 20, "X").when(F.col("g_chr") == 22, "GL000").otherwise(F.col("g_chr").cast("string"))
    attributes = F.concat(
        F.lit('gene_id "E'), n, F.lit('"; gene_type "'), F.when(n % 4 == 1, "lncRNA").otherwise("protein_coding"),
        F.lit('"; gene_name "'), "gene_name", F.lit('"; level 2;'),
        F.when(n % 5 == 2, "").otherwise(F.concat(F.lit(' hgnc_id "HGNC:'), n, F.lit('";'))),
    )
    rows = v("genes").select(F.explode(F.array(F.lit("gene"), F.lit("exon"))).alias("kind"), "*").select(
        F.concat_ws("\t", F.concat(F.lit("chr"), chrom), F.lit("HAVANA"), "kind", "g_start", "g_end", F.lit("."), F.lit("+"), F.lit("."), attributes).alias("value")
    )
    rows.write.text(path)
    return genome.read_genes(v.spark, path)


@query(
    "band_file",
    f"""{ctes('genes')} SELECT CASE WHEN g_chr = 21 THEN 23 WHEN g_chr = 22 THEN 24 ELSE g_chr END AS chr, g_start AS band_start, g_end AS band_end,
CAST(CASE WHEN g_chr = 21 THEN 23 WHEN g_chr = 22 THEN 24 ELSE g_chr END AS string) || gene_name AS cytoband FROM genes WHERE g_chr <> 13""",
)
def _(v):
    path = v.folder("bands.tsv")
    c = F.col("g_chr")
    chrom = F.when(c == 21, "chrX").when(c == 22, "chrY").when(c == 13, "chr6_apd_hap1").otherwise(F.concat(F.lit("chr"), c))
    rows = v("genes").select(chrom.alias("#chrom"), "g_start", "g_end", F.col("gene_name").alias("name"), F.lit("gneg").alias("stain"))
    delimited.write_table(rows, path, "\t")
    return genome.read_bands(v.spark, path).select("chr", "band_start", "band_end", "cytoband")


@query(
    "bed_round_trip",
    f"""{ctes('assoc')} SELECT DISTINCT 'chr' || CAST(chr AS string) AS chrom, CASE WHEN bp - 500000 < 0 THEN 1 ELSE bp - 500000 END AS s,
bp + 500000 AS e, snp || '_' || study AS name FROM assoc""",
)
def _(v):
    path = v.folder("regions.bed")
    rows = reshape.unite(v("assoc").select("snp", "study", "chr", "bp").distinct(), "name", ["snp", "study"])
    genome.write_bed(intervals.flank(rows), path)
    schema = "chrom string, s bigint, e bigint, name string"
    return v.spark.read.schema(schema).option("sep", "\t").csv(path)


@query(
    "nested_parquet",
    f"""{ctes('genes')} SELECT g_chr, CAST(floor(g_start / 1000000) AS bigint) AS mb, gene_name, g_start FROM genes""",
)
def _(v):
    path = v.folder("nested.parquet")
    rows = v("genes").select("g_chr", F.floor(F.col("g_start") / 1000000).cast("long").alias("mb"), "gene_name", "g_start")
    delimited.write_nested(reshape.nest(rows, ["g_chr", "mb"]).drop("part"), path, "g_chr")
    back = v.spark.read.schema("mb bigint, data array<struct<gene_name: string, g_start: bigint>>, g_chr int").parquet(path)
    return reshape.unnest(back, "data")


# --- studies and the architecture table ------------------------------------------

_PRINTED = """printed AS (SELECT snp, chr, bp, a1, a2, 'g' || snp AS gene, round(frq, 3) AS frq, round(odds_ratio, 2) AS o, round(l95, 2) AS l95, round(u95, 2) AS u95,
  CAST(CAST(order_id % 9 + 1 AS string) || '.5e-' || CAST(CAST(supp_id % 8 + 5 AS bigint) AS string) AS double) AS p, order_id, line_no, supp_id
  , study FROM assoc)"""


@query(
    "clean_study",
    f"""{ctes('assoc', 'sites')}, {_PRINTED},
best AS (SELECT * FROM printed WHERE p < 5e-8 QUALIFY row_number() OVER (PARTITION BY study, snp ORDER BY p, bp, frq, o, l95, u95) = 1),
pairs AS (SELECT DISTINCT chr, bp, least(ref, alt) AS x, greatest(ref, alt) AS y FROM sites),
found AS (SELECT b.* FROM best b JOIN pairs s ON b.chr = s.chr AND b.bp = s.bp AND least(a1, a2) = x AND greatest(a1, a2) = y
  QUALIFY row_number() OVER (PARTITION BY study, b.chr, b.bp, x, y ORDER BY p, b.bp, frq, o, l95, u95) = 1),
u AS (SELECT * FROM found UNION ALL SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.study = b.study AND f.chr = b.chr AND f.bp = b.bp))
SELECT study, snp, chr, bp, a1, a2, gene, frq, o AS odds_ratio, round(p * 1e9, 6) AS p_e9, round(ln(o), 6) AS beta, round((ln(o) - ln(l95)) / 1.96, 6) AS se,
round(ln(o) / ((ln(o) - ln(l95)) / 1.96), 6) AS z FROM u""",
)
def _(v):
    text_of = lambda c, n: F.round(c, n).cast("string")
    raw = v("assoc").select(
        "study", "snp", F.col("chr").cast("string").alias("chr"), F.col("bp").cast("string").alias("pos"), F.concat(F.lit("g"), "snp").alias("gene"),
        F.concat_ws("/", "a1", "a2").alias("alleles"), text_of("frq", 3).alias("maf"), text_of("odds_ratio", 2).alias("or"),
        F.concat(F.lit("("), text_of("l95", 2), F.lit("–"), text_of("u95", 2), F.lit(")")).alias("ci"),
        F.concat(F.col("order_id") % 9 + 1, F.lit(".5 × 10−"), F.col("supp_id") % 8 + 5).alias("p"),
    )
    out = study.clean_study(raw, v("sites"), ["p", "bp", "frq", "odds_ratio", "l95", "u95"])
    return out.select("study", "snp", "chr", "bp", "a1", "a2", "gene", "frq", "odds_ratio", r6(F.col("p") * 1e9, "p_e9"), r6("beta"), r6("se"), r6("z"))


@query(
    "loci_list",
    f"""{ctes('assoc', 'sites', 'study_meta')},
best AS (SELECT a.* FROM assoc a JOIN study_meta m ON a.study = m.study
  QUALIFY row_number() OVER (PARTITION BY chr, bp ORDER BY 4 / (1.0 / n_ca + 1.0 / n_cn) DESC, order_id, line_no, supp_id) = 1),
pairs AS (SELECT chr AS s_chr, bp AS s_bp, least(ref, alt) AS x, greatest(ref, alt) AS y, min((ref, alt)) AS s FROM sites GROUP BY ALL),
found AS (SELECT b.*, s[1] AS ref, s[2] AS alt FROM best b JOIN pairs ON chr = s_chr AND bp = s_bp AND least(a1, a2) = x AND greatest(a1, a2) = y)
SELECT snp, chr, bp, ref AS a1, alt AS a2, round(CASE WHEN a1 <> ref THEN 1 / odds_ratio ELSE odds_ratio END, 6) AS odds_ratio, study, order_id FROM found
UNION ALL SELECT snp, chr, bp, a1, a2, round(odds_ratio, 6) AS odds_ratio, study, order_id FROM best b
WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.chr = b.chr AND f.bp = b.bp)""",
)
def _(v):
    meta = v("study_meta").select("study", genetics.neff_4("n_ca", "n_cn").alias("neff"))
    out = study.loci_list(v("assoc"), meta, v("sites"), TIES)
    return out.select("snp", "chr", "bp", "a1", "a2", r6("odds_ratio"), "study", "order_id")


@query(
    "architecture_table",
    f"""{_TRANSCRIPTS.replace(ctes('ann'), ctes('ann', 'located', 'study_meta'))}, base AS (SELECT l.*, frq / 10 AS gnomad_maf, w.annotation_impact, w.gene_name, w.hgvs_p
  FROM located l LEFT JOIN w ON l.snp = w.snp AND w.rn = 1),
k AS (SELECT * FROM base WHERE locus_ld IS NOT NULL UNION ALL
  SELECT * REPLACE (-row_number() OVER (ORDER BY order_id, line_no, supp_id, snp) AS locus_ld) FROM base WHERE locus_ld IS NULL),
lead AS (SELECT k.* FROM k JOIN study_meta m ON k.study = m.study
  QUALIFY row_number() OVER (PARTITION BY locus_ld ORDER BY 4 / (1.0 / n_ca + 1.0 / n_cn) DESC, order_id, line_no, supp_id, snp) = 1),
kept AS (SELECT *, gnomad_maf AS maf, CASE WHEN odds_ratio > 1 THEN odds_ratio ELSE 1 / odds_ratio END AS effect FROM lead WHERE locus IS NULL OR locus <> 'L19_9'),
l AS (SELECT *, {_LABEL.replace("WHEN gene_name = 'Brand#5' THEN 'Five'", "")} AS label FROM kept)
SELECT snp, study, locus, locus_ld, label, round(effect, 6) AS effect, CASE WHEN odds_ratio > 1 THEN 'risk' ELSE 'protective' END AS dir,
(label <> 'Brand#2' AND annotation_impact IN ('HIGH', 'MODERATE', 'LOW') AND maf < 0.05 AND effect > 1.3) OR label LIKE 'Brand#7%' AS shp,
CASE {' '.join(f"WHEN {fc} AND {ec} THEN '{fl}, {el}'" for fc, fl in [('maf > 0.05', 'Common'), ('maf BETWEEN 0.01 AND 0.05', 'Low'), ('maf BETWEEN 0.001 AND 0.01', 'Rare'), ('maf < 0.001', 'Very Rare')] for ec, el in [('effect > 3', 'High'), ('effect BETWEEN 1.5 AND 3', 'Intermediate'), ('effect BETWEEN 1.1 AND 1.5', 'Moderate'), ('effect < 1.1', 'Low')])} END AS architecture FROM l""",
)
def _(v):
    change = annotate.annotate_consequence(v("ann"), _FIELDS).select(
        "snp", "annotation_impact", "gene_name", F.col("gene_name").alias("gene"), F.col("hgvs_p").alias("hgvs_p_new")
    )
    rows = v("located").withColumn("gnomad_maf", F.col("frq") / 10).join(change, "snp", "left")
    meta = v("study_meta").select("study", genetics.neff_4("n_ca", "n_cn").alias("neff"))
    genes = ["Brand#1", "Brand#2", "Brand#13"]
    out = study.architecture_table(rows, meta, [*TIES, "snp"], genes, "^Brand#7", ["L19_9"], ("Brand#2",))
    return out.select("snp", "study", "locus", "locus_ld", "label", r6("effect"), "dir", "shp", "architecture")


# --- the final annotated table ---------------------------------------------------

_COMBINE = f"""{ctes('assoc', 'bands', 'sites', 'genes', 'tiers', 'ann')}, {_SIG}, {_LOCI}, {_TAGGED},
extra AS (SELECT 'FAM 22' AS snp, 19 AS chr, 45412079 AS bp, 'TT/CC' AS a1, 'TT/TT' AS a2, 0.007::double AS frq, 0.42::double AS odds_ratio, 'X' AS study
  UNION ALL SELECT 'FAM 44', 19, 45412079, 'TT/CC', 'CC/CC', 0.028::double, 12.28::double, 'X'),
rows_ AS (SELECT snp, chr, bp, a1, a2, frq, odds_ratio, study, order_id, line_no, supp_id FROM assoc
  UNION ALL SELECT snp, chr, bp, a1, a2, frq, odds_ratio, study, NULL, NULL, NULL FROM extra),
placed AS (SELECT t.snp, l.locus, CAST(b.b_chr AS string) || b.band AS cytoband, locus_ld FROM numbers t
  LEFT JOIN loci l ON t.chr = l_chr AND t.bp <= l_end AND t.bp + 1 >= l_start
  LEFT JOIN bands b ON t.chr = b_chr AND t.bp <= band_end AND t.bp + 1 >= band_start),
donor AS (SELECT {{'l': locus, 'c': cytoband, 'i': locus_ld}} AS d FROM placed WHERE snp = 'rs8' ORDER BY locus NULLS FIRST, cytoband NULLS FIRST LIMIT 1),
freq AS (SELECT id AS snp, CASE WHEN af > 0.5 THEN alt ELSE ref END AS major, CASE WHEN af > 0.9 THEN NULL WHEN af < 0.5 THEN alt ELSE ref END AS minor,
  CASE WHEN af > 0.5 THEN 1 - af ELSE af END AS global_maf FROM sites),
vars AS (SELECT DISTINCT snp, chr, bp, a1, a2 FROM assoc),
pop AS (SELECT snp, CASE WHEN af > 0.5 THEN 1 - af ELSE af END AS gnomad_maf, CASE WHEN af > 0.5 THEN ref ELSE alt END AS gnomad_minor
  FROM vars v JOIN sites s ON v.chr = s.chr AND v.bp = s.bp AND a1 = ref AND a2 = alt),
pts AS (SELECT DISTINCT snp, chr, bp FROM assoc),
near_ AS (SELECT snp, bp, g_end, gene_ord, gene_name, gene_name IN (SELECT gene FROM tiers WHERE tier = 'Tier 1') AS listed,
  CASE WHEN bp BETWEEN g_start AND g_end THEN 0 ELSE least(abs(bp - g_start), abs(bp - g_end)) END AS d FROM pts JOIN genes ON chr = g_chr),
gen AS (SELECT snp, gene_name AS gencode_gene, CAST(d AS bigint) AS gencode_dist,
  CASE WHEN d = 0 THEN 'intragenic' WHEN bp > g_end THEN 'downstream' ELSE 'upstream' END AS direction FROM near_ QUALIFY row_number() OVER (PARTITION BY snp ORDER BY d, gene_ord) = 1),
gvc AS (SELECT snp, CASE WHEN d <= 500000 THEN gene_name END AS gvc_gene, CAST(CASE WHEN d <= 500000 THEN d END AS bigint) AS gvc_dist FROM near_ WHERE listed QUALIFY row_number() OVER (PARTITION BY snp ORDER BY d, gene_ord) = 1),
parts AS (SELECT snp, string_split(unnest(string_split(ann, ',')), '|') AS f, generate_subscripts(string_split(ann, ','), 1) AS place FROM ann),
cons AS (SELECT snp, f[1] AS allele, f[3] AS annotation_impact, regexp_replace(replace(replace(f[6], 'Arg', 'R'), 'Ile', 'I'), '^p\\.', '') AS h
  FROM parts WHERE f[5] IN ('', 'protein_coding') QUALIFY row_number() OVER (PARTITION BY snp ORDER BY place) = 1),
j AS (SELECT r.*, CASE WHEN fam THEN d.l ELSE locus END AS locus, CASE WHEN fam THEN d.c ELSE cytoband END AS cytoband,
  CASE WHEN fam THEN d.i ELSE locus_ld END AS locus_ld, CASE WHEN fam THEN r.a1 ELSE major END AS major, CASE WHEN fam THEN r.a2 WHEN r.snp IN ('rs7', 'rs16') THEN gnomad_minor ELSE minor END AS minor,
  global_maf, gnomad_minor, CASE WHEN fam THEN r.frq WHEN r.snp = 'rs5' THEN 0.3829 ELSE gnomad_maf END AS gnomad_maf,
  gencode_gene, gencode_dist, direction, gvc_gene, gvc_dist, allele, annotation_impact, h
  FROM (SELECT *, snp LIKE 'FAM%' AS fam FROM rows_) r LEFT JOIN placed p ON r.snp = p.snp LEFT JOIN freq ON r.snp = freq.snp LEFT JOIN pop ON r.snp = pop.snp
  LEFT JOIN gen ON r.snp = gen.snp LEFT JOIN gvc ON r.snp = gvc.snp LEFT JOIN cons ON r.snp = cons.snp, (SELECT d FROM donor) dd(d)),
k AS (SELECT *, {_FLIP} AS flip, nullif(regexp_extract(h, '[0-9]+'), '') AS n FROM j)"""


@query(
    "combine",
    f"""{_COMBINE} SELECT snp, chr, bp, study, order_id, line_no, supp_id, locus, cytoband, locus_ld,
CASE WHEN flip IS NULL THEN NULL WHEN flip THEN a2 ELSE a1 END AS a1, CASE WHEN flip IS NULL THEN NULL WHEN flip THEN minor ELSE a2 END AS a2,
round(CASE WHEN flip IS NULL THEN NULL WHEN flip THEN 1 - frq ELSE frq END, 6) AS frq,
round(CASE WHEN flip IS NULL THEN NULL WHEN flip THEN 1 / odds_ratio ELSE odds_ratio END, 6) AS odds_ratio,
major, minor, round(global_maf, 6) AS global_maf, gnomad_minor, round(gnomad_maf, 6) AS gnomad_maf, gencode_gene, gencode_dist, direction, gvc_gene, gvc_dist,
annotation_impact, h AS hgvs_p, CASE WHEN n IS NULL THEN NULL WHEN minor = allele THEN split_part(h, n, 1) || n || split_part(h, n, 2)
 WHEN minor <> allele THEN split_part(h, n, 2) || n || split_part(h, n, 1) END AS hgvs_p_new FROM k""",
)
def _(v):
    spans = lambda d, c, s, e: d.withColumnsRenamed({c: "chr", s: "start", e: "end"})
    assoc, sites = v("assoc").withColumn("gene", F.concat(F.lit("near "), "snp")), v("sites")
    extra = v.spark.createDataFrame(
        [
            ("FAM 22", 19, 45412079, "TT/CC", "TT/TT", "FAM e2/e2", 0.007, 0.42, "X"),
            ("FAM 44", 19, 45412079, "TT/CC", "CC/CC", "FAM e4/e4", 0.028, 12.28, "X"),
            ("rs1", 21, 27269932, "C", "T", "OTHER", 0.0003, 0.23, "Y"),
        ],
        "snp string, chr int, bp bigint, a1 string, a2 string, gene string, frq double, odds_ratio double, study string",
    )
    vars_ = settle(assoc.select("snp", "chr", "bp", "a1", "a2").distinct())
    points = settle(vars_.select("snp", "chr", "bp").distinct())
    major, minor = genetics.major_minor("af", "ref", "alt")
    frequency = sites.select(
        F.col("id").alias("snp"), major.alias("major"), F.when(F.col("af") <= 0.9, minor).alias("minor"),
        genetics.fold_maf("af", "ref", "alt")[0].alias("global_maf"),
    )
    population = annotate.annotate_frequency(vars_, sites).select("snp", "gnomad_minor", "gnomad_maf")
    on = ("g_chr", "g_start", "g_end")
    passing = v("tiers").filter("tier = 'Tier 1'").select(F.col("gene").alias("gene_name"))
    sets = {"all": v("genes"), "listed": v("genes").join(passing, "gene_name", "left_semi")}
    near = nearest_in_sets(points, sets, interval_on=on, max_dist={"listed": 500_000})
    near_all = near["all"].select("snp", F.col("gene_name").alias("gencode_gene"), F.col("dist").alias("gencode_dist"), "direction")
    near_listed = near["listed"].select("snp", F.col("gene_name").alias("gvc_gene"), F.col("dist").alias("gvc_dist"))
    out = annotate.combine(
        assoc=assoc,
        extra=extra,
        tags=_tagged(v, points),
        loci=intervals.define_loci(genetics.significant(assoc)),
        bands=spans(v("bands"), "b_chr", "band_start", "band_end").select(
            "chr", "start", "end", F.concat(F.col("chr"), F.col("band")).alias("cytoband")
        ),
        frequency=frequency,
        population=population,
        nearest_gene=near_all,
        nearest_listed=near_listed,
        consequence=annotate.annotate_consequence(v("ann"), _FIELDS).select("snp", "allele", "annotation_impact", "hgvs_p"),
        family="^FAM",
        family_source="rs8",
        repairs={
            "minor": F.when(F.col("snp").isin("rs7", "rs16"), F.col("gnomad_minor")).otherwise(F.col("minor")),
            "gnomad_maf": F.when(F.col("snp") == "rs5", F.lit(0.3829)).otherwise(F.col("gnomad_maf")),
        },
    )
    return out.select(
        "snp", "chr", "bp", "study", *TIES, "locus", "cytoband", "locus_ld", "a1", "a2", r6("frq"), r6("odds_ratio"), "major", "minor",
        r6("global_maf"), "gnomad_minor", r6("gnomad_maf"), "gencode_gene", "gencode_dist", "direction", "gvc_gene", "gvc_dist", "annotation_impact", "hgvs_p", "hgvs_p_new",
    )
