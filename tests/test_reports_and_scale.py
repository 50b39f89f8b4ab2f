"""Reports on small tables, and the shape of the plans on which scale rests."""

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lociflow import scale
from lociflow.operators import cells, intervals, joins, ld, membership, pick, summarise
from lociflow.operators.nearest import nearest
from lociflow.plans import annotate, report


def plan(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def located(spark):
    data = [("S1", "A", 1), ("S2", "A", 1), ("S2", "B", None), ("S3", "B", None), ("S3", None, 2), ("S2", "C", 4), ("S2", "C", 5)]
    return spark.createDataFrame(data, "study string, locus string, locus_ld int")


def test_novel_and_shared_loci(spark):
    df = located(spark)
    assert rows(report.novel_loci(df, ["S2", "S3"]), "locus", "found_by") == [(None, "S3"), ("B", "S2&S3"), ("C", "S2")]
    assert rows(report.novel_loci_by_study(df, ["S2", "S3"])) == [("S2", 2), ("S3", 2)]
    assert rows(report.shared_loci(df, ["S2", "S3"])) == [("B",)]
    assert rows(summarise.count_distinct_per(df, "study", "locus")) == [("S1", 1), ("S2", 3), ("S3", 2)]


def test_leads_years_and_segments(spark):
    df = located(spark).withColumns({"snp": F.concat(F.lit("v"), F.monotonically_increasing_id()), "o": F.monotonically_increasing_id()})
    meta = spark.createDataFrame([("S1", 5.0, 2013), ("S2", 9.0, 2022), ("S3", None, 2019)], "study string, neff double, study_year int")
    got = report.lead_variants(df, meta, ["snp"], exclude=["C"])
    assert rows(got, "locus_ld", "study") == [(-2, "S3"), (-1, "S2"), (1, "S2"), (2, "S3")]
    assert rows(report.discovery_year(df.filter("locus_ld = 1"), meta, ["snp"]), "study", "study_year") == [("S1", 2013)]
    assert rows(report.discovery_year(df, meta, ["snp"]), "locus_ld", "study_year") == [(-2, 2019), (-1, 2022), (1, 2013), (2, 2019), (4, 2022), (5, 2022)]
    both = spark.createDataFrame([("A&B", "x"), ("C", "x")], "study string, locus string")
    assert rows(report.novel_loci_by_study(both, ["A&B", "C"])) == [("A&B", 1), ("C", 1)]
    grid = df.select("study", "locus").distinct().withColumn("significant", ~((F.col("study") == "S3") & F.col("locus").eqNullSafe("B")))
    seg = report.upset_segments(grid, ["S3", "S2", "S1"])
    assert rows(seg) == [(None, "S3", "S3"), ("A", "S2", "S1"), ("B", "S2", "S2"), ("C", "S2", "S2")]


def test_upset_grid(spark):
    df = spark.createDataFrame(
        [("S1", "chr1:485377-1485377", 1, 9, 1e-9, None, "n1"), ("S2", "chr1:485377-1485377", 1, 8, None, "v2", "n2"),
         ("S2", "chr1:5000000-6500000", 1, 5, 1e-9, None, "APOE"), ("S2", "chr1:5000000-6500000", 1, 6, 1e-8, None, "n4"),
         ("S1", None, 1, 5, 1e-9, None, "x"), ("S9", "chr1:5000000-6500000", 1, 5, 1e-9, None, "x")],
        "study string, locus string, chr int, bp int, p double, gvc_gene string, gencode_gene string",
    )
    got = report.upset_table(df, ["S1", "S2"], ["bp"], always=("APOE",))
    assert rows(got, "position", "study", "short_locus", "gene", "n_sig", "significant") == [
        (1, "S1", "chr1:5-6.5", "APOE", 1, True), (1, "S2", "chr1:5-6.5", "APOE", 2, True),
        (2, "S1", "chr1:0.49-1.49", "v2", 1, True), (2, "S2", "chr1:0.49-1.49", "v2", 0, False),
    ]


def test_sets_members_tiers_cohorts(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "a"), (3, "a"), (3, "b")], "id int, s string")
    assert rows(summarise.set_regions(df, "id", "s")) == [("a", 1), ("a&b", 2)]
    cohorts = spark.createDataFrame([("x", 3), ("y", 0), ("z", None)], "c string, n bigint")
    assert rows(summarise.expand_members(cohorts, "c", "n"), "member") == [("x_1",), ("x_2",), ("x_3",)]
    tiers = spark.createDataFrame(
        [("L1", "g1", "Tier 1"), ("L1", "g2", "Tier 2"), ("L1", "g2", "Tier 2"), ("L2", "g3", "Tier 1"), ("L2", "g4", "Tier 1"), ("L3", "g5", None), ("L4", "g6", "Tier 2")],
        "locus string, gene string, tier string",
    )
    assert rows(summarise.tier_categories(tiers, "locus")) == [(None, 1), ("Tier 1 + 2", 1), ("Tier 2 only", 1)]
    assert rows(summarise.tier_summary(tiers, "locus")) == [("Tier 1", 3, 2), ("Tier 2", 2, 2)]
    data = spark.createDataFrame([("NGS", "d", 1, 2), ("NGS", "d", 3, None)], "data string, stage string, cases int, controls int")
    assert rows(report.cohort_totals(data), "cases", "controls") == [(4, 2)]
    assert rows(report.cohort_totals(data, strict=True), "cases", "controls") == [(4, None)]
    assert rows(report.cohort_totals(data, by=())) == [(4, 2)]


def test_many_members_are_made_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(summarise, "MEMBERS_PER_TASK", 10)
    cohorts = spark.createDataFrame([("x", 95)], "c string, n bigint")
    got = summarise.expand_members(cohorts, "c", "n")
    assert got.count() == 95 and got.distinct().count() == 95


def test_collapsed_loci(spark):
    a = spark.createDataFrame([("s1", "O1"), ("s2", "O2"), ("s3", "O3")], "snp string, orig_locus string")
    b = spark.createDataFrame([("s1", "L"), ("s2", "L"), ("s4", "M")], "snp string, locus string")
    assert rows(report.collapsed_loci(a, b), "snp", "orig_locus", "dupe_count") == [("s1", "O1", 2), ("s2", "O2", 2)]


def test_sizes_are_proved_before_a_broadcast(spark):
    df = spark.range(100).withColumn("t", F.lit("x" * 50))
    assert scale.fits(df) and not scale.fits(df, max_rows=99) and not scale.fits(df, max_bytes=1000)
    left = spark.range(10).withColumnRenamed("id", "k")
    right = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(scale.lookup_join(left, right, "k"))
        assert "SortMergeJoin" in plan(scale.lookup_join(left, right, "k", max_rows=5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_interval_plans_have_no_nested_loops(spark, max_rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        points = spark.range(100).select((F.col("id") % 2).alias("chr"), (F.col("id") * 3).alias("bp"))
        genes = spark.range(20).select((F.col("id") % 2).alias("g_chr"), (F.col("id") * 9).alias("s"), (F.col("id") * 9 + 5).alias("e"), F.col("id").alias("gene_ord"), F.lit("g").alias("gene_name"))
        on = ("g_chr", "s", "e")
        for df in (
            intervals.overlap_join(points, genes, right_on=on, max_rows=max_rows),
            nearest(points, genes, interval_on=on, max_rows=max_rows),
            intervals.define_loci(points),
        ):
            text = plan(df)
            assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_picks_limit_each_task_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("m"))
    text = plan(pick.best_per(df, ["k"], "m", ["k"]))
    assert text.count("WindowGroupLimit") == 2 and text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_a_hot_position_does_not_multiply_work(spark):
    hot = spark.range(20_000).select(F.lit(1).alias("chr"), F.lit(777).cast("long").alias("bp"))
    rest = spark.range(2_000).select(F.lit(1).alias("chr"), (F.col("id") * 3_000_000).alias("bp"))
    loci = intervals.define_loci(hot.unionByName(rest)).withColumnsRenamed({"chr": "c", "start": "s", "end": "e"})
    for max_rows in (1_000_000, 0):
        got = intervals.overlap_join(hot.unionByName(rest), loci, right_on=("c", "s", "e"), max_rows=max_rows)
        assert got.count() == 22_000 and got.filter("locus IS NULL").count() == 0


@pytest.mark.parametrize("hot_rows", [5, 1000])
def test_a_hot_key_is_cut_into_shares(spark, hot_rows):
    left = spark.createDataFrame([(k, i) for k in (1, 2, 3) for i in range(4)], "k int, x int")
    right = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 0), (None, 7)], "k int, y int")
    got = scale.split_hot_join(left, right, ["k"], hot_rows)
    assert rows(got, "k", "x", "y") == rows(left.join(right, "k"), "k", "x", "y") and got.count() == 124


def test_checkpoints_go_where_the_session_says(spark):
    assert scale.settle(spark.range(5)).count() == 5

    class Session:
        """A session of a cluster, with or without a named folder."""

        def __init__(self, **conf):
            self.conf = conf
            self.sparkContext = self
            self.master = "yarn"

        def getCheckpointDir(self):
            return None

    assert scale.shared_dir(Session(**{"spark.checkpoint.dir": "hdfs:/shared"})) == "hdfs:/shared"
    with pytest.raises(RuntimeError):
        scale.shared_dir(Session())


def test_queries_read_no_python_rows(spark):
    df = ld.ld_pairs(spark.createDataFrame([(1, 1, 5, "a", 1), (1, 1, 6, "b", 2)], "sample_id bigint, chr int, bp bigint, snp string, dosage int"), 10)
    assert "Python" not in plan(df)
    covers = cells.explode_interval_cells(spark.range(3), F.col("id"), F.col("id") + 9, 3)
    assert "lambda" not in plan(covers)
    assert joins.extract_sites(spark.range(3).toDF("x"), spark.range(2).toDF("x"), ("x",)).count() == 2


@pytest.mark.parametrize("n", [6, 64, 150])
def test_membership_of_many_studies(spark, n):
    """Bitmaps of one, one full and three words."""
    studies = [f"T{i:03d}" for i in range(n)]
    reported = {f"L{k}": sorted({(k * 7 + j * j) % n for j in range(k % 5 + 1)} | ({n - 1} if k % 3 == 0 else set())) for k in range(40)}
    data = [(locus, studies[i]) for locus, at in reported.items() for i in at for _ in range(2)] + [("L_other", "unlisted"), (None, studies[0]), ("L1", "unlisted")]
    seen = membership.study_membership(spark.createDataFrame(data, "locus string, study string"), studies)
    new, old = studies[n // 2 :], studies[: n // 2]
    named = {r["locus"]: r["names"] for r in seen.select("locus", membership.names_of(studies).alias("names")).collect()}
    assert named == {locus: [studies[i] for i in at] for locus, at in reported.items()}
    assert {r["locus"] for r in membership.novel(seen, new, studies).collect()} == {c for c, s in named.items() if not set(s) & set(old)}
    both = [studies[0], studies[n - 1]]
    assert {r["locus"] for r in seen.filter(membership.seen_by_all(both, studies)).collect()} == {c for c, s in named.items() if set(both) <= set(s)}
    counts = Counter("&".join(s) for s in named.values())
    assert {r["region"]: r["n"] for r in membership.regions(seen, studies).collect()} == counts
    assert {(r["locus"], r["study"]) for r in membership.grid(seen, studies).filter("reported").collect()} == {(c, s) for c, ss in named.items() for s in ss}


def test_studies_out_of_the_list_are_left_out_of_the_grid(spark):
    data = [("S1", "chr1:1-9", 1, 5, 0.1, "a", "b"), ("unlisted", "chr2:1-9", 2, 5, 0.1, "a", "b"), ("unlisted", "chr1:1-9", 1, 5, 0.1, "a", "b")]
    frame = spark.createDataFrame(data, "study string, locus string, chr int, bp long, p double, gvc_gene string, gencode_gene string")
    assert rows(report.upset_table(frame, ["S1", "S2"], ["bp"]), "study", "locus", "n_sig") == [("S1", "chr1:1-9", 1)]


def test_annotations_of_the_combined_table_are_not_broadcast(spark, tmp_path):
    """Files small enough for Spark to send whole annotation tables through the driver."""
    def table(name, rows_in, schema):
        spark.createDataFrame(rows_in, schema).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    ids = [f"rs{i}" for i in range(20)]
    assoc_schema = "snp string, chr int, bp bigint, a1 string, a2 string, gene string, frq double, odds_ratio double, p double, study string"
    out = annotate.combine(
        assoc=table("assoc", [(s, 1, 10 * i, "A", "C", "g", 0.1, 2.0, 1e-9, "S") for i, s in enumerate(ids)], assoc_schema),
        extra=table("extra", [("FAM 1", 1, 5, "TT", "CC", "FAM", 0.2, 1.5, 1e-9, "X"), ("rs90", 1, 5, "A", "C", "other", 0.2, 1.5, 1e-9, "X")], assoc_schema),
        tags=table("tags", [(s, 1, 10 * i, i) for i, s in enumerate(ids)], "snp string, chr int, bp bigint, locus_ld bigint"),
        loci=table("loci", [(1, 0, 1000, "chr1:0-1000")], "chr int, start bigint, end bigint, locus string"),
        bands=table("bands", [(1, 0, 1000, "1q0")], "chr int, start bigint, end bigint, cytoband string"),
        frequency=table("frequency", [(s, "C", "A", 0.2, 0.2) for s in ids[1:]], "snp string, major string, minor string, global_maf double, global_af double"),
        population=table("population", [(s, "A", 0.3, 0.3) for s in ids[2:]], "snp string, gnomad_minor string, gnomad_af double, gnomad_maf double"),
        nearest_gene=table("near", [(s, f"G{s}", 7) for s in ids], "snp string, gencode_gene string, gencode_dist bigint"),
        nearest_listed=table("listed", [(s, f"L{s}") for s in ids[3:]], "snp string, gvc_gene string"),
        consequence=table("consequence", [(s, "A", "p.Arg1Ile") for s in ids], "snp string, allele string, hgvs_p string"),
        family="^FAM",
        family_source="rs8",
    )
    assert "SortMergeJoin [snp" in plan(out) and "BroadcastHashJoin [snp" not in plan(out)
    got = {r.snp: r for r in out.collect()}
    assert len(got) == 21 and got["FAM 1"].locus_ld == 8 and got["rs0"].global_maf is None and got["rs5"].gencode_gene == "Grs5" and got["rs2"].gvc_gene is None
