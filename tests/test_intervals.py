"""Interval operators against brute force; many random cases run as chromosomes."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lociflow.operators import cells, intervals, scans
from lociflow.operators.nearest import _first_cover, nearest, nearest_in_sets


def random_spans(seed, n_chr=60, most=12, top=60, long=15):
    rng = random.Random(seed)
    out = []
    for c in range(1, n_chr + 1):
        for _ in range(rng.randint(0, most)):
            s = rng.randint(1, top)
            out.append((c, s, s + rng.randint(0, long)))
    return out


def brute_merge(spans):
    out = []
    for c, s, e in sorted(spans):
        if out and out[-1][0] == c and s <= out[-1][2]:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([c, s, e])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_merge_equals_a_sweep(spark, block):
    spans = random_spans(1)
    df = spark.createDataFrame(spans, "chr int, start bigint, end bigint")
    assert rows(intervals.merge_intervals(df, block=block)) == brute_merge(spans)


def test_touching_regions_merge_and_starts_are_clamped(spark):
    df = spark.createDataFrame([(1, 100), (1, 1_000_100), (1, 2_000_101)], "chr int, bp bigint")
    assert rows(intervals.define_loci(df), "locus") == [("chr1:1-1500100",), ("chr1:1500101-2500101",)]


def test_cells_are_a_partition(spark):
    spans = [(s, s + n) for s in (0, 1, 5, 63, 64, 1000) for n in (0, 1, 3, 17, 64, 300)]
    df = spark.createDataFrame(spans, "s bigint, e bigint")
    got = cells.explode_interval_cells(df, F.col("s"), F.col("e"), cells.levels_for(df, F.col("s"), F.col("e")))
    covered = {}
    for r in got.collect():
        width = 4 ** r._level
        covered.setdefault((r.s, r.e), []).extend(range(r._cell * width, (r._cell + 1) * width))
    assert {k: sorted(v) for k, v in covered.items()} == {(s, e): list(range(s, e + 1)) for s, e in spans}


@pytest.mark.parametrize("max_rows,bin_size", [(10_000, None), (10_000, 1), (10_000, 64), (0, None)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_point_join_equals_brute_force(spark, max_rows, bin_size, how):
    rng = random.Random(2)
    right = random_spans(3, long=9)
    points = [(rng.randint(1, 62), rng.randint(1, 80)) for _ in range(300)]
    points += points[:40] + [(None, 5), (1, None)]
    l = spark.createDataFrame(points, "chr int, bp bigint")
    r = spark.createDataFrame(right, "r_chr int, s bigint, e bigint")
    got = intervals.overlap_join(l, r, right_on=("r_chr", "s", "e"), how=how, max_rows=max_rows, bin_size=bin_size)
    want = []
    for c, p in points:
        hits = [(c, p, s, e) for rc, s, e in right if p is not None and rc == c and p <= e and p + 1 >= s]
        want += hits or ([(c, p, None, None)] if how == "left" else [])
    key = lambda t: tuple((x is not None, x) for x in t)
    assert rows(got, "chr", "bp", "s", "e") == sorted(want, key=key)


def test_crowded_bins_take_the_exact_way(spark, monkeypatch):
    crowd = [(1, 500 + i % 3, 500 + i % 3, i) for i in range(60)] + [(1, 0, 100_000, 99)]
    r = spark.createDataFrame(crowd, "r_chr int, s bigint, e bigint, i int")
    l = spark.createDataFrame([(1, 501), (1, 700), (2, 501)], "chr int, bp bigint")
    want = rows(intervals.overlap_join(l, r, right_on=("r_chr", "s", "e")))
    monkeypatch.setattr(intervals, "BIN_ROWS", 10)
    crowded = intervals.overlap_join(l, r, right_on=("r_chr", "s", "e"))
    assert rows(crowded.select("chr", "bp", "s", "e", "i")) == want and len(want) == 43
    plan = spark._jvm.PythonSQLUtils.explainString(crowded._jdf.queryExecution(), "simple")
    assert "_level" in plan


def test_interval_join_equals_brute_force(spark):
    left, right = random_spans(4), random_spans(5, long=40)
    l = spark.createDataFrame(left, "chr int, ls bigint, le bigint")
    r = spark.createDataFrame(right, "r_chr int, s bigint, e bigint")
    got = intervals.overlap_join(l, r, ("chr", "ls", "le"), ("r_chr", "s", "e"), how="inner")
    want = [(c, a, b, s, e) for c, a, b in left for rc, s, e in right if c == rc and a <= e and b >= s]
    assert rows(got) == sorted(want)


def test_first_match_only(spark):
    l = spark.createDataFrame([(1, 10), (1, 99)], "chr int, bp bigint")
    r = spark.createDataFrame([(1, 0, 10, "b"), (1, 10, 20, "a")], "r_chr int, s bigint, e bigint, band string")
    got = intervals.overlap_join(l, r, right_on=("r_chr", "s", "e"), first_by=["band"])
    assert rows(got, "bp", "band") == [(10, "a"), (99, None)]


def test_both_sides_may_not_share_columns(spark):
    l = spark.createDataFrame([(1, 10, 1)], "chr int, bp bigint, x int")
    r = spark.createDataFrame([(1, 0, 10, 1)], "r_chr int, s bigint, e bigint, x int")
    with pytest.raises(ValueError):
        intervals.overlap_join(l, r, right_on=("r_chr", "s", "e"))


@pytest.mark.parametrize("max_rows", [10_000, 0])
def test_nearest_equals_a_scan(spark, max_rows):
    rng = random.Random(6)
    genes = [(c, s, e, i, f"g{i}") for i, (c, s, e) in enumerate(random_spans(7, most=6, long=12))]
    points = [(rng.randint(1, 62), rng.randint(-3, 90)) for _ in range(400)]
    points += points[:30]
    l = spark.createDataFrame(points, "chr int, bp bigint")
    g = spark.createDataFrame(genes, "g_chr int, s bigint, e bigint, gene_ord int, gene_name string")
    got = nearest(l, g, interval_on=("g_chr", "s", "e"), max_rows=max_rows)
    want = []
    for c, p in points:
        best = min(
            ((0 if s <= p <= e else min(abs(p - s), abs(p - e)), o, n, e) for gc, s, e, o, n in genes if gc == c),
            default=None,
        )
        if best is None:
            want.append((c, p, None, None, None))
            continue
        d, _, name, e = best
        want.append((c, p, name, d, "intragenic" if d == 0 else "downstream" if p > e else "upstream"))
    key = lambda t: tuple((x is not None, x) for x in t)
    assert rows(got, "chr", "bp", "gene_name", "dist", "direction") == sorted(want, key=key)


@pytest.mark.parametrize("max_rows", [10_000, 0])
def test_nearest_in_sets_is_nearest_of_each(spark, max_rows):
    rng = random.Random(8)
    genes = [(c, s, e, i, f"g{i}") for i, (c, s, e) in enumerate(random_spans(9, most=6, long=12))]
    genes.append((None, 5, 9, 10_000, "nowhere"))
    # chromosomes whose names begin alike, and one that is missing
    points = [(rng.choice([1, 2, 11, 12, None]), rng.randint(-3, 90)) for _ in range(200)]
    l = spark.createDataFrame(points, "chr int, bp bigint")
    g = spark.createDataFrame(genes, "g_chr int, s bigint, e bigint, gene_ord int, gene_name string")
    sets = {"third": g.filter("gene_ord % 3 = 0"), "none": g.filter("gene_ord < 0"), "all": g}
    got = nearest_in_sets(l, sets, interval_on=("g_chr", "s", "e"), max_dist={"all": 4}, max_rows=max_rows)
    assert list(got) == list(sets)
    columns = ("chr", "bp", "gene_name", "dist", "direction")
    for name in sets:
        alone = nearest(l, sets[name], interval_on=("g_chr", "s", "e"), max_dist=4 if name == "all" else None, max_rows=max_rows)
        assert got[name].columns == alone.columns
        assert rows(got[name], *columns) == rows(alone, *columns)
    assert nearest_in_sets(l, {}) == {}


def test_nearest_on_another_chromosome_is_ignored(spark):
    l = spark.createDataFrame([(1, 100)], "chr int, bp bigint")
    g = spark.createDataFrame([(2, 100, 100, 0, "wrong"), (1, 900, 950, 1, "right"), (1, 2_000_000, 2_000_001, 2, "far")], "g_chr int, s bigint, e bigint, gene_ord int, gene_name string")
    assert rows(nearest(l, g, interval_on=("g_chr", "s", "e")), "gene_name", "dist") == [("right", 800)]
    capped = nearest(l, g, interval_on=("g_chr", "s", "e"), max_dist=799)
    assert rows(capped, "gene_name", "dist", "direction") == [(None, None, "upstream")]


@pytest.mark.parametrize("direction", ["down", "up"])
@pytest.mark.parametrize("groups", [1, 5])
def test_fill_equals_a_loop(spark, direction, groups):
    rng = random.Random(8)
    data = [(g, o, rng.choice([None, None, rng.randint(0, 9)])) for g in range(groups) for o in range(40)]
    df = spark.createDataFrame(data, "g int, o int, x int").repartition(5)
    want = {}
    for g, o, x in sorted(data, key=lambda t: t[:2], reverse=direction == "up"):
        before = want.get((g, o + (1 if direction == "up" else -1)))
        want[(g, o)] = x if x is not None else before
    got = {(r.g, r.o): r.x for r in scans.fill(df, "x", ["g"], "o", direction).collect()}
    assert got == want


def test_number_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    got = scans.number_rows(df, ["k"], "n")
    assert got.filter(F.col("n") != F.col("k") + 1).count() == 0 and got.count() == 1000


def test_liftover(spark):
    df = spark.createDataFrame([("a", 1, 15), ("b", 1, 35), ("c", 1, 99)], "snp string, chr int, bp bigint")
    seg = spark.createDataFrame([(1, 10, 19, 2, 110, "+"), (1, 30, 39, 1, 230, "-")], "src_chr int, src_start bigint, src_end bigint, dst_chr int, dst_start bigint, strand string")
    assert rows(intervals.liftover(df, seg), "snp", "lifted_chr", "lifted_bp") == [("a", 2, 115), ("b", 1, 234), ("c", None, None)]


def test_small_right_sides_leave_the_left_unshuffled(spark):
    spans = spark.range(50).selectExpr("id % 2 AS chr", "id * 7 AS s", "id * 7 + 20 AS e")
    right = spark.range(30).selectExpr("id % 3 AS r_chr", "id * 11 AS start", "id * 11 + 5 AS end", "id AS ord")
    on = ("r_chr", "start", "end")
    for got in (
        intervals.overlap_join(spans, right, ("chr", "s", "e"), on),
        intervals.overlap_join(spans, right, ("chr", "s", "e"), on, first_by=["ord"]),
        intervals.overlap_join(spans, right, ("chr", "s"), on, first_by=["ord"]),
    ):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    for first_by in (None, ["ord"]):
        want = intervals.overlap_join(spans, right, ("chr", "s", "e"), on, first_by=first_by, max_rows=0)
        got = intervals.overlap_join(spans, right, ("chr", "s", "e"), on, first_by=first_by)
        assert rows(got, "s", "e", "start", "ord") == rows(want, "s", "e", "start", "ord")


def spans_in_files(spark, path):
    """Few enough bytes for Spark to take their exploded cells for small."""
    spark.createDataFrame([(1, s, s + 9_000, s) for s in range(0, 60_000, 100)], "g_chr int, g_start bigint, g_end bigint, gene_ord bigint").write.parquet(f"{path}/genes")
    return spark.read.parquet(f"{path}/genes")


@pytest.mark.parametrize("left_on", [("chr", "bp"), ("chr", "bp", "stop")])
def test_a_side_not_proved_small_is_never_broadcast(spark, tmp_path, left_on):
    genes = spans_in_files(spark, tmp_path)
    points = spark.range(0, 60_000, 500).select(F.lit(1).alias("chr"), F.col("id").alias("bp"), (F.col("id") + 400).alias("stop"))
    on = ("g_chr", "g_start", "g_end")
    hit = intervals.overlap_join(points, genes, left_on, on, how="inner", reach=0, max_rows=10)
    plan = hit._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    reach = 400 if len(left_on) == 3 else 0
    assert hit.count() == sum(s <= p + reach and p <= s + 9_000 for p in range(0, 60_000, 500) for s in range(0, 60_000, 100))


def test_cells_of_the_segment_map_are_never_broadcast(spark, tmp_path):
    genes = spans_in_files(spark, tmp_path)
    spans = genes.select(F.col("g_chr").alias("_chr"), F.struct(F.col("gene_ord").alias("ord"), F.col("g_start").alias("s"), F.col("g_end").alias("e")).alias("g"))
    cuts = spark.range(0, 60_000, 500).select(F.lit(1).alias("_chr"), F.col("id").alias("_at"))
    cover = _first_cover(cuts, spans)
    plan = cover._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert rows(cover.select("_at", "_cover.ord")) == [(p, max(0, -(-(p - 9_000) // 100) * 100)) for p in range(0, 60_000, 500)]


@pytest.mark.parametrize("left_on", [("chr", "s", "e"), ("chr", "s")])
def test_left_rows_that_are_only_spans_get_no_pair_back(spark, left_on):
    """Copies and missing places of such rows give what the join back gives, which another column brings about."""
    spans = [(c, s, e) for c, s, e in random_spans(5, n_chr=12)] * 2 + [(1, 7, 7)] * 3 + [(None, 4, 9), (2, None, 9)]
    left = spark.createDataFrame(spans, "chr int, s bigint, e bigint").select(*left_on[::-1])
    genes = spark.createDataFrame([(c, s, e, f"{i}") for i, (c, s, e) in enumerate(random_spans(6, n_chr=12))], "g_chr int, g_start bigint, g_end bigint, gene string")
    join = lambda d: intervals.overlap_join(d, genes, left_on, ("g_chr", "g_start", "g_end"), how="inner", max_rows=1)
    alone, other = join(left), join(left.withColumn("more", F.lit(1))).drop("more")
    assert alone.dtypes == other.dtypes and rows(alone) == rows(other) and alone.count() > 50
    joins = lambda d: d._jdf.queryExecution().executedPlan().toString().split("== Initial")[0].count("SortMergeJoin [_chr")
    assert joins(alone) == joins(other) - 1
