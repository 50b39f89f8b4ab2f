"""Null rules and text clean-up, one hand-typed table each."""

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lociflow.functions import nulls, text
from lociflow.operators import joins, pick, reshape


def one(spark, expr, schema, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(expr).collect()]


def test_if_else_keeps_missing_conditions(spark):
    assert one(spark, nulls.if_else(F.col("x") > 1, "a", "b"), "x int", 0, 2, None) == ["b", "a", None]


def test_membership_is_never_missing(spark):
    assert one(spark, nulls.isin_("x", ["a"]), "x string", "a", "b", None) == [True, False, False]
    assert one(spark, nulls.not_in_("x", ["a"]), "x string", "a", "b", None) == [False, True, True]


def test_n_distinct_and_sums(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "k string, x int")
    got = df.agg(nulls.n_distinct("k"), nulls.n_distinct("k", False), nulls.sum_or_null("x"), F.sum(nulls.row_sum("x"))).first()
    assert tuple(got) == (2, 1, None, 3)


def test_ratio_by_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, 4.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(nulls.ratio("a", "b")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and got[3] == 0.25 and got[4] is None


def test_nulls_sort_last_both_ways(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert [r.x for r in df.orderBy(*nulls.nulls_last("x")).collect()] == [1, 2, None]
    assert [r.x for r in df.orderBy(*nulls.nulls_last("x", descending=True)).collect()] == [2, 1, None]


def test_parse_sci(spark):
    shown = ["5.2 × 10−9", "5.7!×!10−24", "1.3x 10-10", "1,126,563", "−0.5", "1.2e-881", "NA", None]
    got = one(spark, text.parse_sci("x"), "x string", *shown)
    assert got[:6] == [5.2e-9, 5.7e-24, 1.3e-10, 1126563.0, -0.5, 0.0] and got[6:] == [None, None]


def test_bad_numbers_and_p_floor(spark):
    assert one(spark, text.to_number("x"), "x string", "1.5", "x", None) == [1.5, None, None]
    assert one(spark, text.floor_p("x"), "x string", "0", "<1e-300", None) == [0.0, 1e-300, 1e-300]
    assert one(spark, text.cap_infinite("x", 500), "x double", math.inf, -math.inf, 3.0, None) == [500.0, 500.0, 3.0, None]


def test_rounding(spark):
    assert one(spark, text.signif("x", 3), "x double", 0.00012345, 123456.0, 0.0, -1.0049) == [0.000123, 123000.0, 0.0, -1.0]
    assert one(spark, text.round_even("x"), "x double", 0.5, 1.5, 2.5) == [0.0, 2.0, 2.0]


def test_cut_is_right_closed(spark):
    got = one(spark, text.cut("x", [1, 2, math.inf], ["low", "high"]), "x double", 1.0, 2.0, 2.1, None)
    assert got == [None, "low", "high", None]


def test_chromosomes(spark):
    got = one(spark, text.chrom_to_int("x"), "x string", "chr7", "12", "chrX", "Y", "chrM", "MT", "chr6_apd", None)
    assert got == [7, 12, 23, 24, 25, 25, None, None]


def test_replace_first_and_match(spark):
    assert one(spark, text.replace_first("x", "[0-9]", "_"), "x string", "a1b2", "none") == ["a_b2", "none"]
    assert one(spark, text.first_match("x", "[0-9]+"), "x string", "a12b3", "none", None) == ["12", None, None]


def test_short_hgvs_knows_isoleucine(spark):
    got = one(spark, text.short_hgvs("x"), "x string", "p.Arg47His", "p.Ile360Val", "p.Cys1613Cys", None)
    assert got == ["R47H", "I360V", "C1613C", None]


def test_orient_hgvs(spark):
    df = spark.createDataFrame(
        [("R47H", "T", "T"), ("R47H", "T", "C"), ("R47H", "T", None), (None, "T", "T"), ("R12345H", "T", "T")],
        "h string, allele string, minor string",
    )
    got = [r[0] for r in df.select(text.orient_hgvs("h", "allele", "minor")).collect()]
    # residue numbers are read four digits at a time
    assert got == ["R47H", "H47R", None, None, "R1234"]


def test_headers_and_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "rsid int, `cDNA.pos / cDNA.length` int, EAF int")
    assert reshape.standardise_headers(df).columns == ["SNP", "CDNA.POS / CDNA.LENGTH", "FRQ"]
    assert reshape.clean_names(df).columns == ["rsid", "c_dna_pos_c_dna_length", "eaf"]
    assert [reshape.clean_name(n) for n in ["Transcript_BioType", "HGVS.p", "ERRORS / WARNINGS / INFO"]] == [
        "transcript_bio_type", "hgvs_p", "errors_warnings_info",
    ]
    twice = spark.createDataFrame([(1, 2)], "`a b` int, `a.b` int")
    assert reshape.clean_names(twice).columns == ["a_b", "a_b_2"]


def test_unite_separate_explode(spark):
    df = spark.createDataFrame([("a", None, "x|y|z"), ("b", "c", "x")], "p string, q string, r string")
    assert rows(reshape.unite(df, "u", ["p", "q"]), "u") == [("a_NA",), ("b_c",)]
    assert rows(reshape.separate(df, "r", ["one", "two"], "|", regex=False), "one", "two") == [("x", None), ("x", "y")]
    assert rows(reshape.explode_list(df, "r", "|", "i"), "p", "i", "r") == [("a", 0, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 0, "x")]


def test_nest_pivot_levels(spark):
    df = spark.createDataFrame([("k", "a", 1), ("k", "b", 2), ("m", "a", 3)], "g string, n string, x int")
    assert rows(reshape.unnest(reshape.nest(df, ["g"]).drop("part"), "data")) == rows(df)
    many = spark.createDataFrame([("k", i % 7) for i in range(25)] + [(None, 1)] * 12 + [("m", 3)], "g string, x int")
    for most in (5, 100):
        nested = reshape.nest(many, ["g"], max_rows=most)
        assert nested.columns == ["g", "part", "data"]
        sizes = {(r.g, r.part): len(r.data) for r in nested.collect()}
        whole = {"k": 25, None: 12, "m": 1}
        assert sizes == {(g, i): min(most, n - i * most) for g, n in whole.items() for i in range(-(-n // most))}
        assert rows(reshape.unnest(nested.drop("part"), "data")) == rows(many)
    wide = reshape.pivot_wider(df, ["g"], "n", "x", ["a", "b"])
    assert rows(wide) == [("k", 1, 2), ("m", 3, None)]
    twice = spark.createDataFrame([("k", "a", 5, 1), ("k", "a", 4, 2), ("k", "a", None, 0)], "g string, n string, x int, o int")
    assert rows(reshape.pivot_wider(twice, ["g"], "n", "x", ["a"])) == [("k", 4)]
    assert rows(reshape.pivot_wider(twice, ["g"], "n", "x", ["a"], ("o",))) == [("k", 5)]
    long = reshape.pivot_longer(wide, ["g"], ["a", "b"], "n", "x")
    assert rows(long) == [("k", "a", 1), ("k", "b", 2), ("m", "a", 3), ("m", "b", None)]
    assert rows(reshape.with_level(df, "n", ["b"], "lv"), "n", "lv") == [("a", None), ("a", None), ("b", 1)]


def test_select_any_append_cast(spark):
    df = spark.createDataFrame([("1", "x")], "a_pct string, b string")
    assert reshape.select_any(df, ["b"], {"c": "int"}).first().asDict() == {"b": "x", "c": None}
    assert reshape.cast_matching(df, "pct$", "double").first().a_pct == 1.0
    grown = reshape.append_rows(df, [{"b": "y"}], "b string")
    assert rows(grown, "a_pct", "b") == [(None, "y"), ("1", "x")]


def test_picks_and_dupes(spark):
    df = spark.createDataFrame([("a", 2.0, 1), ("a", 1.0, 2), ("a", 1.0, 1), ("b", None, 1), (None, 5.0, 1)], "k string, m double, t int")
    assert rows(pick.best_per(df, ["k"], "m", ["t"])) == [(None, 5.0, 1), ("a", 1.0, 1)]
    assert rows(pick.best_per(df, ["k"], "m", ["t"], highest=True), "k", "m") == [(None, 5.0), ("a", 2.0)]
    both = df.unionByName(spark.createDataFrame([(None, 6.0, 1)], df.schema))
    assert rows(pick.get_dupes(both, ["k"]), "k", "dupe_count") == [(None, 2), (None, 2), ("a", 3), ("a", 3), ("a", 3)]


def test_group_numbers(spark):
    df = spark.createDataFrame([("x", 3), ("y", 1), ("x", 0), ("z", 9)], "g string, o int")
    got = pick.first_seen_id(df, "g", ["o"], "n")
    assert rows(got, "g", "n") == [("x", 1), ("x", 1), ("y", 2), ("z", 3)]
    gaps = spark.createDataFrame([(2, 1), (None, 2), (None, 3)], "g int, o int")
    assert rows(pick.fill_missing_group(gaps, "g", ["o"]), "o", "g") == [(1, 2), (2, -1), (3, -2)]


def test_joins_match_missing_keys(spark):
    a = spark.createDataFrame([(None, 1), ("k", 2)], "k string, x int")
    b = spark.createDataFrame([(None, 10), ("m", 20)], "k string, y int")
    assert rows(joins.natural_left_join(a, b), "k", "x", "y") == [(None, 1, 10), ("k", 2, None)]
    assert rows(joins.null_safe_join(a, b, ["k"], "full"), "k", "x", "y") == [(None, 1, 10), ("k", 2, None), ("m", None, 20)]


def test_restore_override_inherit_flag(spark):
    clean = spark.createDataFrame([("a", 1), ("b", 2)], "snp string, bp int")
    qc = spark.createDataFrame([("a", 1, 0.5)], "snp string, bp int, af double")
    assert rows(joins.restore_dropped(clean, qc, ["snp"])) == [("a", 1, 0.5), ("b", 2, None)]
    blank = spark.createDataFrame([(None, 3), ("a", 1)], "snp string, bp int")
    assert rows(joins.restore_dropped(blank, blank, ["snp"])) == [(None, 3), ("a", 1)]
    assert rows(joins.apply_overrides(clean, [("b", "bp", 7), ("zz", "bp", 8)], "snp")) == [("a", 1), ("b", 7)]
    got = joins.inherit_from(clean, clean, "^b", "a", ["bp"])
    assert rows(got) == [("a", 1), ("b", 1)]
    members = spark.createDataFrame([("a", "t")], "snp string, tier string")
    assert rows(joins.flag_in_set(clean, members, "snp", "listed", ("tier",)), "snp", "listed", "tier") == [("a", True, "t"), ("b", False, None)]


@pytest.mark.parametrize("max_rows", [0, 100])
def test_match_sites_rescues_listed_ids(spark, max_rows):
    v = spark.createDataFrame([("a", 1, 5, "A", "G"), ("b", 1, 6, "A", "G"), ("c", 1, 7, "A", "G")], "snp string, chr int, bp int, a1 string, a2 string")
    s = spark.createDataFrame([("a", 1, 5, "A", "G", 0.1), ("b", 1, 6, "G", "A", 0.2), ("c", 1, 8, "A", "G", 0.3)], "id string, chr int, bp int, ref string, alt string, af double")
    assert rows(joins.match_sites(v, s, ["b", "c"], max_rows=max_rows), "snp", "af") == [("a", 0.1), ("b", 0.2), ("c", None)]


@pytest.mark.parametrize("share_values", [1, 10])
def test_expand(spark, share_values):
    df = spark.createDataFrame([("s", "x"), ("t", "y"), (None, "x")], "a string, b string")
    got = rows(joins.expand(df, "a", "b", share_values=share_values), "a", "b")
    assert got == [(None, "x"), (None, "y"), ("s", "x"), ("s", "y"), ("t", "x"), ("t", "y")]


@pytest.mark.parametrize("max_rows", [0, 100])
def test_extract_sites(spark, max_rows):
    s = spark.createDataFrame([(1, 5, 0.1), (1, 6, 0.2)], "chr int, bp int, af double")
    v = spark.createDataFrame([(1, 5), (1, 5), (2, 6)], "chr int, bp int")
    assert rows(joins.extract_sites(s, v, max_rows=max_rows), "bp") == [(5,)]
