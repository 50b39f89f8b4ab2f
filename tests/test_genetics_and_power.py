"""Formulas, classes and power curves."""

import math
from statistics import NormalDist

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lociflow.functions import classify, genetics
from lociflow.operators import harmonise
from lociflow.plans import power, study


def test_effect_columns(spark):
    df = spark.createDataFrame([(1.18, 1.14)], "odds_ratio double, l95 double")
    r = genetics.with_effect_cols(df).first()
    assert r.beta == pytest.approx(0.16551443847757333) and r.se == pytest.approx(0.017594987791412924)
    assert r.z == pytest.approx(9.406908401400038)


def test_beta_from_z_and_effective_sizes(spark):
    df = spark.createDataFrame([(4.189752663097664, 0.0041, 776379, 17008, 37154)], "z double, f double, n bigint, ca bigint, cn bigint")
    r = df.select(genetics.beta_from_z("z", "f", "n"), genetics.neff_4("ca", "cn"), genetics.neff_phi(F.lit(100), F.lit(25))).first()
    assert r[0] == pytest.approx(0.05261769191213753) and r[1] == pytest.approx(46668.53011336361) and r[2] == pytest.approx(18.75)
    assert spark.range(1).select(genetics.neff_4(F.lit(0), F.lit(5))).first()[0] == 0.0


def test_fold_at_the_edges(spark):
    df = spark.createDataFrame([(0.7,), (0.5,), (0.2,), (None,)], "af double").withColumns({"ref": F.lit("R"), "alt": F.lit("A")})
    maf, minor = genetics.fold_maf("af", "ref", "alt")
    major_db, minor_db = genetics.major_minor("af", "ref", "alt")
    got = [tuple(r) for r in df.select(F.round(maf, 6), minor, major_db, minor_db).collect()]
    # at one half the reference base is both, and a missing frequency decides nothing
    assert got == [(0.3, "R", "A", "R"), (0.5, "A", "R", "R"), (0.2, "A", "R", "A"), (None, None, None, None)]


def test_align_to_minor(spark):
    data = [
        ("flip", "A", "G", 0.8, 2.0, "A"), ("same", "A", "G", 0.2, 2.0, "G"), ("near half", "A", "G", 0.5, 2.0, "A"),
        ("indel", "A", "G", 0.8, 2.0, "AT"), ("unknown", "A", "G", 0.8, 2.0, None),
    ]
    df = spark.createDataFrame(data, "k string, a1 string, a2 string, frq double, odds_ratio double, minor string")
    once = genetics.align_to_minor(df)
    got = {r.k: (r.a1, r.a2, r.frq and round(r.frq, 6), r.odds_ratio) for r in once.collect()}
    assert got == {
        "flip": ("G", "A", 0.2, 0.5), "same": ("A", "G", 0.2, 2.0), "near half": ("A", "G", 0.5, 2.0),
        "indel": ("A", "G", 0.8, 2.0), "unknown": (None, None, None, None),
    }
    known = once.filter("minor IS NOT NULL")
    assert rows(genetics.align_to_minor(known)) == rows(known)


def test_classes_at_shared_edges(spark):
    df = spark.createDataFrame(
        [(0.05, 3.0), (0.051, 3.1), (0.01, 1.5), (0.001, 1.1), (0.0009, 1.0), (None, 2.0), (0.1, None)], "maf double, effect double"
    )
    got = [r[0] for r in df.select(classify.architecture_class("maf", "effect")).collect()]
    assert got == ["Low, Intermediate", "Common, High", "Low, Intermediate", "Rare, Moderate", "Very Rare, Low", None, None]
    df = spark.createDataFrame([(1.6, 0.1), (1.6, 0.01), (0.6, 0.0001), (1.0, 0.05), (1.0, 0.2), (1.7, 0.2)], "o double, f double")
    got = [r[0] for r in df.select(classify.architecture_class_v1("o", "f")).collect()]
    assert got == [None, "Low, Moderate", "Rare, Moderate", None, "Common, Low", "Common, High"]


def test_direction_bins_and_consequence(spark):
    df = genetics.with_direction(spark.createDataFrame([(1.0,), (0.5,), (4.0,)], "odds_ratio double"))
    got = [tuple(r) for r in df.select("dir", "effect", "size", classify.effect_bin("effect")).collect()]
    assert got == [("protective", 1.0, 1.0, None), ("protective", 2.0, 2.0, "1.5-2"), ("risk", 4.0, 4.0, ">4")]
    df = spark.createDataFrame([("stop_gained", 2.0, 0.2), ("stop_gained", 1.0, 0.2), ("other", 2.0, 0.2)], "a string, o double, f double")
    got = [r[0] for r in df.select(classify.group_consequence("a", "o", "f")).collect()]
    assert got == ["missense_variant", "Low effect size common variant", "other"]


def test_harmonise_swaps_and_options(spark):
    df = spark.createDataFrame(
        [("a", 1, 5, "G", "A", 0.2, 0.5, 2.0), ("b", 1, 6, "A", "G", 0.2, 0.5, 2.0), ("c", 1, 7, "A", "G", 0.2, 0.5, 2.0), ("a2", 1, 5, "A", "G", 0.9, 0.5, 2.0)],
        "snp string, chr int, bp int, a1 string, a2 string, frq double, beta double, odds_ratio double",
    )
    sites = spark.createDataFrame([(1, 5, "A", "G"), (1, 6, "A", "G"), (1, 6, "A", "T")], "chr int, bp int, ref string, alt string")
    got = harmonise.harmonise(df, sites, ["snp"])
    assert rows(got, "snp", "a1", "a2", "frq", "beta", "odds_ratio", "matched") == [
        ("a", "A", "G", 0.8, -0.5, 0.5, True), ("b", "A", "G", 0.2, 0.5, 2.0, True), ("c", "A", "G", 0.2, 0.5, 2.0, False),
    ]
    assert rows(harmonise.harmonise(df, sites, ["snp"], max_rows=0)) == rows(got)
    assert rows(harmonise.harmonise(df, sites, ["snp"], drop_unmatched=True, biallelic=True), "snp") == [("a",)]
    kept = harmonise.harmonise(df, sites, ["snp"], flip=False)
    assert rows(kept.filter("snp = 'a'"), "a1", "frq", "matched") == [("G", 0.2, True)]


def test_labels(spark):
    df = spark.createDataFrame(
        [("X", "HIGH", 0.01, "X", "R1H", 2.0), ("X", "MODIFIER", 0.01, "X", None, 2.0), ("FAM e4", None, 0.3, None, None, 1.1), ("Q", "HIGH", 0.2, "Q", "R2H", 9.0)],
        "gene string, annotation_impact string, maf double, gene_name string, hgvs_p_new string, effect double",
    )
    out = classify.highlight(classify.label_variants(df, ["X"], "FAM"), "FAM")
    assert [(r.label, r.shp) for r in out.collect()] == [("X R1H", True), ("X", False), ("FAM e4", True), ("", False)]


def chi2_power(ncp, q):
    cdf = NormalDist().cdf
    return cdf(math.sqrt(ncp) - math.sqrt(q)) + cdf(-math.sqrt(ncp) - math.sqrt(q))


def test_a_study_without_cases_has_no_curve(spark):
    got = power.power_curve(spark.createDataFrame([("x", 0.0), ("y", None)], "study string, neff double")).collect()
    assert len(got) == 3000 and all(r.beta is None for r in got)


def test_power_curve_equals_a_grid_search(spark):
    q = NormalDist().inv_cdf(1 - 5e-8 / 2) ** 2
    assert q == pytest.approx(29.71678548976) and power.detectable_ncp() == pytest.approx(39.60098902112)
    studies = spark.createDataFrame([("small", 500.0), ("large", 100000.0)], "study string, neff double")
    got = power.power_curve(studies).collect()
    assert len(got) == 2 * 1500
    step = 4 / 1499
    for r in got[::37] + got[999:1003]:
        neff = 500.0 if r.study == "small" else 100000.0
        at = lambda b: chi2_power(2 * r.maf * (1 - r.maf) * b * b * neff, q)
        want = next((i * step for i in range(1500) if at(i * step) > 0.8), None)
        assert r.beta == (None if want is None else pytest.approx(want))


def test_power_falls_as_samples_rise_and_curves_clean(spark):
    studies = spark.createDataFrame([("small", 2000.0), ("large", 100000.0)], "study string, neff double")
    curve = power.power_curve(studies)
    by = {(r.study, r.place): r.beta for r in curve.collect()}
    assert all(by["large", p] is not None and (by["small", p] is None or by["large", p] <= by["small", p]) for p in range(50, 1500))
    cleaned = power.clean_curve(curve, ["small"])
    got = {(r.maf, r["or"]) for r in cleaned.collect()}
    first = min((r.place, r["or"]) for r in curve.filter("study = 'small' AND beta IS NOT NULL").collect())[1]
    assert (1e-7, first) in got and cleaned.count() == 1499
    assert cleaned.filter("study = 'large'").count() == 0


def test_clean_study_restores_what_the_sites_lack(spark):
    raw = spark.createDataFrame(
        [
            ("rs1", "19", "5", "g", "G/A", "0.2", "1.18", "(1.14–1.22)", "5.7 × 10−24"),
            ("rs1", "19", "5", "g", "G/A", "0.2", "1.10", "(1.05–1.15)", "5.7 × 10−9"),
            ("rs2", "19", "6", "g", "G/A", "x", "1.18", "(1.14–1.22)", "1.0!×!10−9"),
            ("rs3", "19", "7", "g", "G/A", "0.2", "1.18", "(1.14–1.22)", "1.0 × 10−7"),
        ],
        "snp string, chr string, pos string, gene string, alleles string, maf string, `or` string, ci string, p string",
    )
    sites = spark.createDataFrame([(19, 5, "A", "G")], "chr int, bp bigint, ref string, alt string")
    got = study.clean_study(raw, sites, ["snp", "p"])
    assert rows(got, "snp", "a1", "frq", "p") == [("rs1", "G", 0.2, 5.7e-24), ("rs2", "G", None, 1e-9)]
    assert got.filter("snp = 'rs1'").first().z == pytest.approx(9.406908401400038)
