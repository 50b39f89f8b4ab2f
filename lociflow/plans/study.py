"""From a study's printed table to harmonised rows, and from studies to one list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.genetics import GENOME_WIDE, significant, with_direction, with_effect_cols
from ..functions.classify import architecture_class, effect_bin, highlight, label_variants
from ..functions.nulls import ratio
from ..functions.text import parse_sci, to_number
from ..operators.harmonise import harmonise
from ..operators.joins import restore_dropped
from ..operators.pick import best_per
from ..operators.reshape import separate
from ..scale import lookup_join
from .report import lead_variants


def parse_printed(raw: DataFrame) -> DataFrame:
    """Typed columns from printed text.

    ``raw`` holds text: snp, chr, pos, gene, alleles (``A/G``, other before
    effect), maf, or, ci (``(1.1–1.2)``) and p (``5.2 × 10−9``).
    """
    bare = raw.withColumn("ci", F.regexp_replace("ci", r"[()]", ""))
    split = separate(separate(bare, "ci", ["l95", "u95"], "–", regex=False), "alleles", ["a1", "a2"], "/", regex=False)
    return split.select(
        *[c for c in ("study",) if c in raw.columns],
        "snp",
        to_number("chr", "int").alias("chr"),
        to_number("pos", "bigint").alias("bp"),
        "a1",
        "a2",
        "gene",
        to_number("maf").alias("frq"),
        to_number("or").alias("odds_ratio"),
        to_number("l95").alias("l95"),
        to_number("u95").alias("u95"),
        parse_sci("p").alias("p"),
    )


def clean_study(raw: DataFrame, sites: DataFrame, ties: list, alpha: float = GENOME_WIDE) -> DataFrame:
    """Significant variants of each study, the lowest P of each, harmonised.

    ``raw`` may have a ``study`` column; without one it is a single study.
    Variants that the site table lacks were dropped by the harmonising step and
    come back as they were.
    """
    by = [c for c in ("study",) if c in raw.columns]
    clean = best_per(with_effect_cols(significant(parse_printed(raw), alpha=alpha)), [*by, "snp"], "p", ties)
    found = harmonise(clean, sites, ties, flip=False, drop_unmatched=True, by=by).drop("matched")
    return restore_dropped(clean, found, [*by, "chr", "bp"]).withColumn("z", ratio("beta", "se"))


def loci_list(assoc: DataFrame, meta: DataFrame, sites: DataFrame, ties: list) -> DataFrame:
    """One variant per position over all studies: that of the highest effective
    sample size, its effect given for the alternate allele of the site table."""
    scored = lookup_join(assoc, meta.select("study", "neff"), "study")
    best = best_per(scored, ["chr", "bp"], "neff", ties, highest=True).drop("neff")
    found = harmonise(best, sites, ties, drop_unmatched=True).drop("matched")
    return restore_dropped(best, found, ["chr", "bp"])


def architecture_table(
    df: DataFrame,
    meta: DataFrame,
    order: list,
    genes: list[str],
    family: str,
    exclude: list[str] = (),
    never: tuple[str, ...] = (),
    prioritised: str | None = None,
) -> DataFrame:
    """Lead variants with label, direction, effect bin, class and highlight."""
    leads = lead_variants(df, meta, order, exclude, family)
    labelled = with_direction(label_variants(leads, genes, family, maf="gnomad_maf", prioritised=prioritised))
    shown = highlight(labelled, family, never, maf="gnomad_maf")
    return shown.withColumns(
        {"category": effect_bin("effect"), "architecture": architecture_class("gnomad_maf", "effect")}
    )
