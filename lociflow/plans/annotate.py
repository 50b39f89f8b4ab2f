"""Annotation of variants and the final combined table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genetics import align_to_minor, fold_maf, major_minor
from ..functions.text import orient_hgvs, short_hgvs
from ..operators.intervals import overlap_join
from ..operators.joins import inherit_from, match_sites
from ..operators.pick import best_per, first_per
from ..operators.reshape import explode_list, separate, stack
from ..scale import merge_join, settle

# Biotypes kept when picking a variant's first transcript.
WANTED_BIOTYPES = ["", "protein_coding"]


def population_frequency(sites: DataFrame) -> DataFrame:
    """Site table with the folded frequency and its minor allele."""
    maf, minor = fold_maf("af", "ref", "alt")
    return sites.withColumns({"gnomad_maf": maf, "gnomad_minor": minor})


def annotate_frequency(variants: DataFrame, sites: DataFrame, rescue_ids: list[str] = ()) -> DataFrame:
    """snp, chr, bp, a1, a2 with the population's minor allele, AF and MAF."""
    hits = match_sites(
        variants.select("snp", "chr", "bp", "a1", "a2"),
        population_frequency(sites),
        list(rescue_ids),
        ("gnomad_minor", "af", "gnomad_maf"),
    )
    return hits.withColumnRenamed("af", "gnomad_af")


def database_frequency(records: DataFrame, study: str) -> DataFrame:
    """Highest frequency a database lists per variant for one source study.

    ``records``: snp, gene, study, ref_seq, minor, maf, with maf an allele
    frequency.  Ties go to the alphabetically first allele.
    """
    best = best_per(records.filter(F.col("study") == study), ["snp"], "maf", ["minor"], highest=True)
    folded, _ = fold_maf("maf", "ref_seq", "minor")
    major, minor = major_minor("maf", "ref_seq", "minor")
    return best.select(
        "snp",
        F.nullif("gene", F.lit("")).alias("dbsnp_gene"),
        "study",
        "ref_seq",
        major.alias("major"),
        minor.alias("minor"),
        folded.alias("maf"),
        F.col("maf").alias("af"),
    )


def annotate_consequence(
    annotated: DataFrame,
    fields: list[str],
    key: str = "snp",
    ann: str = "ann",
    biotype: str = "biotype",
    wanted: list[str] = WANTED_BIOTYPES,
) -> DataFrame:
    """First wanted transcript of each variant's comma list, its pieces named."""
    rows = separate(explode_list(annotated, ann, ",", "_place"), ann, fields, r"\|")
    return first_per(rows.filter(F.col(biotype).isin(wanted)), [key], ["_place"]).drop("_place")


def with_protein_change(df: DataFrame, change: str = "hgvs_p", allele: str = "allele", minor: str = "minor") -> DataFrame:
    """Short protein change, and ``<change>_new`` read towards the minor allele."""
    return df.withColumn(change, short_hgvs(change)).withColumn(f"{change}_new", orient_hgvs(change, allele, minor))


def combine(
    assoc: DataFrame,
    extra: DataFrame,
    tags: DataFrame,
    loci: DataFrame,
    bands: DataFrame,
    frequency: DataFrame,
    population: DataFrame,
    nearest_gene: DataFrame,
    nearest_listed: DataFrame,
    consequence: DataFrame,
    family: str,
    family_source: str,
    repairs: dict[str, Column] | None = None,
) -> DataFrame:
    """The final annotated table, one row per association.

    assoc / extra: snp, chr, bp, a1, a2, gene, frq, odds_ratio, p, study
    tags:          snp, chr, bp, locus_ld           loci: chr, start, end, locus
    bands:         chr, start, end, cytoband
    frequency:     snp, major, minor, global_maf, global_af
    population:    snp, gnomad_minor, gnomad_af, gnomad_maf
    nearest_*:     snp with gene and distance columns
    consequence:   snp, allele, hgvs_p, ...

    Rows of ``extra`` whose gene matches ``family`` are added and take the
    locus of variant ``family_source``.  ``repairs`` are corrections of joined
    columns by hand, made before the alleles are aligned.
    """
    spans = lambda d: d.withColumnsRenamed({"chr": "_r_chr", "start": "_start", "end": "_end"})
    on = ("_r_chr", "_start", "_end")
    # the loci are read by the size check and by the join
    placed = overlap_join(tags.select("snp", "chr", "bp", "locus_ld"), settle(spans(loci)), right_on=on).drop("_start", "_end")
    placed = overlap_join(placed, spans(bands), right_on=on).drop("_start", "_end")
    placed = placed.select("snp", "locus", "cytoband", "locus_ld")

    members = extra.filter(F.col("gene").rlike(family))
    rows = stack([assoc, members])
    # one row per variant carries all annotations, so the associations are
    # shuffled once, however many annotations there are
    known = rows.select("snp").distinct()
    for side in (frequency, population, placed, nearest_gene, nearest_listed, consequence):
        known = merge_join(known, side, "snp", "left")
    out = merge_join(rows, known, "snp", "left")
    out = inherit_from(out, placed, family, family_source, ["locus", "cytoband", "locus_ld"])
    is_member = F.coalesce(F.col("snp").rlike(family), F.lit(False))
    out = out.withColumns(
        {
            "gnomad_maf": F.when(is_member, F.col("frq")).otherwise(F.col("gnomad_maf")),
            "major": F.when(is_member, F.col("a1")).otherwise(F.col("major")),
            "minor": F.when(is_member, F.col("a2")).otherwise(F.col("minor")),
        }
    )
    return with_protein_change(align_to_minor(out.withColumns(repairs or {})))

