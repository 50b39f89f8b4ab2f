"""Loci per study, novelty, lead variants and the report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import isin_, not_in_, nulls_last, sum_or_null
from ..functions.text import round_even, signif
from ..operators.intervals import FLANK, define_loci, overlap_join
from ..operators.joins import expand, natural_left_join, null_safe_join
from ..operators.pick import best_per, fill_missing_group, get_dupes, span_per
from ..operators.reshape import with_level
from ..operators.scans import number_rows
from ..operators.summarise import count_distinct_per
from ..scale import lookup_join, settle


def with_loci(assoc: DataFrame, w: int = FLANK) -> DataFrame:
    """Associations with the merged locus each lies in.

    The loci are computed once and settled; they are far fewer than the
    variants, and their size is checked before the join uses it.
    """
    loci = settle(define_loci(assoc, w)).withColumnsRenamed({"chr": "l_chr", "start": "l_start", "end": "l_end"})
    return overlap_join(assoc, loci, right_on=("l_chr", "l_start", "l_end"), reach=1).drop("l_start", "l_end")


def loci_per_study(assoc: DataFrame, w: int = FLANK) -> DataFrame:
    """How many loci each study reports."""
    return count_distinct_per(with_loci(assoc, w), "study", "locus", "n_loci")


def novel_loci(df: DataFrame, new: list[str], locus: str = "locus") -> DataFrame:
    """Loci some new study reports and no older one does, with their new studies as a list and as text.

    One grouped pass instead of an anti-join, so a locus with very many rows
    costs no more than its partial counts.
    """
    is_new = isin_("study", new)
    return (
        df.groupBy(locus)
        .agg(
            F.bool_or(~is_new).alias("_known"),
            F.array_sort(F.collect_set(F.when(is_new, F.col("study")))).alias("_by"),
        )
        .filter(~F.col("_known") & (F.size("_by") > 0))
        .select(locus, F.array_join("_by", "&").alias("found_by"), F.col("_by").alias("studies"))
    )


def novel_loci_by_study(df: DataFrame, new: list[str], locus: str = "locus") -> DataFrame:
    """Novel loci counted for each new study."""
    found = novel_loci(df, new, locus)
    return found.select(F.explode("studies").alias("study")).groupBy("study").agg(F.count(F.lit(1)).alias("n"))


def shared_loci(df: DataFrame, studies: list[str], locus: str = "locus") -> DataFrame:
    """Loci that every one of the studies reports."""
    seen = df.filter(F.col("study").isin(studies)).groupBy(locus).agg(F.count_distinct("study").alias("_n"))
    return seen.filter(F.col("_n") == len(set(studies))).select(locus)


def lead_variants(
    df: DataFrame, meta: DataFrame, order: list, exclude: list[str] = (), family: str | None = None, group: str = "locus_ld"
) -> DataFrame:
    """The row with the highest effective sample size of each LD locus.

    Rows without a locus number stand alone; loci in ``exclude`` are left out,
    and the rows whose snp matches ``family`` are put back.
    """
    rows = lookup_join(fill_missing_group(df, group, order), meta.select("study", "neff"), "study")
    scored = rows.withColumn("_score", F.coalesce("neff", F.lit(float("-inf"))))
    leads = best_per(scored, [group], "_score", order, highest=True).drop("_score")
    leads = leads.filter(not_in_("locus", exclude))
    if family:
        members = df.filter(F.col("snp").rlike(family))
        leads = leads.unionByName(members, allowMissingColumns=True)
    return leads


def discovery_year(df: DataFrame, meta: DataFrame, order: list, group: str = "locus_ld", year: str = "study_year") -> DataFrame:
    """The first study, by year, to report each LD locus; a row without one stands alone."""
    rows = lookup_join(fill_missing_group(df, group, order), meta.select("study", year), "study")
    return best_per(rows, [group], year, order)


def table_s1(df: DataFrame, hidden: list[str] = (), digits: int = 3) -> DataFrame:
    """Report rows of the association studies with rounded columns."""
    rows = df.filter(not_in_("study", hidden))
    return rows.withColumns({"frq": signif("frq", digits), "odds_ratio": signif("odds_ratio", digits)})


def upset_table(
    df: DataFrame, levels: list[str], ties: list[str], always: tuple[str, ...] = (), locus: str = "locus"
) -> DataFrame:
    """Study by locus grid: significant rows per cell, gene label and position.

    ``df`` has study, locus (``chr1:5-9``), chr, bp, p, gvc_gene, gencode_gene;
    rows without a locus are left out.  A locus is named and placed by its row
    from the last study in ``levels``, listed gene before nearest gene.  Loci
    of the genes in ``always`` count as significant in every study.
    """
    rows = with_level(df, "study", levels, "_rank").filter(F.col(locus).isNotNull() & F.col("_rank").isNotNull())
    # one pass over the reports; all else comes from the cells
    first = F.min_by(F.struct("chr", "bp", "gvc_gene", "gencode_gene"), F.struct(*ties))
    cells = settle(
        rows.groupBy("study", "_rank", locus).agg(
            F.count(F.lit(1)).alias("_rows"), F.count("p").alias("_hits"), first.alias("_first")
        )
    )
    named = cells.groupBy(locus).agg(F.max_by("_first", "_rank").alias("_f")).select(
        locus, F.coalesce("_f.gvc_gene", "_f.gencode_gene").alias("gene"), F.col("_f.chr").alias("_c"), F.col("_f.bp").alias("_b")
    )
    named = number_rows(named, [*nulls_last("_c", "_b"), F.col(locus)], "position").drop("_c", "_b")

    grid = natural_left_join(expand(cells, "study", locus), cells.select("study", locus, "_rows", "_hits"))
    hits = F.when(isin_("gene", always), F.greatest(F.col("_rows"), F.lit(1))).otherwise(F.coalesce("_hits", F.lit(0)))
    pieces = F.split(locus, "[^0-9A-Za-z]+")
    mb = lambda i: F.regexp_replace(
        round_even(F.get(pieces, F.lit(i)).try_cast("double") / 1_000_000, 2).cast("string"), r"\.0$", ""
    )
    return grid.join(named, locus).select(
        "study",
        locus,
        hits.cast("long").alias("n_sig"),
        (hits > 0).alias("significant"),
        "gene",
        F.concat(F.col(locus), F.lit(" ("), F.coalesce("gene", F.lit("NA")), F.lit(")")).alias("label"),
        F.concat(F.get(pieces, F.lit(0)), F.lit(":"), mb(1), F.lit("-"), mb(2)).alias("short_locus"),
        F.col("position").cast("long").alias("position"),
    )


def upset_segments(grid: DataFrame, levels: list[str], locus: str = "locus") -> DataFrame:
    """First and last study, in the listed order, among the significant cells of each locus.

    ``grid`` is from ``upset_table``, so loci that are always shown span all of its studies.
    """
    cells = with_level(grid.filter("significant"), "study", levels, "_rank").filter("_rank IS NOT NULL")
    return span_per(cells, [locus], "_rank", "study", "start_study", "end_study")


def study_sizes(meta: DataFrame, total: str = "n", effective: str = "neff", stacked: bool = False) -> DataFrame:
    """Total and effective sample size in long form, with a "study, year" label.

    ``stacked`` gives the total less the effective size, for bars on top of
    each other.
    """
    labelled = meta.withColumn("label", F.concat_ws(", ", "study", "study_year"))
    n, ne = F.col(total).cast("double"), F.col(effective).cast("double")
    first = "Remaining n" if stacked else "Total n"
    sized = labelled.select("label", "study", (n - ne if stacked else n).alias(first), ne.alias("Effective n"))
    return sized.unpivot(["label", "study"], [first, "Effective n"], "model", "sample_size")


def collapsed_loci(original: DataFrame, merged: DataFrame) -> DataFrame:
    """Merged loci that hold several rows, with the original locus of each.

    ``original``: snp, orig_locus; ``merged``: snp, locus.
    """
    both = null_safe_join(original, merged, ["snp"], "full")
    return get_dupes(both, ["locus"])


def cohort_totals(df: DataFrame, strict: bool = False, by: tuple[str, ...] = ("data", "stage")) -> DataFrame:
    """Cases and controls summed, over all rows when ``by`` is empty; ``strict`` gives null when any is missing."""
    add = sum_or_null if strict else F.sum
    return df.groupBy(*by).agg(add("cases").alias("cases"), add("controls").alias("controls"))
