"""Interval construction, merging and joining on one coordinate per chromosome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import if_else
from ..scale import BROADCAST_ROWS, Size, measure, merge_join, settle, split_hot_join
from . import scans
from .cells import explode_interval_cells, explode_point_cells, levels_for

# Fixed value: half width of the region around a variant.
FLANK = 500_000
# Most intervals of one bin that a point may have to look at.
BIN_ROWS = 2_048


def flank(df: DataFrame, pos: str = "bp", w: int = FLANK, start: str = "start", end: str = "end") -> DataFrame:
    """Region of ``w`` positions on both sides; a start below 0 becomes 1."""
    low = F.col(pos) - w
    return df.withColumns({start: if_else(low < 0, F.lit(1).cast("long"), low), end: F.col(pos) + w})


def merge_intervals(
    df: DataFrame, chrom: str = "chr", start: str = "start", end: str = "end", block: int = scans.BLOCK
) -> DataFrame:
    """Union of overlapping or touching intervals per chromosome.

    Copies and intervals with the same start collapse before any ordering, so
    a block holds at most ``block`` rows.  A row opens a new island when it
    starts after every earlier end; an island ends where the rows before the
    next island end.
    """
    known = F.col(chrom).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull()
    spans = df.filter(known).groupBy(chrom, start).agg(F.max(end).alias("_end"))
    # the scans read the distinct starts several times and the input only once
    spans = settle(scans.with_block(spans, start, block))
    spans = scans.running_max_before(spans, [chrom], start, "_end", "_seen")
    heads = spans.filter(F.col("_seen").isNull() | (F.col(start) > F.col("_seen")))
    heads = scans.next_row(heads, [chrom], start, F.col("_seen"), "_island_end")
    return heads.select(chrom, start, F.coalesce("_island_end", "_seen_total").alias(end))


def with_locus_label(df: DataFrame, chrom="chr", start="start", end="end", out="locus") -> DataFrame:
    """Label ``chr7:100-200``."""
    return df.withColumn(
        out,
        F.concat(F.lit("chr"), F.col(chrom), F.lit(":"), F.col(start), F.lit("-"), F.col(end)),
    )


def define_loci(df: DataFrame, w: int = FLANK, chrom: str = "chr", pos: str = "bp") -> DataFrame:
    """Merged regions around variants: chr, start, end, locus."""
    return with_locus_label(merge_intervals(flank(df.select(chrom, pos), pos, w), chrom), chrom)


def _overlap_pairs(keys: DataFrame, right: DataFrame, r, reach: int | None) -> DataFrame:
    """Distinct left spans (_chr, _s, _e) with every right row that overlaps.

    ``reach`` is the common left length, or None when it varies; then a pair is
    found either by the left start inside the right span or by the right start
    inside the left span after its first position, never by both.
    """
    r_chr, r_start, r_end = r
    tagged = right.withColumnsRenamed({r_chr: "_chr"}).filter(F.col(r_end) >= F.col(r_start) - (reach or 0))

    first, last = F.col(r_start) - (reach or 0), F.col(r_end)
    levels = levels_for(tagged, first, last)
    covers = explode_interval_cells(tagged, first, last, levels)
    points = explode_point_cells(keys, F.col("_s"), levels)
    cell = ["_chr", "_level", "_cell"]
    pairs = split_hot_join(points, covers, cell).drop("_level", "_cell")
    if reach is not None:
        return pairs

    long = keys.filter("_e > _s")
    first, last = F.col("_s") + 1, F.col("_e")
    levels = levels_for(long, first, last)
    longer = explode_interval_cells(long, first, last, levels)
    starts = explode_point_cells(tagged, F.col(r_start), levels)
    return pairs.unionByName(split_hot_join(longer, starts, cell).drop("_level", "_cell"))


def measure_spans(df: DataFrame, on: tuple[str, str, str], max_rows: int = BROADCAST_ROWS) -> Size | None:
    """Size and mean length of a small interval table, None when it is not small."""
    return measure(df, F.col(on[2]) - F.col(on[1]), max_rows)


def _fullest(binned: DataFrame) -> int:
    """Rows in the fullest bin."""
    return binned.groupBy("_chr", "_bin").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_on: tuple[str, ...] = ("chr", "bp"),
    right_on: tuple[str, str, str] = ("chr", "start", "end"),
    how: str = "left",
    reach: int = 1,
    bin_size: int | None = None,
    first_by: list[str] | None = None,
    max_rows: int = BROADCAST_ROWS,
    size: Size | None = None,
) -> DataFrame:
    """Join rows whose closed intervals overlap on the same chromosome.

    ``left_on`` is (chr, start, end), or (chr, pos) for the point span
    [pos, pos + reach].  The right chromosome column is dropped.  ``first_by``
    keeps one right row per left row, the least in those columns.  ``size`` is
    the result of ``measure_spans`` for the right side when the caller has it.

    A right side that passes the size check is broadcast, and the left side is
    neither shuffled nor, with ``first_by``, multiplied: points look up their bin,
    spans their chromosome.  When it does not fit, or when so many of its
    intervals crowd one bin or chromosome that a row would look at them all, the
    distinct left spans are matched through exact cells and joined back on
    their full key, unless left rows have no other columns and only matches are asked for.
    """
    r_chr, r_start, r_end = right_on
    point = len(left_on) == 2
    clash = (set(left.columns) & set(right.columns)) - {r_chr}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    if size is None:
        size = measure_spans(right, right_on, max_rows)
    if size is not None:
        l_chr, at = left_on[0], F.col(left_on[1])
        if point:
            if bin_size is None:
                # a power of two above the mean length: at most about three bins a row
                bin_size = 1 << max(int(size.mean or 1), 1).bit_length()
            low = lambda start: start - reach
            to_bin = lambda c: F.floor(c / F.lit(bin_size)).cast("long")
            binned = right.filter(F.col(r_end) >= low(F.col(r_start))).withColumn(
                "_bin", F.explode(F.sequence(to_bin(low(F.col(r_start))), to_bin(F.col(r_end))))
            )
            here, meets = to_bin(at), lambda start, end: (at >= low(start)) & (at <= end)
        else:
            stop = F.col(left_on[2])
            binned = right.filter(F.col(r_end) >= F.col(r_start)).withColumn("_bin", F.lit(0).cast("long"))
            here = F.lit(0).cast("long")
            meets = lambda start, end: ((at >= start) & (at <= end)) | ((start > at) & (start <= stop))
        binned = binned.withColumnRenamed(r_chr, "_chr")
        if size.rows <= BIN_ROWS or _fullest(binned) <= BIN_ROWS:
            same = (F.col(l_chr) == F.col("_chr")) & (here == F.col("_bin"))
            if not first_by:
                met = meets(F.col(r_start), F.col(r_end))
                return left.join(F.broadcast(binned), same & met, how).drop("_chr", "_bin")
            rest = [c for c in right.columns if c != r_chr]
            row = F.struct(*first_by, *[F.col(c).alias(f"_v_{c}") for c in rest])
            table = binned.groupBy("_chr", "_bin").agg(F.collect_list(row).alias("_all"))
            found = left.join(F.broadcast(table), same, "left")
            least = F.array_min(F.filter("_all", lambda x: meets(x[f"_v_{r_start}"], x[f"_v_{r_end}"])))
            found = found.withColumn("_least", least)
            if how == "inner":
                found = found.filter(F.col("_least").isNotNull())
            return found.select(*left.columns, *[F.col(f"_least._v_{c}").alias(c) for c in rest])

    l_chr, l_start = left_on[0], left_on[1]
    l_end = F.col(l_start) + reach if point else F.col(left_on[2])
    spans = left.withColumns({"_chr": F.col(l_chr), "_s": F.col(l_start), "_e": l_end})
    keys = spans.select("_chr", "_s", "_e").dropna().distinct()
    if how == "inner" and not first_by and set(left.columns) == set(left_on):
        # a left row is nothing but its span: its copies are counted, and no pair is sent back to it
        keys = spans.dropna().groupBy("_chr", "_s", "_e").agg(F.count(F.lit(1)).alias("_copies"))
        pairs = _overlap_pairs(keys, right, right_on, reach if point else None)
        pairs = pairs.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
        own = [F.col(c).alias(name) for c, name in zip(("_chr", "_s", "_e"), left_on)]
        rest = [c for c in right.columns if c != r_chr]
        return pairs.select(*own, *rest).select(*left.columns, *rest)
    pairs = _overlap_pairs(keys, right, right_on, reach if point else None)
    if first_by:
        rest = [c for c in right.columns if c != r_chr]
        least = F.min(F.struct(*first_by, *[F.col(c).alias(f"_v_{c}") for c in rest])).alias("_least")
        pairs = pairs.groupBy("_chr", "_s", "_e").agg(least).select(
            "_chr", "_s", "_e", *[F.col(f"_least._v_{c}").alias(c) for c in rest]
        )
    return merge_join(spans, pairs, ["_chr", "_s", "_e"], how).drop("_chr", "_s", "_e")


def liftover(
    df: DataFrame,
    segments: DataFrame,
    chrom: str = "chr",
    pos: str = "bp",
    alleles: tuple[str, ...] = (),
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Positions in another build, from aligned segments.

    ``segments`` has src_chr, src_start, src_end, dst_chr, dst_start, strand.
    Adds lifted_chr and lifted_bp, null where no segment covers the position.
    With a ``score`` among their columns (and ``chain`` for ties) the best-scored
    segment decides where several cover a position.  ``alleles`` names columns
    that are put on the other strand where the segment is reversed.
    """
    columns = ["src_chr", "src_start", "src_end", "dst_chr", "dst_start", "strand"]
    first_by = None
    if "score" in segments.columns:
        ties = ["chain"] if "chain" in segments.columns else []
        segments = segments.withColumn("_worse", -F.col("score"))
        columns, first_by = [*columns, "_worse", *ties], ["_worse", *ties, "src_start", "dst_start"]
    hit = overlap_join(
        df, segments.select(*columns), (chrom, pos), ("src_chr", "src_start", "src_end"), reach=0, first_by=first_by, max_rows=max_rows
    )
    forward = F.col("dst_start") + (F.col(pos) - F.col("src_start"))
    reverse = F.col("dst_start") + (F.col("src_end") - F.col(pos))
    back = F.col("strand") == "-"
    other = {a: F.when(back, F.reverse(F.translate(a, "ACGTacgt", "TGCAtgca"))).otherwise(F.col(a)) for a in alleles}
    lifted = {"lifted_chr": F.col("dst_chr"), "lifted_bp": F.when(back, reverse).otherwise(forward)}
    return hit.withColumns(lifted | other).drop(*[c for c in columns if c != "src_chr"])
