"""Ordered scans along a coordinate that never put a whole group in one task.

A group (a chromosome) is cut into blocks of ``block`` positions.  Each scan
runs inside the blocks, and what crosses a block edge is carried by a table
with one row per block.  Inputs hold at most one row per (group, position), so
a block window sees at most ``block`` rows however the data are skewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scale import settle

BLOCK = 1 << 20


def with_block(df: DataFrame, pos: str, block: int = BLOCK) -> DataFrame:
    return df.withColumn("_block", F.floor(F.col(pos) / F.lit(block)).cast("long"))


def _in_block(group: list[str], pos: str):
    return Window.partitionBy(*group, "_block").orderBy(pos)


def _blocks(group: list[str]):
    return Window.partitionBy(*group).orderBy("_block")


def running_max_before(df: DataFrame, group: list[str], pos: str, value: str, out: str) -> DataFrame:
    """Largest ``value`` among rows of the group at earlier positions.

    Also adds ``<out>_total``, the largest value of the whole group.
    """
    before = _blocks(group).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        df.groupBy(*group, "_block")
        .agg(F.max(value).alias("_top"))
        .withColumns(
            {
                "_carry": F.max("_top").over(before),
                f"{out}_total": F.max("_top").over(Window.partitionBy(*group)),
            }
        )
        .drop("_top")
    )
    inside = F.max(value).over(_in_block(group, pos).rowsBetween(Window.unboundedPreceding, -1))
    return (
        df.join(carried, [*group, "_block"])
        .withColumn(out, F.greatest("_carry", inside))
        .drop("_carry")
    )


def next_row(df: DataFrame, group: list[str], pos: str, value: Column, out: str) -> DataFrame:
    """``value`` of the row at the next position of the group, null for the last."""
    # read backwards: a frame that only grows is updated, never recomputed
    after = Window.partitionBy(*group).orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_here", value)
    carried = (
        df.groupBy(*group, "_block")
        .agg(F.min_by(F.struct(F.col("_here").alias("v")), pos).alias("_first"))
        .withColumn("_carry", F.last("_first", ignorenulls=True).over(after))
        .drop("_first")
    )
    inside = F.lead(F.struct(F.col("_here").alias("v"))).over(_in_block(group, pos))
    return (
        df.join(carried, [*group, "_block"])
        .withColumn(out, F.coalesce(inside, F.col("_carry"))["v"])
        .drop("_carry", "_here")
    )


def fill(
    df: DataFrame,
    column: str,
    group: list[str],
    order: str,
    direction: str = "down",
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Fill missing values from the nearest earlier (down) or later (up) row.

    The rows are range-sorted once; each partition of the sort fills what it
    can, and one row per partition and group carries what crosses its edge.
    Tasks are as large as the sort's partitions, however large a group is.
    """
    # filling up reads backwards, so both directions look at earlier rows only
    way = [F.col(c).desc() if direction == "up" else F.col(c).asc() for c in (order, *ties)]
    at = F.monotonically_increasing_id()
    placed = settle(df.orderBy(*group, *way).withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)))
    seen = Window.unboundedPreceding
    known = F.col(column).isNotNull()
    edges = placed.groupBy(*group, "_part").agg(F.max_by(F.when(known, F.col(column)), F.when(known, F.col("_at"))).alias("_edge"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(seen, -1)
    edges = edges.withColumn("_carry", F.last("_edge", ignorenulls=True).over(before)).drop("_edge")
    inside = Window.partitionBy(*group, "_part").orderBy("_at").rowsBetween(seen, Window.currentRow)
    filled = placed.withColumn(column, F.last(column, ignorenulls=True).over(inside))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*group, "_part")]
    met = filled.alias("l").join(edges.alias("r"), reduce(lambda a, b: a & b, same))
    return met.select(*[F.coalesce(f"l.{c}", "r._carry").alias(c) if c == column else F.col(f"l.{c}") for c in df.columns])


def number_rows(df: DataFrame, order: list, out: str = "row_number") -> DataFrame:
    """Number all rows 1..n in a total order without a one-task window.

    Range-sort, number inside each partition, then add the sizes of the
    partitions before it.  The sorted rows are checkpointed first, so numbers
    and sizes come from the same partitions even after a retry.
    """
    placed = settle(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    part, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumns({"_part": part, "_row": row}).drop("_id")
    # one row per partition of the sort
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_row") + 1)
        .drop("_part", "_row", "_start")
    )


def running_total(df: DataFrame, order: list, amount: Column, out: str) -> DataFrame:
    """Sum of ``amount`` over all earlier rows of a total order, without a one-task window.

    Like `number_rows`: each partition of one range sort sums its own rows, and
    one row a partition carries what stands before it.
    """
    placed = settle(df.withColumn("_amount", amount).orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    sizes = placed.groupBy("_part").agg(F.sum("_amount").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = F.sum("_amount").over(Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1))
    totalled = placed.withColumn("_inside", F.coalesce(inside, F.lit(0)))
    return (
        totalled.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_part", "_id", "_amount", "_inside", "_start")
    )
