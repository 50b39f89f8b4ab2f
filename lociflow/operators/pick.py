"""Ordered picks: one row per group, duplicates, group numbers.

``row_number() = 1`` is planned by Spark as a partial limit before the shuffle
and a final one after it, so a hot group sends at most one row per input task.
Every pick needs a total order; callers pass the tie-breaking columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scans import number_rows


def first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row of each group in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def best_per(df: DataFrame, keys: list[str], metric: str, ties: list, highest: bool = False) -> DataFrame:
    """Row with the lowest (or highest) metric per group.

    Rows without a metric never win; a group without any metric gives no row.
    """
    m = F.col(metric)
    return first_per(df.filter(m.isNotNull()), keys, [m.desc() if highest else m.asc(), *ties])


def distinct_on(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in the given order."""
    return first_per(df, keys, order)


def get_dupes(df: DataFrame, keys: list[str], out: str = "dupe_count") -> DataFrame:
    """Rows whose key repeats, with the number of repeats; missing keys match.

    Counts are aggregated before the shuffle and joined back, so a key that
    holds a large share of the rows is split by AQE and never buffered.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)
    counts = counts.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [df[k].eqNullSafe(counts[f"_k_{k}"]) for k in keys]
    return df.join(counts, same).drop(*[f"_k_{k}" for k in keys])


def first_seen_id(df: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """Number groups 1..n by the first place they appear in the order.

    Only one row per group is ordered; the numbers are joined back.
    """
    place = F.min(F.struct(*order)).alias("_place")
    groups = df.groupBy(group).agg(place)
    numbered = number_rows(groups, ["_place", group], out).select(group, out)
    return df.join(numbered, group, "left")


def fill_missing_group(df: DataFrame, group: str, order: list, out: str | None = None) -> DataFrame:
    """Give each row without a group id its own negative id.

    Negative ids cannot meet a real id; they follow the given total order.
    """
    out = out or group
    known = df.filter(F.col(group).isNotNull()).withColumn(out, F.col(group).cast("long"))
    alone = number_rows(df.filter(F.col(group).isNull()), order, "_own").withColumn(out, -F.col("_own"))
    return known.unionByName(alone.drop("_own"))


def span_per(df: DataFrame, group: list[str], rank: str, value: str, start="first", end="last") -> DataFrame:
    """Lowest- and highest-ranked member of each group (equal when it has one)."""
    return df.groupBy(*group).agg(F.min_by(value, rank).alias(start), F.max_by(value, rank).alias(end))
