"""Keyed joins: restoring, matching, overriding, flagging, completing grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import isin_
from ..scale import BROADCAST_ROWS, fits, lookup_join, settle


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on equally named keys where missing keys match missing keys."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    out = left.join(r, same, how)
    if how == "full":
        out = out.withColumns({k: F.coalesce(k, f"_r_{k}") for k in keys})
    return out.drop(*[f"_r_{k}" for k in keys])


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on all shared column names, missing keys matching."""
    return null_safe_join(left, right, sorted(set(left.columns) & set(right.columns)))


def restore_dropped(clean: DataFrame, qc: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``qc`` plus the rows of ``clean`` whose key a QC step dropped."""
    missing = null_safe_join(clean, qc.select(*keys).distinct(), keys, "left_anti")
    return qc.unionByName(missing, allowMissingColumns=True)


def match_sites(
    variants: DataFrame,
    sites: DataFrame,
    rescue_ids: list[str],
    take: tuple[str, ...] = ("af",),
    snp: str = "snp",
    keys: dict[str, str] | None = None,
    site_id: str = "id",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Site columns for variants that match on position and both alleles.

    Listed variants are looked up by identifier instead, among the sites at
    positions of the list, and kept even when it is unknown; a listed variant
    that also matches exactly appears twice.  A variant list that passes the
    size check is broadcast, so the site table streams past it unshuffled; it is
    scanned once, and what lies at listed positions is settled for the rescue.
    """
    keys = keys or {"chr": "chr", "bp": "bp", "a1": "ref", "a2": "alt"}
    here = sites.select(*[F.col(s).alias(v) for v, s in keys.items()], F.col(site_id).alias("_id"), *take)
    place = list(keys)[:2]
    listed = F.broadcast(variants) if fits(variants, max_rows) else variants
    if rescue_ids:
        here = settle(here.join(listed.select(*place), place, "left_semi"))
    exact = here.drop("_id").join(listed, list(keys), "inner").select(*variants.columns, *take)
    if not rescue_ids:
        return exact
    by_id = here.filter(isin_("_id", rescue_ids)).select(F.col("_id").alias(snp), *take)
    rescued = variants.filter(isin_(snp, rescue_ids)).join(by_id, snp, "left")
    return exact.unionByName(rescued)


def apply_overrides(df: DataFrame, overrides: list[tuple], key: str) -> DataFrame:
    """Manual corrections given as (key, column, value).

    The hand-typed list becomes one literal map per column: no join.
    """
    # of several corrections of one cell the last holds
    by_column: dict[str, dict] = {}
    for k, column, value in overrides:
        by_column.setdefault(column, {})[k] = value
    new = {}
    for c, values in by_column.items():
        kind = df.schema[c].dataType
        pairs = [x for k, value in values.items() for x in (F.lit(k), F.lit(value).cast(kind))]
        new[c] = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(key)), F.col(c))
    return df.withColumns(new)


def inherit_from(
    df: DataFrame, donors: DataFrame, family: str, source_value: str, columns: list[str], key: str = "snp"
) -> DataFrame:
    """Copy columns of one named donor row to every row whose key matches ``family``."""
    source = (
        donors.filter(F.col(key) == source_value)
        .agg(F.min(F.struct(*columns)).alias("_source"))
        .withColumn("_is", F.lit(True))
    )
    # one row by construction: a global aggregate
    member = F.col(key).rlike(family)
    out = df.withColumn("_is", member).join(F.broadcast(source), "_is", "left")
    return out.withColumns(
        {c: F.when(F.col("_is"), F.col(f"_source.{c}")).otherwise(F.col(c)) for c in columns}
    ).drop("_source", "_is").select(*df.columns)


def flag_in_set(df: DataFrame, members: DataFrame, on: str, flag: str, take: tuple[str, ...] = ()) -> DataFrame:
    """True where the key is in the set, with optional columns of the set."""
    one_each = members.filter(F.col(on).isNotNull()).groupBy(on).agg(
        F.lit(True).alias(flag), *[F.min(c).alias(c) for c in take]
    )
    return lookup_join(df, one_each, on).withColumn(flag, F.coalesce(flag, F.lit(False)))


def extract_sites(sites: DataFrame, variants: DataFrame, keys=("chr", "bp"), max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of a huge site table at the positions of a variant list.

    The size check looks at the list as it is; taking distinct positions first
    would shuffle a long list only to find it long.
    """
    wanted = variants.select(*keys)
    return sites.join(F.broadcast(wanted) if fits(wanted, max_rows) else wanted, list(keys), "left_semi")


# Values of the first column that one share takes.
SHARE_VALUES = 10_000


def expand(df: DataFrame, a: str, b: str, share_values: int = SHARE_VALUES) -> DataFrame:
    """Every combination of the distinct values of two columns.

    The values of ``a`` are dealt into shares, and each value of ``b`` meets
    every share: at least as many shares as shuffle partitions, more when a
    share would hold over ``share_values`` values.
    """
    firsts, seconds = df.select(a).distinct(), df.select(b).distinct()
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-firsts.count() // share_values))
    shares = firsts.withColumn("_share", F.pmod(F.xxhash64(a), F.lit(parts)).cast("int"))
    spread = seconds.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return shares.join(spread, "_share").select(a, b)
