"""Size checks, lineage cuts and session settings.

Rules kept by the whole package:

* a side is broadcast only after ``fits`` has proved its size;
* a window never runs over an unbounded group (see ``operators/scans.py``);
* lineage is cut with a reliable checkpoint in the folder the cluster names
  in ``spark.checkpoint.dir``, so a lost executor loses no state.
"""

from __future__ import annotations

import tempfile
import uuid
import warnings
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table with at most this many rows and bytes of text may be broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "*", app: str = "lociflow", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Set on a cluster's session what this package counts on; settings fixed at its start are checked instead."""
    for key, value in SESSION_CONF.items():
        if key.startswith("spark.sql.") and key != "spark.sql.session.timeZone":
            spark.conf.set(key, value)
    if spark.conf.get("spark.cleaner.referenceTracking.cleanCheckpoints", "false") != "true":
        warnings.warn("without spark.cleaner.referenceTracking.cleanCheckpoints checkpoints are never removed", stacklevel=2)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and written tables.

    The cluster's own ``spark.checkpoint.dir`` is used when it is set.  Only a
    local session may fall back to a temporary folder of the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    # one folder a session
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lociflow-"))
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` to the shared folder, in a folder for each value of ``by``, and read it again.

    Like `settle` it cuts the lineage; a filter on ``by`` reads those folders only.
    """
    path = new_folder(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _width(c: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, T.StructType):
        return sum((_width(c[f.name], f.dataType) for f in kind.fields), F.lit(8))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.length(c), F.lit(0)).cast("long")
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.length(c.cast("string")), F.lit(0)).cast("long")
    return F.lit(8).cast("long")


class Size(NamedTuple):
    """Rows of a small table and the mean of the column asked for."""

    rows: int
    mean: float | None


def measure(
    df: DataFrame, average: Column | None = None, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> Size | None:
    """Size of a small table and the mean of ``average``, None when it is not small.

    Small means at most ``max_rows`` rows and ``max_bytes`` of text.  Taking the
    widths of ``max_rows + 1`` rows stops after the first partitions that hold
    that many, while an aggregate over a limit would move as many rows from
    every partition to one task.
    """
    width = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(8))
    value = F.lit(None) if average is None else average
    taken = df.select(width.alias("w"), value.cast("double").alias("x")).limit(max_rows + 1).collect()
    if len(taken) > max_rows or sum(r[0] for r in taken) > max_bytes:
        return None
    known = [r[1] for r in taken if r[1] is not None]
    return Size(len(taken), sum(known) / len(known) if known else None)


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measure(df, None, max_rows, max_bytes) is not None


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join to a side that is usually small.

    Broadcast when the size check passes, so a hot key on the left is never
    shuffled; otherwise a plain join, where AQE splits skewed keys.
    """
    return left.join(F.broadcast(right) if fits(right, max_rows) else right, on, how)


def merge_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join of two sides of which none is proved small, by sorting.

    Spark judges a side by the size of its files, which leaves out what explode
    makes of a row and what compression hides, and would send such a side through the driver.
    """
    return left.join(right.hint("merge"), on, how)


# Rows of one key that may meet the other side in one task.
HOT_ROWS = 8192


def split_hot_join(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner equi-join whose output per key may be far larger than its input.

    AQE splits partitions by their size in bytes, not by what they produce.
    Here a key with more than ``hot_rows`` rows on the right is cut into shares
    by a hash of the whole row, and the left rows of that key go to every
    share.  Without such keys it is a plain `merge_join`.
    """
    hot = (
        right.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_shares"))
    )
    if hot.isEmpty():
        return merge_join(left, right, keys)
    shares = F.coalesce("_shares", F.lit(1))
    cut = right.join(hot, keys, "left").withColumn("_share", F.pmod(F.xxhash64(*right.columns), shares).cast("int"))
    sent = left.join(hot, keys, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1)))
    return merge_join(sent.drop("_shares"), cut.drop("_shares"), [*keys, "_share"]).drop("_share")
