"""What the operators of this package share: tables, written intermediates, words, batches.

Words are runs of bytes other than the six ASCII white-space characters, which
is what ``bytes.split()`` gives; a null text counts as empty unless an operator
says otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociflow.scale import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    This cuts the lineage and keeps what was computed when executors are lost.
    The files go when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores put before those that ``df`` has already (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def own(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by name, whatever characters the names have."""
    return [F.col("`{}`".format(c.replace("`", "``"))) for c in df.columns]


def with_fields(df: DataFrame, **kinds: str) -> T.StructType:
    """The schema of ``df`` and more fields."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, T.DataType.fromDDL(k)) for n, k in kinds.items())])


def mapped(df: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    """``df.mapInArrow`` for columns of any name: those with a dot or a backtick travel under plain names."""
    odd = [c for c in df.columns if "." in c or "`" in c]
    plain = dict(zip(odd, fresh(df, *(f"column_{i}" for i in range(len(odd)))), strict=True))
    kinds = T.StructType([T.StructField(plain.get(f.name, f.name), f.dataType) for f in schema.fields])
    return df.toDF(*(plain.get(c, c) for c in df.columns)).mapInArrow(run, kinds).toDF(*schema.names)


def training_row(doc_id: Column) -> Column:
    """Rows that may be learnt from: crc32 of the id as text is no multiple of 5."""
    return F.crc32(doc_id.cast("string")) % 5 != 0


def held_out(doc_id: Column) -> Column:
    """The other rows; a missing id is never learnt from."""
    return F.coalesce(~training_row(doc_id), F.lit(True))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, kept for the words seen; emptied when full, so memory is bounded."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), dtype=np.uint64, count=len(ws))


_HASHES = WordHashes()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return _HASHES.of(ws)


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, modulo 2**64."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= MULTIPLIER
        out += hashes[j : j + n]
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that their order says nothing about the words."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows from an iterator of tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def slices(parts: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds few of them as Python objects."""
    for part in parts:
        for start in range(0, part.num_rows, rows):
            yield part.slice(start, rows)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
