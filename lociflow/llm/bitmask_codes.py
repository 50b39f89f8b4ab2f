"""Vector code compression: slice-and-intersect bitmasks find the nearest codebook entry.

A vector is cut into `PARTS` equal parts, each replaced by the index of the nearest
of `ENTRIES` entries of that part's codebook.  All numbers are whole: a component
x becomes floor(256 * x), distances are sums of squares, and ties go to the lower
index, so a result doesn't depend on how the rows are dealt out.

Nearest entry (`Slices`): for every dimension of a part the entries' coordinates
are sorted, and the i-th prefix mask is the set of the i first entries as the bits of
a uint64.  The entry next to the part along some dimension gives a first radius.
The entries within it along one dimension are a range of the sorted coordinates, and
the difference of two prefix masks gives them as bits.  The masks of all dimensions
ANDed leave the entries of a cube around the part; these are all that can be as
near as the first entry, and only they are measured, so the result is exact.

Codebooks start as the parts of the rows of least vec_id; each round's sums are
made inside the tasks, so at most PARTS * ENTRIES rows a task are shuffled and the
driver gets as many in all.  The codebooks, whose size doesn't depend on the
table, go to every task.

Vectors that are null or hold a null or non-finite component take no part.  The
longest vector fixes the length, rounded up to a multiple of `PARTS`; shorter ones
are filled up with zeros.  Components beyond 2**26 in size after scaling count as
2**26, and sums beyond a long as the greatest long.  Rows without id, and of equal
ids the greater vector, come last among those that start the codebooks; repeated
rows are repeated vectors.  With fewer kept rows than entries the codebooks are
shorter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import slices, written
from lociflow.scale import fits

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Greatest size of a scaled component.
LARGEST = 1 << 26
_LONG = (1 << 63) - 1


class Slices:
    """The entries of one codebook (entries x width, whole numbers), ready for search."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = np.asarray(entries, np.int64)
        n, width = self.entries.shape
        order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, order, axis=0).T.copy()
        self.order = order.T.copy()
        bits = np.uint64(1) << self.order.astype(np.uint64)
        self.prefix = np.zeros((width, n + 1), np.uint64)
        np.bitwise_or.accumulate(bits, axis=1, out=self.prefix[:, 1:])
        self.all = np.uint64((1 << n) - 1)

    def _distance(self, parts: np.ndarray, which: np.ndarray) -> np.ndarray:
        return ((parts - self.entries[which]) ** 2).sum(axis=1)

    def first_radius(self, parts: np.ndarray) -> np.ndarray:
        """For every part a whole radius within which, along every dimension, its nearest entry lies."""
        least = np.full(len(parts), np.iinfo(np.int64).max)
        for d, (values, order) in enumerate(zip(self.sorted, self.order, strict=True)):
            at = np.searchsorted(values, parts[:, d])
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(values) - 1)):
                np.minimum(least, self._distance(parts, order[near]), out=least)
        if not len(self.sorted):
            return np.zeros(len(parts), np.int64)
        root = np.sqrt(least.astype(np.float64)).astype(np.int64)
        # the root of a large number may be one off
        root += (root + 1) ** 2 <= least
        return root - (root**2 > least)

    def within(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The entries no further than ``radius`` along any dimension, as bits."""
        found = np.full(len(parts), self.all)
        for d, (values, prefix) in enumerate(zip(self.sorted, self.prefix, strict=True)):
            low = np.searchsorted(values, parts[:, d] - radius, side="left")
            high = np.searchsorted(values, parts[:, d] + radius, side="right")
            found &= prefix[high] & ~prefix[low]
        return found

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each part (rows x width)."""
        parts = np.asarray(parts, np.int64)
        if not len(parts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        masks = self.within(parts, self.first_radius(parts))
        bits = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, which = np.nonzero(bits)
        away = self._distance(parts[row], which)
        start = np.searchsorted(row, np.arange(len(parts)))
        least = np.minimum.reduceat(away, start)
        # pairs of a row go up by index: the first that has the least distance
        best = np.flatnonzero(away == least[row])
        _, first = np.unique(row[best], return_index=True)
        return which[best[first]], least


def digest(books: np.ndarray) -> str:
    """Hex digest of all entries (part, entry, position)."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


# --- Spark -------------------------------------------------------------------


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding of doubles) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.filter(F.col("embedding").isNotNull() & ~bad)


def _whole(vectors: pa.Array, length: int) -> np.ndarray:
    """rows x length whole numbers."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * SCALE), -LARGEST, LARGEST).astype(np.int64)
    if (sizes == length).all():
        return flat.reshape(len(sizes), length)
    out = np.zeros((len(sizes), length), np.int64)
    out[np.arange(length) < sizes[:, None]] = flat
    return out


def _parts(vectors: pa.Array, width: int) -> np.ndarray:
    """parts x rows x width."""
    return _whole(vectors, width * PARTS).reshape(len(vectors), PARTS, width).transpose(1, 0, 2)


def first_books(rows: DataFrame) -> np.ndarray | None:
    """Codebooks (parts x entries x width) from the rows of least vec_id; None without rows."""
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // PARTS)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").toArrow()
    return _parts(first.column(0).combine_chunks(), width).copy()


def refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floor of the mean of the parts nearest to it; entries that no part is nearest to stay."""
    sent = rows.sparkSession.sparkContext.broadcast([Slices(b) for b in books])
    entries, width = books.shape[1:]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((PARTS, entries), np.int64)
        sums = np.zeros((PARTS, entries, width), np.int64)
        for batch in slices(parts, 4096):
            for p, held in enumerate(_parts(batch.column(0), width)):
                which, _ = sent.value[p].nearest(held)
                counts[p] += np.bincount(which, minlength=entries)
                for d in range(width):
                    # whole numbers far below 2**53, so the sums of doubles are exact
                    sums[p, :, d] += np.bincount(which, held[:, d], entries).astype(np.int64)
        p, e = np.nonzero(counts)
        columns = [p, e, counts[p, e]]
        arrays = [*(pa.array(c, pa.int64()) for c in columns), pa.array(list(sums[p, e]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "n", "sums"])

    partial = rows.select("embedding").mapInArrow(run, "part long, entry long, n long, sums array<long>")
    whole = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = books.copy()
    for r in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *whole).collect():
        out[r["part"], r["entry"]] = [int(s) // r["n"] for s in r[3:]]
    return out


def codebooks(rows: DataFrame, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks of the rows of `kept` after ``rounds`` rounds."""
    books = first_books(rows)
    for _ in range(rounds if books is not None else 0):
        books = refined(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of the rows of `kept`: a byte a part, and the squared distance of all parts."""
    sent = rows.sparkSession.sparkContext.broadcast([Slices(b) for b in books])
    width = books.shape[2]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts, 4096):
            codes = np.empty((batch.num_rows, PARTS), np.uint8)
            error = np.zeros(batch.num_rows, np.float64)
            total = np.zeros(batch.num_rows, np.int64)
            for p, held in enumerate(_parts(batch.column(2), width)):
                codes[:, p], away = sent.value[p].nearest(held)
                total += away
                error += away
            total[error > _LONG] = _LONG
            arrays = [*batch.columns[:2], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(total)]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error long")


def decode(code: Column, books: np.ndarray) -> Column:
    """The vector that a code stands for, as doubles: the middles of its entries' cells."""
    entries = F.lit(((books + 0.5) / SCALE).tolist())
    at = [F.conv(F.hex(F.substring(code, p + 1, 1)), 16, 10).cast("int") for p in range(len(books))]
    return F.flatten(F.array(*(entries[p][i] for p, i in enumerate(at))))


def compressed(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row of (vec_id, embedding, label) that takes part."""
    rows = kept(vectors)
    books = codebooks(rows)
    if books is None:
        empty = rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return empty.withColumn("codebooks_sha256", F.lit("")).limit(0)
    coded = written(encode(rows, books), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label").agg(F.least(total, F.lit(_LONG)).cast("long").alias("label_error"))
    sums = sums.withColumnRenamed("label", "of")
    whole = coded.join(F.broadcast(sums) if fits(sums) else sums, F.col("label").eqNullSafe(F.col("of")))
    return whole.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
