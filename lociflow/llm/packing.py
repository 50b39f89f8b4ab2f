"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

A document is measured in words.  One that is longer than a bin is cut into
pieces of the capacity and a rest.  Within a shard the pieces are placed longest
first; the open bins are ordered by residual and carry a bitmap of the sources
and one of the duplicate clusters they hold.  The search begins at the smallest
residual that takes the piece and goes on to the next larger one until a bin is
found that has neither the piece's source nor its cluster: the tightest
compatible bin.  Only when there is none is a new bin opened.  Bins that share
residual and sources are kept together, so sources are compared once for all of
them.

Documents are dealt to shards by a hash of the key, about `SHARD_DOCS` to a
shard, whatever their source or cluster, so a hot source is spread evenly.  Only
lengths and ids are shuffled, never texts.

Nulls: a null text is an empty one (length 0); a null source or cluster
conflicts with nothing.  Every row, repeated ones too, is placed; an empty table
gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import column, slices, words

CAPACITY = 2048
SHARD_DOCS = 20_000


class Piece(NamedTuple):
    length: int
    source: int | None
    cluster: int | None


class _Bin(NamedTuple):
    number: int
    clusters: int


def best_fit(pieces: list[Piece], capacity: int) -> list[int]:
    """The bin of each piece, given in the order of placing; sources and clusters are bit numbers."""
    # residual -> bitmap of sources -> bins with both
    at: dict[int, dict[int, list[_Bin]]] = {}
    residuals: list[int] = []
    opened = 0
    placed = []
    for length, source, cluster in pieces:
        source_bit = 0 if source is None else 1 << source
        cluster_bit = 0 if cluster is None else 1 << cluster
        found = None
        i = bisect_left(residuals, length)
        while found is None and i < len(residuals):
            for sources, bins in at[residuals[i]].items():
                if sources & source_bit:
                    continue
                j = next((j for j in range(len(bins) - 1, -1, -1) if not bins[j].clusters & cluster_bit), None)
                if j is not None:
                    found = residuals[i], sources, bins.pop(j)
                    break
            i += 1
        if found is None:
            residual, sources, bin_ = capacity, 0, _Bin(opened, 0)
            opened += 1
        else:
            residual, sources, bin_ = found
            if not at[residual][sources]:
                del at[residual][sources]
            if not at[residual]:
                del at[residual]
                residuals.pop(bisect_left(residuals, residual))
        rest = residual - length
        if rest not in at:
            at[rest] = {}
            insort(residuals, rest)
        at[rest].setdefault(sources | source_bit, []).append(_Bin(bin_.number, bin_.clusters | cluster_bit))
        placed.append(bin_.number)
    return placed


_PLACED = pa.schema([("piece", pa.int32()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("shard", pa.int32()), ("bin", pa.int32())])


def _pack(group: pa.Table, capacity: int) -> pa.Table:
    """Pack one shard: cut long documents, give bits to sources and repeated clusters, place the pieces."""
    rows = list(zip(*(group.column(c).to_pylist() for c in ("length", "tie", "source", "cluster")), strict=True))
    repeated = [c for c, n in Counter(r[3] for r in rows).items() if n > 1 and c is not None]
    cluster_bits = {c: i for i, c in enumerate(repeated)}
    source_bits: dict[str, int] = {}
    cut = []
    for n, (length, tie, source, cluster) in enumerate(rows):
        bit = None if source is None else source_bits.setdefault(source, len(source_bits))
        for piece, start in enumerate(range(0, max(length, 1), capacity)):
            cut.append((min(capacity, length - start), tie, piece, start, n, bit, cluster_bits.get(cluster)))
    # longest first; the tie is a hash, so copies of one source don't follow one another
    cut.sort(key=lambda x: (-x[0], x[1], x[2], x[4]))
    numbers = best_fit([Piece(x[0], x[5], x[6]) for x in cut], capacity)
    shard = group.column("shard")[0].as_py()
    placed = [(x[2], x[3], x[0], shard, number) for x, number in zip(cut, numbers, strict=True)]
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*placed, strict=True), _PLACED, strict=True)]
    ids = group.column("doc_id").take(pa.array([x[4] for x in cut]))
    return pa.Table.from_arrays([ids, *arrays], ["doc_id", *_PLACED.names])


def word_counts(docs: DataFrame, *columns: str) -> DataFrame:
    """(*columns, length): how many words each text has."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            n = pa.array([len(words(t)) for t in column(part, "text")], pa.int32())
            yield pa.RecordBatch.from_arrays([*part.columns[1:], n], [*part.schema.names[1:], "length"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    return docs.select("text", *columns).mapInArrow(run, f"{kinds}, length int")


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    cluster: Column | None = None,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """(doc_id, piece, start_word, n_words, shard, bin): a row for each piece of each row of ``docs``.

    ``cluster`` names the duplicate cluster of a row; by default rows with the
    same letters and digits, whatever their case and spacing, are duplicates.
    """
    same = F.xxhash64(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", ""))
    marked = docs.select("text", "doc_id", "source", (same if cluster is None else cluster).cast("string").alias("cluster"))
    counted = word_counts(marked, "doc_id", "source", "cluster")
    shards = max(1, -(-docs.count() // shard_docs))
    dealt = counted.select(
        "doc_id",
        "source",
        "cluster",
        "length",
        F.xxhash64("doc_id", "source", "cluster", "length").alias("tie"),
        F.pmod(F.xxhash64(F.lit("shard"), F.col("doc_id"), F.col("cluster")), F.lit(shards)).cast("int").alias("shard"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start_word int, n_words int, shard int, bin int"
    return dealt.groupBy("shard").applyInArrow(lambda group: _pack(group, capacity), schema)
