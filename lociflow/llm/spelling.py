"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Words are runs of letters (ASCII and U+00C0 to U+00FF), lower-cased in A-Z, some of
them with a code point taken out by a rule on a checksum of document and run, so
that the corpus has misspellings to find (`counted`).

`near_pairs` finds all pairs of words that differ by one inserted, deleted or replaced
code point.  Words of a tile are a matrix of code points padded with zeros, once
from the left and once from the right.  For a whole block of pairs the lengths of
common prefix and common suffix come from the first columns that differ, and two
words are one edit apart just if both together reach the longer length minus one.

Which words share a tile: an edit leaves three of the four quarters of the shorter
word as they are.  So every word is dealt out by its length (and by that less one, as
the longer word of a pair) and all its quarters but one; a pair meets where the first
quarter that holds its edit is left out, and only there it is put out.  Groups of more
than `BLOCK` words are cut into blocks by a hash and go out once for every pair of
blocks, so no task gets a whole group and nothing is dropped.

A word's form is its near word of most occurrences if those are at least `TIMES` its
own; `roots` follows forms by pointer doubling, which ends after a few rounds, as every
step has ten times the occurrences.

A null text has no words; a null id counts as an empty one in the checksum.  Repeated
rows count as often as they stand there.  No words give an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import column, slices, written

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
DROPPED = 31
QUARTERS = 4
#: Words of a group that meet in one task.
BLOCK = 1024
#: Code points of a chunk of small groups, and of the pairs that are compared at once.
CHUNK_POINTS, PAIR_POINTS = 1 << 20, 1 << 21
#: Distinct words that a task counts before it puts them out.
HELD_WORDS = 500_000

# letters keep their Latin-1 byte, all others are spaces
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def results(doc_id: object, text: str, least: int = LEAST_LENGTH) -> Counter:
    """The words of a text, with a code point taken out where the checksum says so."""
    runs = [r for r in text.encode("latin-1", "replace").translate(_LETTERS).split() if len(r) >= least]
    base = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
    out: Counter = Counter()
    for run, n in Counter(runs).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), base)
        if h % DROPPED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        out[run] += n
    return out


def counted(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the distinct words of (doc_id, text) that occur often enough."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def made(held: Counter) -> pa.RecordBatch:
        ws = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([ws, pa.array(list(held.values()), pa.int64())], schema=schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for part in slices(parts, 64):
            for doc_id, text in zip(column(part, "doc_id"), column(part, "text"), strict=True):
                if text:
                    held.update(results(doc_id, text, least_length))
            if len(held) > HELD_WORDS:
                yield made(held)
                held.clear()
        yield made(held)

    partial = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# --- tiles -------------------------------------------------------------------


class Tile:
    """Words as padded matrices of code points."""

    def __init__(self, words: list[str]) -> None:
        width = max(map(len, words))
        self.left = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)
        self.right = np.array([w[::-1] for w in words], f"U{width}").view(np.uint32).reshape(len(words), width)
        self.length = np.fromiter(map(len, words), np.int64, len(words))

    def compare(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which pairs of different words are one edit apart; common prefix and suffix of all pairs."""
        ends = []
        for m in (self.left, self.right):
            differs = m[a] != m[b]
            first = differs.argmax(axis=1)
            ends.append(np.where(differs[np.arange(len(a)), first], first, m.shape[1]))
        longer = np.maximum(self.length[a], self.length[b])
        close = np.abs(self.length[a] - self.length[b]) <= 1
        return close & (ends[0] + ends[1] >= longer - 1), ends[0], ends[1]


def _first_quarter(length: np.ndarray, prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The first quarter of the shorter word without which the rest of it is common."""
    found = np.full(len(length), QUARTERS, np.int64)
    for s in range(QUARTERS - 1, -1, -1):
        fits_ = (prefix >= length * s // QUARTERS) & (suffix >= length - length * (s + 1) // QUARTERS)
        found[fits_] = s
    return found


def _candidates(group: np.ndarray, own: np.ndarray, apart: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group (rows stand in runs), of different blocks where ``apart``, in pieces of about ``limit``.

    Run by run of a group: row i meets the rows i + 1, i + 2, ... of its run.
    """
    n = len(group)
    last = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, n)
    end = np.repeat(last, np.diff(np.concatenate([[0], last])))
    todo = np.arange(n)
    shift = 1
    held, size = [], 0
    while True:
        todo = todo[todo + shift < end[todo]]
        if not len(todo):
            break
        other = todo + shift
        # inside a pair of different blocks only rows of different blocks meet
        keep = ~apart[todo] | (own[todo] != own[other])
        held.append((todo[keep], other[keep]))
        size += int(keep.sum())
        shift += 1
        if size >= limit:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, size = [], 0
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _links(rows: pa.Table) -> pa.RecordBatch:
    """The near pairs of whole groups, both ways round."""
    words = rows.column("word").to_pylist()
    length, quarter, own, i, j, n = (rows.column(c).to_numpy() for c in ("length", "quarter", "own", "i", "j", "n"))
    rest = rows.column("rest").to_pylist()
    starts = [k == 0 or rest[k] != rest[k - 1] for k in range(len(rest))]
    changed = np.array(starts) | np.r_[True, (length[1:] != length[:-1]) | (quarter[1:] != quarter[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
    group = np.cumsum(changed)
    tile = Tile(words)
    limit = max(64, PAIR_POINTS // tile.left.shape[1])
    found = []
    for a, b in _candidates(group, own, i != j, limit):
        # two longer words meet where both are the shorter ones of a pair
        some = (tile.length[a] == length[a]) | (tile.length[b] == length[a])
        a, b = a[some], b[some]
        for at in range(0, len(a), limit):
            x, y = a[at : at + limit], b[at : at + limit]
            near, prefix, suffix = tile.compare(x, y)
            x, y = x[near], y[near]
            first = _first_quarter(length[x], prefix[near], suffix[near]) == quarter[x]
            found.append((x[first], y[first]))
    a = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
    b = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)
    one, other = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
    held = rows.column("word").combine_chunks()
    counts = rows.column("n").combine_chunks()
    return pa.RecordBatch.from_arrays([held.take(one), held.take(other), counts.take(other)], ["word", "other", "other_n"])


def _keyed(words: DataFrame) -> DataFrame:
    """Every word once for each quarter left out, as the shorter and as the longer word of a pair."""
    m, length = F.length("word"), F.col("length")
    start, stop = (F.floor(length * (F.col("quarter") + k) / QUARTERS).cast("int") for k in (0, 1))
    roles = words.withColumn("length", F.explode(F.array(m, m - 1))).filter(F.col("length") >= LEAST_LENGTH)
    roles = roles.withColumn("quarter", F.explode(F.sequence(F.lit(0), F.lit(QUARTERS - 1))))
    rest = F.concat(F.substring("word", F.lit(1), start), F.substring("word", m - length + stop + 1, length - stop))
    return roles.select("length", "quarter", rest.alias("rest"), "word", "n")


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, other, other_n) for all words of (word, n) that are one edit apart, both ways round, each pair once."""
    key = ["length", "quarter", "rest"]
    keyed = _keyed(words)
    large = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > block)
    large = written(large.select(*key, F.ceil(F.col("members") / block).cast("int").alias("blocks")), "large-groups")
    if large.isEmpty():
        cut = keyed.select("*", *(F.lit(0).alias(c) for c in ("own", "i", "j")))
    else:
        blocks = F.coalesce("blocks", F.lit(1))
        cut = keyed.join(large, key, "left").withColumn("own", F.pmod(F.xxhash64("word"), blocks).cast("int"))
        cut = cut.withColumn("met", F.explode(F.sequence(F.lit(0), blocks - 1)))
        cut = cut.select(*key, "word", "n", "own", F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j"))
    by = [*key, "i", "j"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        ready, last = 0, None
        for part in slices(parts, 4096):
            begin = 0
            for k, now in enumerate(zip(*(column(part, c) for c in by), strict=True)):
                # a chunk ends between groups only; its matrices are as wide as its last word
                if now != last and (ready + k - begin) * (now[0] + 1) > CHUNK_POINTS and ready + k > begin:
                    yield _links(pa.Table.from_batches([*held, part.slice(begin, k - begin)]))
                    held, ready, begin = [], 0, k
                last = now
            held.append(part.slice(begin))
            ready += part.num_rows - begin
        if ready:
            yield _links(pa.Table.from_batches(held))

    dealt = cut.repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, "word string, other string, other_n long")


# --- forms -------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form reached from every word of (word, form); forms never come back to a word."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(further, "root", "left")
        step = written(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = not step.filter("moved").isEmpty()
        now = step.select("word", "root")
        if not moved:
            return now


def variants(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (doc_id, text)."""
    words = written(counted(docs), "words")
    # the near word of most occurrences, of equal ones the first in code-point order
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form")))
    near = near_pairs(words, block).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left")
    has = -F.col("best.minus") >= TIMES * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best.form")).alias("form"), F.when(has, -F.col("best.minus")).alias("form_n"),
    )
    known = written(known, "forms")
    found = known.join(roots(known.filter("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
