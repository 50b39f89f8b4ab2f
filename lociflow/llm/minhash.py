"""Near-duplicates by MinHash: banding, signature check, full check, components.

A document's set holds its distinct shingles of ``n`` words (lower-cased in
A-Z); a text with fewer words is one shingle, one without words has an empty set
and is linked with nothing.  Two documents are linked when their Jaccard
similarity is at least ``percent`` / 100.

1. Every text gives the minima of `BANDS` x `ROWS` universal hashes over its set.
   Documents with the same set are one class from here on.
2. Classes that agree on all rows of a band share a bucket.  Each bucket's
   members are paired with its smallest one; pairs whose signatures (a byte a
   minimum) are far too unlike are dropped, all others are confirmed on the full
   sets.  Components of these links follow by large-star and small-star.
3. What a bucket of three or more still holds of different components is compared
   in blocks, member with member and by full sets, so no link between two of them
   is lost; copies of one document are one component by now and are not compared
   again.

A pair of exactly 80 % is missed by all bands with probability 3e-5 and by the
signature check with 1e-5; a true link is lost for the components only if no
other path joins the two.  Groups of any size are split: classes and buckets are
aggregated before the shuffle, pairs are joined by sort-merge, which may split a
hot key, and blocks have at most `BLOCK` members.

A class is known by the digest of its set and not by an id, so an id with several
texts stands in several classes and loses no link; ids come back at the end, when
each component takes the smallest one of its members.

Nulls: a null text has an empty set; rows without id are linked with nothing and
kept.  Repeated rows have the same class.  Of an id with several texts each row is
judged by its own text.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import MULTIPLIER, column, fresh, mix, rolling, slices, word_hashes, written
from lociflow.llm.components import components
from lociflow.scale import fits

WORDS = 5
PERCENT = 80
BANDS, ROWS = 20, 4
#: Pairs whose signatures agree on a smaller share are not confirmed (4.5 standard deviations below the threshold).
SLACK = 0.2
BLOCK = 512

_RANDOM = np.random.default_rng(20)
_A = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    ws = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not ws:
        return np.empty(0, np.uint64)
    return np.unique(mix(rolling(word_hashes(ws), min(n, len(ws)))))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each universal hash over a set."""
    least = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 1024):
        values = _A[:, None] * hashes[None, start : start + 1024]
        values += _B[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One number for each band; different bands never share a bucket."""
    m = mix(least).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = (key + m[:, j]) * MULTIPLIER
    return mix(key)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Are two sets alike enough?  Exact, in whole numbers."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text): rows with a hash of the text, which tells the texts of one id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")


def sets(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, th, n_shingles, cls, keys, signature) of every row of `_hashed`; nulls where the set is empty.

    ``cls`` is a 128-bit digest of the set.
    """
    schema = [("n_shingles", pa.int64()), ("cls", pa.binary()), ("keys", pa.list_(pa.int64())), ("signature", pa.binary())]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            out: list[list] = [[] for _ in schema]
            for text in column(part, "text"):
                h = shingles(text, n)
                row = [len(h), None, None, None]
                if len(h):
                    least = minima(h)
                    signature = (mix(least) & np.uint64(255)).astype(np.uint8).tobytes()
                    row = [len(h), xxhash.xxh3_128_digest(h.tobytes()), band_keys(least).view(np.int64), signature]
                for c, x in zip(out, row, strict=True):
                    c.append(x)
            arrays = [pa.array(c, k) for c, (_, k) in zip(out, schema, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:2], *arrays], ["doc_id", "th", *(name for name, _ in schema)])

    return docs.mapInArrow(run, "doc_id long, th long, n_shingles long, cls binary, keys array<long>, signature binary")


def _close(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose lengths and signatures allow the similarity."""
    least = percent / 100 - SLACK

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            x, y = (np.frombuffer(b"".join(column(part, c)), np.uint8).reshape(part.num_rows, -1) for c in ("x", "y"))
            keep = (x == y).mean(axis=1) >= least
            yield part.select(["a", "b"]).filter(pa.array(keep))

    one = classes.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("x"))
    other = classes.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("y"))
    both = pairs.join(one, "a").join(other, "b")
    both = both.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return both.select("a", "b", "x", "y").mapInArrow(run, pairs.select("a", "b").schema)


def _texts(asked: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, text) of the classes asked for: one text each."""
    asked = written(asked.distinct().join(classes.select("rep", "doc_id", "th"), "rep"), "ids")
    # only texts of paired documents are shuffled; the list is sent to all tasks if it is proven small
    found = docs.join(F.broadcast(asked) if fits(asked) else asked, ["doc_id", "th"]).select("rep", "text")
    # rows that are repeated give a text once
    return found.dropDuplicates(["rep"])


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets."""
    texts = written(_texts(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")), classes, docs), "texts")
    with_b = pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("y")), "b")
    with_both = with_b.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("x")), "a")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str | None, np.ndarray] = None, np.empty(0, np.uint64)
        for part in slices(parts):
            keep = []
            for x, y in zip(part.column(2), part.column(3), strict=True):
                text = x.as_py()
                if held[0] != text:
                    held = text, shingles(text, n)
                keep.append(linked(held[1], shingles(y.as_py(), n), percent))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return with_both.select("a", "b", "x", "y").mapInArrow(run, pairs.select("a", "b").schema)


def _rest(buckets: DataFrame, classes: DataFrame, joined: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between different components in buckets of three and more, their smallest member apart.

    The bucket's smallest member has been compared with all others already.  The
    full sets go to the blocks, so only true links come out, and of those only
    as many as join what was apart: fewer than a block has members.
    """
    placed = buckets.join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    placed = placed.withColumn("component", F.coalesce("component", "rep"))
    mixed = placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("rep").alias("hub"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = mixed.filter("members > 2 AND low <> high").select("key", "hub", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    held = placed.join(mixed, "key").filter("rep <> hub").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = written(
        held.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "component"), "blocks"
    )
    known = classes.join(_full_sets(held.select("rep"), classes, docs, n), "rep").select("rep", "keys", "signature", "hashes")
    least = percent / 100 - SLACK

    def compare(group: pa.Table) -> pa.Table:
        ids, comp, own = (np.asarray(group.column(c)) for c in ("rep", "component", "own"))
        sign = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint8).reshape(len(ids), -1)
        full = [np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()]
        size = np.array([len(h) for h in full])
        keys = np.array(group.column("keys").to_pylist(), np.int64)
        band = int(np.flatnonzero(keys[0] == group.column("key")[0].as_py())[0])
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found = []
        for x in left:
            y = right[ids[right] > ids[x]] if i == j else right
            y = y[(comp[y] != comp[x]) & (100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x]))]
            share = (sign[y] == sign[x]).mean(axis=1)
            # a pair that shares several bands is compared in the first
            open_ = (share >= least) & ~(keys[y, :band] == keys[x, :band]).any(axis=1)
            found.append(np.stack([share[open_], np.full(open_.sum(), x), y[open_]]))
        pairs = np.concatenate(found, axis=1) if found else np.empty((3, 0))
        top: dict[int, int] = {}

        def root(c: int) -> int:
            while c in top:
                c = top[c]
            return c

        a, b = [], []
        for k in np.argsort(-pairs[0], kind="stable"):  # likeliest first, so that most pairs are joined before their turn
            x, y = int(pairs[1, k]), int(pairs[2, k])
            p, q = root(int(comp[x])), root(int(comp[y]))
            if p != q and linked(full[x], full[y], percent):
                top[max(p, q)] = min(p, q)
                a.append(min(ids[x], ids[y]))
                b.append(max(ids[x], ids[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return held.join(known, "rep").groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")


def _full_sets(asked: DataFrame, classes: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(rep, hashes): the whole set of each document asked for."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            made = pa.array([shingles(t, n).tobytes() for t in column(part, "text")], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), made], ["rep", "hashes"])

    return _texts(asked, classes, docs).mapInArrow(run, "rep long, hashes binary")


def _grouped(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, th, n_shingles, component_id, kept) for every row of `_hashed`."""
    all_sets = written(sets(docs, n), "shingle-sets")
    filled = all_sets.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("cls").agg(
        F.min(F.struct("doc_id", "th")).alias("low"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.first("signature").alias("signature")
    )
    # a class gets a number of its own as it is written, and keeps it
    number = F.monotonically_increasing_id().alias("rep")
    classes = written(classes.select(number, "cls", "low.doc_id", "low.th", "n", "keys", "signature"), "classes")

    buckets = classes.select("rep", F.explode("keys").alias("key"))
    hubs = buckets.groupBy("key").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    stars = buckets.join(hubs, "key").filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    links = written(_confirmed(written(_close(stars, classes, percent), "pairs"), classes, docs, n, percent), "confirmed")
    joined = components(links)

    more = written(_rest(buckets, classes, joined, docs, n, percent), "confirmed")
    joined = components(links.union(more))

    # the smallest id of each component of several classes
    members = joined.union(joined.select(F.col("component").alias("id"), "component").distinct())
    members = members.join(classes.select(F.col("rep").alias("id"), "doc_id"), "id")
    least = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked_ = members.join(least, "component").select(F.col("id").alias("rep"), "component_id")
    placed = classes.select("rep", "cls", "doc_id").join(linked_, "rep", "left")
    # written, so that both sides of the next join are plain exchanges and a class of many copies may be split
    placed = written(placed.select("cls", F.coalesce("component_id", "doc_id").alias("component_id")), "placed")
    found = all_sets.select("doc_id", "th", "n_shingles", "cls").join(placed, "cls", "left")
    # without an id there is nothing to be linked by
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    found = found.select("doc_id", "th", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of (doc_id, text)."""
    return _grouped(_hashed(docs), n, percent).drop("th")


def deduplicated(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near-duplicates, and all rows that are in none."""
    dropped = _grouped(_hashed(docs), n, percent).filter(~F.col("kept")).select("doc_id", "th").distinct()
    names = fresh(docs, "dropped", "dropped_th")
    dropped = written(dropped.toDF(*names), "dropped")
    dropped = F.broadcast(dropped) if fits(dropped) else dropped
    same = (docs["doc_id"] == dropped[names[0]]) & (F.xxhash64(docs["text"]) == dropped[names[1]])
    return docs.join(dropped, same, "left_anti")
