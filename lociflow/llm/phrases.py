"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words of one document.  A word is removed when
a window that covers it has the same words as one that starts earlier: in a
document with a smaller id, or earlier in its own.  Windows are judged on the
input, not on what is left.

Documents that have the words of an earlier one are copies and go as a whole;
the rest works on the first of them.

1. Each window names an anchor: of its phrases of `PHRASE` words the one with the
   least hash (the first of equals).  Equal windows name the same phrase at the
   same place, so a repeated window has an anchor phrase that occurs twice.
   Phrases are counted by hash; those that recur, and the documents that hold
   them, go on.
2. Around each recurring anchor a document gives a passage: the words of all
   windows that name it.  Equal passages are one from here on, with their
   earliest place.
3. Passages are dealt to shards by their phrase; a phrase with more than
   `HOT_ROWS` places gives single windows, dealt by their words, instead.  A shard
   confirms its recurring phrases word by word, compiles them into an
   Aho-Corasick automaton over word numbers, streams all its passages through it
   to locate every occurrence, and finds for each window the earliest place.
4. Each document compares its windows' places with the earliest ones.

So each document meets the automata of the phrases that it holds and no other,
and the work grows with the text.  Shards have about `SHARD_PHRASES` phrases.

Nulls: a null text has no words; a missing id counts as larger than all others.
Rows with the same id are one document as to the order of places, but keep their
own words; repeated rows don't repeat each other.  Texts of fewer words than a
window stay whole.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import batches, column, fresh, mapped, mix, own, rolling, slices, with_fields, word_hashes, words, written
from lociflow.scale import fits

WINDOW = 20
PHRASE = 6
SHARD_PHRASES = 4_000
HOT_ROWS = 50_000
_LAST = (1 << 63) - 1
_PLACE = 1 << 32


class Anchors(NamedTuple):
    """One entry an anchor: its place, the first and last window that name it, the phrase's hash."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    phrase: np.ndarray


def anchors(hashes: np.ndarray, window: int) -> Anchors:
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return Anchors(none, none, none, none)
    grams = mix(rolling(hashes, PHRASE))
    views = np.lib.stride_tricks.sliding_window_view(grams, window - PHRASE + 1)
    named = views.argmin(axis=1) + np.arange(n)
    low = np.flatnonzero(np.diff(named, prepend=-1) != 0)
    high = np.append(low[1:], n) - 1
    return Anchors(named[low], low, high, grams[named[low]].view(np.int64))


def _key(docs: DataFrame) -> list[Column]:
    """What tells rows apart: the id, and a hash of the text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64("text").alias("th")]


def phrases(docs: DataFrame, window: int) -> DataFrame:
    """(id, th, doc_id, n_words, sha256, phrases) of every row: its words counted, its anchors' phrases."""
    schema = [("n_words", pa.int64()), ("sha256", pa.string()), ("phrases", pa.list_(pa.int64()))]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            counts, sums, named = [], [], []
            for text in column(part, "text"):
                ws = words(text)
                counts.append(len(ws))
                sums.append(hashlib.sha256(b" ".join(ws)).hexdigest())
                named.append(anchors(word_hashes(ws), window).phrase if len(ws) >= window else [])
            arrays = [pa.array(c, k) for c, (_, k) in zip((counts, sums, named), schema, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *arrays], [*part.schema.names[:3], *(s for s, _ in schema)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*_key(docs), "doc_id", "text").mapInArrow(
        run, f"id long, th long, doc_id {kind}, n_words long, sha256 string, phrases array<long>"
    )


def holders(docs: DataFrame, found: DataFrame, recurring: DataFrame, window: int) -> DataFrame:
    """(id, th, text, at, low, high, phrase, hot): the documents with recurring anchors, and those anchors."""
    held = found.select(F.xxhash64("id", "th").alias("row"), F.explode(F.array_distinct("phrases")).alias("phrase"))
    # joins by sort-merge, so a phrase that very many documents hold can be split
    hits = held.join(recurring.select("phrase", (F.col("n") > HOT_ROWS).alias("hot")), "phrase")
    hits = hits.groupBy("row").agg(F.collect_list("phrase").alias("phrases"), F.collect_list("hot").alias("hot"))
    texts = docs.select(*_key(docs), "text")
    joined = texts.withColumn("row", F.xxhash64("id", "th")).join(hits, "row").drop("row")
    kinds = {"at": pa.int32(), "low": pa.int32(), "high": pa.int32(), "phrase": pa.int64(), "hot": pa.bool_()}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            out: dict[str, list] = {name: [] for name in kinds}
            for text, known, hot in zip(column(part, "text"), column(part, "phrases"), column(part, "hot"), strict=True):
                a = anchors(word_hashes(words(text)), window)
                order = np.argsort(known)
                known, hot = np.array(known, np.int64)[order], np.array(hot, bool)[order]
                place = np.minimum(np.searchsorted(known, a.phrase), len(known) - 1)
                keep = known[place] == a.phrase
                for name, values in zip(kinds, (*a, hot[place]), strict=True):
                    out[name].append(values[keep])
            arrays = [pa.array(out[name], pa.list_(kind)) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *arrays], ["id", "th", "text", *kinds])

    schema = "id long, th long, text string, at array<int>, low array<int>, high array<int>, phrase array<long>, hot array<boolean>"
    return joined.select("id", "th", "text", "phrases", "hot").mapInArrow(run, schema)


_PLACES = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("lows", pa.list_(pa.int32()))])
_PASSAGE = pa.schema([
    ("id", pa.int64()), ("low", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()), ("times", pa.int32()),
    ("shard", pa.int32()), ("anchor", pa.int32()), ("passage", pa.string()),
])


def _passages(held: DataFrame, window: int, shards: int, texts: bool) -> DataFrame:
    """A row for each passage of a document (window of a hot anchor): its places, or its first place, times and words."""
    schema = _PASSAGE if texts else _PLACES

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(part: pa.RecordBatch) -> Iterator[tuple]:
            for id_, th, text, *lists in zip(*(column(part, c) for c in part.schema.names), strict=True):
                ws = words(text)
                found: dict[bytes, tuple] = {}
                for at, low, high, phrase, hot in zip(*lists, strict=True):
                    for first, last in ((k, k) for k in range(low, high + 1)) if hot else ((low, high),):
                        passage = b" ".join(ws[first : last + window])
                        # the anchor's place belongs to what is compared
                        digest = xxhash.xxh3_128_digest(passage, seed=at - first)
                        if digest in found:
                            found[digest][0].append(first)
                        else:
                            found[digest] = [first], phrase, hot, at - first, passage
                for digest, (lows, phrase, hot, anchor, passage) in found.items():
                    d1, d2 = int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)
                    if texts:
                        shard = (d1 if hot else phrase) % shards
                        yield id_, lows[0], d1, d2, len(lows), shard, anchor, passage.decode("utf-8", "surrogatepass")
                    else:
                        yield id_, th, d1, d2, lows

        for part in slices(parts):
            yield from batches(rows(part), schema)

    names = {"int32": "int", "int64": "long", "string": "string", "list<item: int32>": "array<int>"}
    return held.mapInArrow(run, ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema))


_VERDICT = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("ids", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))])


def _judge(group: pa.Table, window: int) -> pa.Table:
    """One shard: for each passage that holds a recurring window, the earliest place of each of its windows."""
    numbers: dict[bytes, int] = {}
    passages = [
        [numbers.setdefault(w, len(numbers)) for w in p.encode("utf-8", "surrogatepass").split()]
        for p in group.column("passage").to_pylist()
    ]
    at, n = group.column("anchor").to_pylist(), group.column("n").to_pylist()
    places = list(map(int, group.column("place").to_pylist()))
    # phrases that recur, by their words
    seen: dict[tuple[int, ...], int] = {}
    for p, a, times in zip(passages, at, n, strict=True):
        phrase = tuple(p[a : a + PHRASE])
        seen[phrase] = seen.get(phrase, 0) + times
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for phrase, times in seen.items():
        if times > 1:
            automaton.add_word(phrase, len(automaton))
    del seen
    if not len(automaton):
        return _VERDICT.empty_table()
    automaton.make_automaton()
    located = []
    # windows as runs of four-byte word numbers
    earliest: dict[bytes, int] = {}
    recurs: set[bytes] = set()
    size = 4 * window
    for i, (p, a) in enumerate(zip(passages, at, strict=True)):
        end = a + PHRASE - 1
        if not any(stop == end for stop, _ in automaton.iter(tuple(p))):
            continue
        data, place, again = array("i", p).tobytes(), places[i], n[i] > 1
        located.append((i, data))
        for j in range(len(p) - window + 1):
            w = data[4 * j : 4 * j + size]
            held = earliest.get(w)
            if held is None:
                earliest[w] = place + j
                if again:
                    recurs.add(w)
            else:
                recurs.add(w)
                if place + j < held:
                    earliest[w] = place + j
    out = []
    d1, d2 = group.column("d1").to_pylist(), group.column("d2").to_pylist()
    for i, data in located:
        own = [data[k : k + size] for k in range(0, len(data) - size + 1, 4)]
        if not recurs.isdisjoint(own):
            ids, starts = zip(*[divmod(earliest[w], _PLACE) for w in own], strict=True)
            out.append((d1[i], d2[i], ids, starts))
    return pa.Table.from_batches(batches(out, _VERDICT, 1 << 16), schema=_VERDICT)


class Repeats(NamedTuple):
    found: DataFrame
    copies: DataFrame
    held: DataFrame
    removed: DataFrame


def repeats(docs: DataFrame, window: int = WINDOW) -> Repeats:
    """What a corpus repeats.

    The rows' words counted; the rows that have the words of a document with a
    smaller id; the other documents with recurring phrases; and of those (id,
    th, starts), the windows to remove.
    """
    found = written(phrases(docs, window), "phrases")
    # all windows of a copy stand in the first document with its words already
    first = found.filter(F.col("n_words") >= window).groupBy("sha256").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    # written, so that it may be broadcast, or else both sides of the join are plain exchanges and a text of many copies may be split
    first = written(first.filter("n > 1").drop("n"), "first-copies")
    copies = found.select("id", "th", "sha256").join(F.broadcast(first) if fits(first) else first, "sha256").filter("id <> first")
    copies = written(copies.select("id", "th").distinct(), "copies")
    own = found.join(F.broadcast(copies) if fits(copies) else copies, ["id", "th"], "left_anti")
    counted = own.select(F.explode("phrases").alias("phrase")).groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    recurring = written(counted.filter("n > 1"), "recurring")
    shards = max(1, -(-recurring.count() // SHARD_PHRASES))
    held = written(holders(docs, own, recurring, window), "holders")

    place = F.col("id").cast("decimal(20,0)") * F.lit(_PLACE).cast("decimal(11,0)") + F.col("low")
    passages = _passages(held, window, shards, texts=True).withColumn("place", place.cast("decimal(38,0)"))
    distinct = passages.groupBy("shard", "anchor", "d1", "d2", "passage").agg(F.min("place").alias("place"), F.sum("times").alias("n"))
    verdicts = distinct.groupBy("shard").applyInArrow(
        lambda group: _judge(group, window), "d1 long, d2 long, ids array<long>, places array<int>"
    )
    places = _passages(held, window, shards, texts=False)
    judged = places.join(verdicts, ["d1", "d2"])
    def later(low: Column) -> Column:
        repeated = F.filter(
            F.sequence(F.lit(0), F.size("ids") - 1),
            lambda j: (F.get("ids", j) != F.col("id")) | (F.get("places", j) != low + j),
        )
        return F.transform(repeated, lambda j: low + j)

    starts = judged.select("id", "th", F.flatten(F.transform("lows", later)).alias("starts")).filter(F.size("starts") > 0)
    removed = starts.groupBy("id", "th").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return Repeats(found, copies, held, written(removed, "removed"))


def _covered(n: int, starts: list[int], window: int) -> np.ndarray:
    """Which of n words the windows cover."""
    change = np.zeros(n + 1, np.int64)
    at = np.unique(np.array(starts, np.int64))
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return np.cumsum(change[:n]) > 0


def kept_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    found, copies, held, removed = repeats(docs, window)
    schema = pa.schema([("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            out = []
            for text, starts in zip(column(part, "text"), column(part, "starts"), strict=True):
                ws = words(text)
                gone = _covered(len(ws), starts, window)
                kept = b" ".join([w for w, g in zip(ws, gone.tolist(), strict=True) if not g])
                out.append((int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)] if out else [pa.array([], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([*part.columns[:2], *arrays], ["id", "th", *schema.names])

    cut = held.dropDuplicates(["id", "th"]).select("id", "th", "text").join(removed, ["id", "th"])
    cut = cut.mapInArrow(run, "id long, th long, n_removed long, kept_sha256 string")
    gone = copies.withColumn("copy", F.lit(True))
    whole = found.select("id", "th", "doc_id", "n_words", "sha256").join(gone, ["id", "th"], "left").join(cut, ["id", "th"], "left")
    return whole.select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )


_TOKEN = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with repeated words, and the white space after them, cut out of the text."""
    found, copies, _, removed = repeats(docs, window)
    # of a copy, all windows go
    every = F.sequence(F.lit(0), (F.col("n_words") - window).cast("int")).alias("starts")
    removed = removed.union(found.select("id", "th", "n_words").distinct().join(copies, ["id", "th"]).select("id", "th", every))
    id_, th, starts, r_id, r_th = fresh(docs, "id", "th", "starts", "r_id", "r_th")
    keyed = docs.select("*", *(c.alias(n) for c, n in zip(_key(docs), (id_, th), strict=True)))
    right = removed.toDF(r_id, r_th, starts)
    joined = keyed.join(right, (keyed[id_] == right[r_id]) & (keyed[th] == right[r_th]), "left").select(*own(docs), starts)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            i = part.schema.get_field_index("text")
            texts = []
            for text, at in zip(column(part, "text"), column(part, starts), strict=True):
                if at:
                    data = text.encode("utf-8", "surrogatepass")
                    spans = [m.span() for m in _TOKEN.finditer(data)]
                    gone = _covered(len(spans), at, window).tolist()
                    lead = data[: spans[0][0]]
                    text = (lead + b"".join([data[a:b] for (a, b), g in zip(spans, gone, strict=True) if not g])).decode("utf-8", "surrogatepass")
                texts.append(text)
            columns = part.columns[:-1]
            columns[i] = pa.array(texts, part.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(columns, part.schema.names[:-1])

    return mapped(joined, run, with_fields(docs))
