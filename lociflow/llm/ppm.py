"""Language identification by prediction by partial matching.

Every language has a context tree over bytes: counts of the symbols seen after
the last three, two, one and no bytes.  With the counts frozen, the code length
of a byte is that of its longest seen context, plus the escapes from the longer
ones that don't know it (method C: a context with n symbols, d of them
distinct, gives a symbol seen c times c / (n + d) and its escape d / (n + d));
below the empty context all 256 bytes are alike.  A text goes to the language
that codes it shortest.

The trees are learnt from a bounded sample, at most `SAMPLE_DOCS` texts and
`SAMPLE_BYTES` bytes a language, taken in the order of a hash of the key.  No text
gives more than its first `SAMPLE_BYTES` / `TEXT_SHARE` characters to it, so none
rules a language's counts, and a language of long texts alone is learnt, too.  All
texts are scored whole, in one pass over the rows without a shuffle.

Null texts and texts without a letter are ``und`` with score 0; so is every text
when there is nothing to learn from.  Ties go to the first language in order of
name.  Repeated rows give repeated rows, an empty table an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociflow.llm.common import column, fresh, held_out, mapped, own, slices, training_row, with_fields
from lociflow.scale import lookup_join

SAMPLE_DOCS = 400
SAMPLE_BYTES = 1_500_000
#: Times as many rows as are wanted that are ranked.
RANKED = 4
#: The sample takes no more characters of a text than this part of its bytes.
TEXT_SHARE = 100
#: Texts are scored together until they have so many bytes.
CHUNK = 1 << 18
START = b"\n\n\n"
_LETTER = regex.compile(r"\p{L}")
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def gram_counts(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 1 to 4 bytes: the distinct runs as numbers, and how often each occurs as context and symbol."""
    codes: list[list[np.ndarray]] = [[], [], [], []]
    for text in texts:
        b = np.frombuffer(START + text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64)
        code = np.zeros(len(b) - 3, np.uint64)
        for k in range(4):
            code = b[3:] if k == 0 else code + (b[3 - k : len(b) - k] << np.uint64(8 * k))
            codes[k].append(code)
    return [np.unique(np.concatenate(c), return_counts=True) if c else (np.empty(0, np.uint64), np.empty(0, int)) for c in codes]


class Grams:
    """Numbers of known grams, looked up in an open hash table; 0 is any other gram."""

    def __init__(self, codes: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(4 * len(codes) + 1))))
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys, self.numbers = np.full(1 << bits, _EMPTY), np.zeros(1 << bits, np.int32)
        left, number = codes, np.arange(1, len(codes) + 1, dtype=np.int32)
        slot = self._slot(left)
        while len(left):
            free = self.keys[slot] == _EMPTY
            first = np.zeros(len(left), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.numbers[slot[put]] = left[put], number[put]
            left, number, slot = left[~put], number[~put], slot[~put]
            # those that found their slot taken look at the next one
            slot = np.where(self.keys[slot] == _EMPTY, slot, (slot + np.uint64(1)) & self.mask)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def of(self, codes: np.ndarray) -> np.ndarray:
        slot = self._slot(codes)
        key = self.keys[slot]
        out = np.where(key == codes, self.numbers[slot], 0)
        open_ = np.flatnonzero((key != codes) & (key != _EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + np.uint64(1)) & self.mask
            key = self.keys[slot[open_]]
            hit = key == codes[open_]
            out[open_[hit]] = self.numbers[slot[open_[hit]]]
            open_ = open_[~hit & (key != _EMPTY)]
        return out


class Trees(NamedTuple):
    """Code lengths in bits, one column a language.

    ``order1`` and ``escape2`` are complete tables.  ``order2`` and ``order3``
    have a row for each gram known to any language, with the escapes of the
    languages that don't know it worked in; ``escape3`` has a row for each
    three-byte context.  Row 0 stands for unknown grams.
    """

    langs: list[str]
    order1: np.ndarray
    escape2: np.ndarray
    tri: Grams
    order2: np.ndarray
    escape3: np.ndarray
    four: Grams
    order3: np.ndarray

    def bits(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Code lengths of texts that lie one after another, each with START before it."""
        b = data.astype(np.uint64)
        code = np.zeros(len(b), np.uint64)
        code[3:] = (b[:-3] << np.uint64(24)) | (b[1:-2] << np.uint64(16)) | (b[2:-1] << np.uint64(8)) | b[3:]
        number = self.four.of(code)
        for k in range(3):
            number[starts + k] = 0
        cost = self.order3.take(number, axis=0)
        rest = number == 0
        for k in range(3):
            rest[starts + k] = False
        at = np.flatnonzero(rest)
        if len(at):
            code = code[at]
            last3 = code & np.uint64(0xFFFFFF)
            known, before = self.tri.of(last3), self.tri.of(code >> np.uint64(8))
            shorter = self.escape2.take(last3 >> np.uint64(8), axis=0) + self.order1.take(last3 & np.uint64(0xFFFF), axis=0)
            cost[at] = self.escape3.take(before, axis=0) + np.where(known[:, None] > 0, self.order2.take(known, axis=0), shorter)
        return np.add.reduceat(cost, starts, axis=0)


def grow(langs: list[str], counts: list[list[tuple[np.ndarray, np.ndarray]]]) -> Trees:
    """Code lengths from the counts of every language."""
    width = len(langs)

    def contexts(k: int, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts of k bytes, with how many symbols and how many distinct ones follow."""
        code, n = counts[i][k]
        ctx, first = np.unique(code >> np.uint64(8), return_index=True)
        edges = np.append(first, len(code))
        return ctx, np.add.reduceat(n, first) if len(n) else n, np.diff(edges)

    def own(k: int, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams of k context bytes and a symbol, with the bits of the symbol in its context."""
        code, n = counts[i][k]
        ctx, total, distinct = contexts(k, i)
        at = np.searchsorted(ctx, code >> np.uint64(8))
        return code, np.log2((total + distinct)[at] / n)

    def escapes(k: int, i: int) -> tuple[np.ndarray, np.ndarray]:
        ctx, total, distinct = contexts(k, i)
        return ctx, np.log2((total + distinct) / distinct)

    order0 = np.empty((256, width))
    order1, escape2 = np.empty((65536, width)), np.zeros((65536, width))
    for i in range(width):
        order0[:, i] = escapes(0, i)[1][0] + 8
        code, bits = own(0, i)
        order0[code.astype(int), i] = bits
        after = np.zeros(256)
        ctx, bits = escapes(1, i)
        after[ctx.astype(int)] = bits
        order1[:, i] = np.repeat(after, 256) + np.tile(order0[:, i], 256)
        code, bits = own(1, i)
        order1[code.astype(int), i] = bits
        ctx, bits = escapes(2, i)
        escape2[ctx.astype(int), i] = bits

    # a text's beginning is a context that ends no run of its own
    three = np.unique(np.concatenate([*(counts[i][2][0] for i in range(width)), *(contexts(3, i)[0] for i in range(width))]))
    tri = Grams(three)
    order2 = np.zeros((len(three) + 1, width))
    order2[1:] = escape2[(three >> np.uint64(8)).astype(int)] + order1[(three & np.uint64(0xFFFF)).astype(int)]
    escape3 = np.zeros((len(three) + 1, width))
    for i in range(width):
        code, bits = own(2, i)
        order2[tri.of(code), i] = bits
        ctx, bits = escapes(3, i)
        escape3[tri.of(ctx), i] = bits

    fours = np.unique(np.concatenate([counts[i][3][0] for i in range(width)]))
    four = Grams(fours)
    order3 = np.zeros((len(fours) + 1, width))
    order3[1:] = escape3[tri.of(fours >> np.uint64(8))] + order2[tri.of(fours & np.uint64(0xFFFFFF))]
    for i in range(width):
        code, bits = own(3, i)
        order3[four.of(code), i] = bits
    return Trees(langs, order1, escape2, tri, order2, escape3, four, order3)


def _sample(docs: DataFrame, sample_docs: int, sample_bytes: int) -> DataFrame:
    """At most so many texts of each language, and of those the ones that end within so many bytes.

    Long texts give their beginning only, never more than 4 / `TEXT_SHARE` of the
    bytes.  Ids and lengths are ranked, and only the chosen texts are read.  A
    count of each language bounds the hashes that can be among the first, so
    only about `RANKED` times as many rows as are wanted come to the ranking.
    """
    begin = F.substring("text", 1, max(1, sample_bytes // TEXT_SHARE))
    usable = docs.filter(training_row(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "th")
    usable = lookup_join(usable, usable.groupBy("lang").agg(F.count(F.lit(1)).alias("_all")), "lang")
    place = F.xxhash64("doc_id").cast("double") / 2.0**64 + 0.5
    usable = usable.filter(place * F.col("_all") <= RANKED * sample_docs)
    first = usable.select("doc_id", "lang", F.xxhash64("text").alias("th"), F.octet_length(begin).alias("n"))
    first = first.withColumn("_row", F.row_number().over(order)).filter(F.col("_row") <= sample_docs)
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = first.withColumn("_upto", upto).filter(F.col("_upto") <= sample_bytes)
    # sample_docs rows a language at most, so it may be sent to every task
    chosen = first.select("doc_id", "lang", "th").distinct()
    texts = docs.select("doc_id", "lang", begin.alias("text"), F.xxhash64("text").alias("th"))
    return texts.join(F.broadcast(chosen), ["doc_id", "lang", "th"]).dropDuplicates(["doc_id", "lang", "th"]).select("lang", "text")


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Trees | None:
    """Context trees from the training rows of (doc_id, text, lang); None when there are none."""

    def count(group: pd.DataFrame) -> pd.DataFrame:
        made = {"lang": [group["lang"].iloc[0]]}
        for k, (code, n) in enumerate(gram_counts(list(group["text"]))):
            made[f"g{k}"], made[f"n{k}"] = [code.tobytes()], [n.astype(np.int64).tobytes()]
        return pd.DataFrame(made)

    schema = "lang string, " + ", ".join(f"g{k} binary, n{k} binary" for k in range(4))
    rows = _sample(docs, sample_docs, sample_bytes).groupBy("lang").applyInPandas(count, schema).collect()
    rows = sorted(rows, key=lambda r: r["lang"])
    if not rows:
        return None
    counts = [
        [(np.frombuffer(r[f"g{k}"], np.uint64), np.frombuffer(r[f"n{k}"], np.int64)) for k in range(4)] for r in rows
    ]
    return grow([r["lang"] for r in rows], counts)


def score(trees: Trees, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
    """Language, share of the likelihood that it has, and its bits a byte."""
    langs, shares, rates = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    held: list[bytes] = []
    which: list[int] = []
    size = 0

    def flush() -> None:
        lengths = np.array([len(h) for h in held])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        bits = trees.bits(np.frombuffer(b"".join(held), np.uint8), starts)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(held)), best]
        share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
        for i, b, s, bit, n in zip(which, best, share, least, lengths, strict=True):
            langs[i], shares[i], rates[i] = trees.langs[b], float(s), float(bit / (n - len(START)))

    for i, text in enumerate(texts):
        if text and _LETTER.search(text):
            held.append(START + text.encode("utf-8", "surrogatepass"))
            which.append(i)
            size += len(held[-1])
            if size >= CHUNK:
                flush()
                held, which, size = [], [], 0
    if held:
        flush()
    return langs, shares, rates


def identify(docs: DataFrame, trees: Trees | None, names: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` with lang_pred, score and bits_per_byte (or ``names``); only the text is looked at."""
    names = names or ["lang_pred", "score", "bits_per_byte"]
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            texts = column(part, "text")
            found = score(sent.value, texts) if sent.value else (["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts))
            kinds = (pa.string(), pa.float64(), pa.float64())
            arrays = [*part.columns, *(pa.array(f, k) for f, k in zip(found, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, [*part.schema.names, *names])

    return mapped(docs, run, with_fields(docs, **dict(zip(names, ("string", "double", "double"), strict=True))))


def predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) of every row."""
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def accepted(docs: DataFrame, min_score: float = 0.5, max_bits: float = 8.0) -> DataFrame:
    """The documents with a language: told from the others, and coded in fewer bits than its bytes have."""
    lang, share, rate = fresh(docs, "lang_pred", "share", "rate")
    found = identify(docs, learn(docs), [lang, share, rate])
    sure = (F.col(lang) != "und") & (F.col(share) >= min_score) & (F.col(rate) < max_bits)
    return found.filter(sure).select(*own(docs))
