"""Personal data: fixed forms, and more of the same kinds found by the words around them.

`base` finds e-mail addresses, IP addresses, card numbers and phone numbers by
their form alone, in time linear in the text.  The rest is bootstrapping:

1. Every base span is an *instance* of its kind.  So is, of no kind yet, every other
   run of non-space characters with a digit or an ``@`` (numbers that go on
   after single spaces are one).  The words next to an instance are its lexical
   *patterns*: two before, two after, one on either side.
2. Pattern and instance are the two sides of a graph, held as a table of its
   edges.  A round scores each pattern for each kind by the mean score of its
   instances, keeps those of at least `SUPPORT` good instances and a mean of
   at least `CONFIDENCE`, and scores the instances of no kind by the patterns that
   hold them (one minus the product of their doubts).  Instances must look like
   the kind (`LOOKS`), and one of another kind counts against a pattern.
3. Instances that reach `SURE` after `ROUNDS` rounds are personal data wherever
   they stand; one pattern alone is never enough.

Edges are made distinct inside tasks before the shuffle, and patterns of fewer than
`SUPPORT` instances go at once, as they can never be kept.  Only tables are
joined; what is found goes back to the texts by a digest of the text, so copies are
looked at once.

A null text counts as an empty one and has no spans.  Nothing but the text is
looked at, so repeated rows have equal results; an empty table gives an empty one.
Runs of over `LONGEST` characters are no instances.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import column, slices, written
from lociflow.scale import fits

KINDS = ("email", "ip", "card", "phone")
ROUNDS, SUPPORT, CONFIDENCE, SURE = 3, 3, 0.8, 0.9
#: No pattern is trusted beyond this.
TRUST = 0.85
#: Characters of an instance, of a word beside it, and how far those words are looked for.
LONGEST, WORD, REACH = 100, 40, 120
#: Edges that a task holds before it puts them out.
HELD_EDGES = 200_000

#: What an instance found by its surroundings must look like, by kind.
LOOKS = {
    "email": r"^[^@]*[a-z0-9][^@]*@[^@]*[a-z][^@]*$",
    "ip": r"^[0-9a-f]*([.:]+[0-9a-f]+){3,8}$",
    "card": r"^[0-9]([ ./-]*[0-9]){11,18}$",
    "phone": r"^[+(]*[0-9]([ ()./-]*[0-9]){6,14}$",
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_NUMBER = re.compile(r"[(+]?[0-9][0-9().-]*")
_MORE = re.compile(r" [(]?[0-9][0-9().-]*(?![^\x20\x09-\x0D.,;:!?])")
_EDGE = ".,;:!?\"'<>[]{}()"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every ``@`` with a domain back over what may stand before it, as far as the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
        at = text.find("@", at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time of every run of numbers with dots between them."""
    for run in _DOTTED.finditer(text):
        numbers, start = run.group().split("."), run.start()
        for k in range(0, len(numbers) - 3, 4):
            four = numbers[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(x := n.lstrip("0")) < 4 and int(x or 0) < 256 for n in four):
                yield start, end
            start = end + 1


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _DIGITS.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            yield m.span()


def base(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of what its form alone gives away, in order."""
    if not text:
        return []
    spans = [(a, 0, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        for kind, found in ((1, _addresses), (2, _cards), (3, _phones)):
            spans += [(a, kind, b) for a, b in found(text)]
    return sorted(spans)


def others(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the runs with a digit or an ``@`` that overlap no span."""
    out, done, k = [], 0, 0
    by_start = sorted((a, b) for a, _, b in spans)
    for mark in _MARK.finditer(text):
        if mark.start() < done:
            continue
        start = max(done, 1 + max(text.rfind(c, done, mark.start()) for c in " \t\n\v\f\r"))
        space = _SPACE.search(text, mark.start())
        end = space.start() if space else len(text)
        if _NUMBER.fullmatch(text, start, end):
            while more := _MORE.match(text, end):
                end = more.end()
        done = end
        while start < end and text[start] in _EDGE:
            start += 1
        while start < end and text[end - 1] in _EDGE:
            end -= 1
        while k < len(by_start) and by_start[k][1] <= start:
            k += 1
        if start < end <= start + LONGEST and not any(a < end and start < b for a, b in by_start[k : k + 4 * len(KINDS)]):
            out.append((start, end))
    return out


def instance(text: str, start: int, end: int) -> str:
    return " ".join(text[start:end].lower().split())


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a place: the words before it, after it, and on either side; digits count as 0."""
    before = ["^", "^", *(w[-WORD:] for w in text[max(0, start - REACH) : start].lower().split()[-2:])][-2:]
    after = [*(w[:WORD] for w in text[end : end + REACH].lower().split()[:2]), "$", "$"][:2]
    made = (f"{before[0]} {before[1]} _", f"_ {after[0]} {after[1]}", f"{before[1]} _ {after[0]}")
    return [re.sub("[0-9]", "0", p) for p in made]


# --- Spark -------------------------------------------------------------------


def edges(docs: DataFrame) -> DataFrame:
    """(pattern, instance, kind): which words stand around which instance; kind is null where the form tells none."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[tuple[str, str, str | None]] = set()

        def made() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) or [[], [], []]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["pattern", "instance", "kind"])

        for part in slices(parts, 64):
            for text in column(part, "text"):
                if not text or not _MARK.search(text):
                    continue
                spans = base(text)
                places = [(a, b, KINDS[kind]) for a, kind, b in spans] + [(a, b, None) for a, b in others(text, spans)]
                for a, b, kind in places:
                    what = instance(text, a, b)
                    held.update((p, what, kind) for p in contexts(text, a, b))
            if len(held) > HELD_EDGES:
                yield made()
        yield made()

    return docs.select("text").mapInArrow(run, "pattern string, instance string, kind string").distinct()


def _looks_like(kind: Column, what: Column) -> Column:
    out = F.lit(False)
    for k, form in LOOKS.items():
        out = out | ((kind == k) & what.rlike(form))
    return out


def discovered(graph: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """What ``rounds`` rounds over the edges find: patterns (pattern, kind, confidence) and instances (instance, kind, score)."""
    graph = written(graph, "edges")
    sizes = graph.select("pattern", "instance").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    graph = written(graph.join(sizes.filter(F.col("size") >= SUPPORT), "pattern"), "graph")
    seeds = graph.filter("kind IS NOT NULL").select("pattern", "size", "kind", F.lit(1.0).alias("score"))
    known = graph.filter("kind IS NOT NULL").select("instance").distinct()
    # what has a kind by its form somewhere keeps to it
    open_ = graph.filter("kind IS NULL").select("pattern", "size", "instance").join(known, "instance", "left_anti")
    open_ = written(open_, "open")
    found = None
    for _ in range(rounds):
        scored = seeds if found is None else seeds.union(open_.join(found, "instance").select("pattern", "size", "kind", "score"))
        good = F.sum(F.when(F.col("score") >= 0.5, 1).otherwise(0))
        marks = scored.groupBy("pattern", "kind", "size").agg(F.sum("score").alias("sum"), good.alias("good"))
        patterns = marks.select("pattern", "kind", (F.col("sum") / F.col("size")).alias("confidence"), "good")
        patterns = written(patterns.filter((F.col("good") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE)).drop("good"), "patterns")
        doubt = F.sum(F.log(1 - F.least("confidence", F.lit(TRUST))))
        met = open_.join(patterns, "pattern").filter(_looks_like(F.col("kind"), F.col("instance")))
        found = written(met.groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score")), "instances")
    # of several kinds the likeliest; of equal ones the first listed
    rank = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    best = F.min(F.struct((-F.col("score")).alias("minus"), rank.alias("rank"), "kind")).alias("best")
    sure = found.filter(F.col("score") >= SURE).groupBy("instance").agg(best)
    return patterns, written(sure.select("instance", "best.kind", (-F.col("best.minus")).alias("score")), "found")


def _digest(text: str | None) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass")), np.int64).tolist())


_SPANS = "array<struct<start: long, kind: long, end: long>>"


def _base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base_sha256, base, d1, d2) of every row."""
    span = pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, 64):
            texts = column(part, "text")
            found = [base(t) for t in texts]
            sums = [hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in f).encode()).hexdigest() for f in found]
            d1, d2 = zip(*map(_digest, texts), strict=True)
            spans = pa.array([[{"start": a, "kind": k, "end": b} for a, k, b in f] for f in found], pa.list_(span))
            arrays = [part.column(0), pa.array(sums), spans, pa.array(d1, pa.int64()), pa.array(d2, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "base_sha256", "base", "d1", "d2"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base_sha256 string, base {_SPANS}, d1 long, d2 long")


def _places(docs: DataFrame) -> DataFrame:
    """(d1, d2, instance, start, end) of every place of an instance that no base span tells."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, 64):
            rows = []
            for text in column(part, "text"):
                if text and _MARK.search(text):
                    rows += [(*_digest(text), instance(text, a, b), a, b) for a, b in others(text, base(text))]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["d1", "d2", "instance", "start", "end"])

    return docs.select("text").mapInArrow(run, "d1 long, d2 long, instance string, start long, end long")


def spans(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, base_sha256, base, added) of every row of (doc_id, text): spans as structs of start, kind number and end."""
    _, found = discovered(edges(docs), rounds)
    whole = _base_spans(docs)
    if found.isEmpty():
        return whole.select("doc_id", "base_sha256", "base", F.array().cast(_SPANS).alias("added"))
    number = (F.array_position(F.lit(list(KINDS)), F.col("kind")) - 1).cast("long")
    listed = found.select("instance", number.alias("kind"))
    listed = F.broadcast(listed) if fits(listed) else listed
    # copies of a text have the same places
    added = _places(docs).join(listed, "instance").select("d1", "d2", "start", "kind", "end").distinct()
    added = added.groupBy("d1", "d2").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("added"))
    added = written(added, "added")
    joined = whole.join(F.broadcast(added) if fits(added) else added, ["d1", "d2"], "left")
    return joined.select("doc_id", "base_sha256", "base", F.coalesce("added", F.array().cast(_SPANS)).alias("added"))


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row.

    The counts of kinds, like the digest, are those of the base spans; ``spans`` has all.
    """
    found = spans(docs, rounds)
    names = F.lit(list(KINDS))
    told = F.transform(
        F.array_sort(F.concat("base", "added")),
        lambda s: F.concat_ws(":", F.get(names, s["kind"].cast("int")), s["start"].cast("string"), s["end"].cast("string")),
    )

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    return found.select(
        "doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)), "base_sha256",
        F.array_join(told, ",").alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
