"""Quality classifier: histogram gradient-boosted trees over document statistics.

Each text gives `FEATURES` numbers.  Trees of fixed depth are grown on at most
`SAMPLE_ROWS` labelled rows (in the order of a hash of the key) whose features
are cut into histogram bins, with logistic loss.  The forest is flattened into
arrays of feature, threshold and leaf value, in which the children of node i are
2i + 1 and 2i + 2, so numpy moves all rows of a batch down one level at once.

Only the sampled rows' features reach the driver; all texts are scored whole in
one pass without a shuffle.  Null texts count as empty and are scored like any
other; without labelled rows every score is 0.5.  Repeated rows give repeated
rows; a row with several labels is learnt from once for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import column, fresh, held_out, mapped, own, rolling, slices, training_row, with_fields, word_hashes

SAMPLE_ROWS = 20_000
BINS = 64
DEPTH = 4
TREES = 150
RATE = 0.1
MIN_ROWS = 20
THRESHOLD = 0.3

FEATURES = [
    "log_bytes", "log_words", "word_length", "longest_word", "letters", "capitals", "digits", "spaces", "newlines",
    "marks", "beyond_ascii", "stops", "exclamations", "bars", "braces", "repeats_of_last_byte", "entropy",
    "distinct_words", "top_word", "distinct_pairs", "marked_words", "log_lines", "repeated_lines", "line_length",
    "ended_lines",
]

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122))
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_HIGH = _BYTES >= 128
_MARK = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~_DIGIT
_PLAIN = frozenset(b".,;:!?'\"()-")


def _spread(sorted_hashes: np.ndarray) -> tuple[float, float]:
    """Share of distinct values, share of the most frequent one."""
    n = len(sorted_hashes)
    if n == 0:
        return 1.0, 0.0
    edges = np.flatnonzero(np.diff(sorted_hashes) != 0) + 1
    runs = np.diff(np.concatenate([[0], edges, [n]]))
    return len(runs) / n, runs.max() / n


def statistics(text: str | None) -> list[float]:
    data = text.encode("utf-8", "surrogatepass") if text else b""
    b = np.frombuffer(data, np.uint8)
    n = max(1, len(b))
    count = np.bincount(b, minlength=256)
    share = count / n
    ws = data.split()
    hashes = word_hashes(ws)
    m = max(1, len(ws))
    distinct, top = _spread(np.sort(hashes))
    pairs, _ = _spread(np.sort(rolling(hashes, 2)))
    seen = share[share > 0]
    # bytes inside words that prose doesn't use, where a word may end in one plain mark
    odd = _MARK.copy()
    odd[list(_PLAIN)] = False
    marked = count[odd].sum() / m
    lines = [x for x in data.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    ended = sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"') for x in lines)
    return [
        np.log1p(len(b)), np.log1p(len(ws)), count[~_SPACE].sum() / m, float(max(map(len, ws), default=0)), share[_LETTER].sum(),
        share[_UPPER].sum(), share[_DIGIT].sum(), share[_SPACE].sum(), share[10], share[_MARK].sum(), share[_HIGH].sum(),
        count[46] / m, count[33] / m, count[124] / m, (count[123] + count[125] + count[60] + count[62]) / m,
        np.count_nonzero(b[1:] == b[:-1]) / n, float(-(seen * np.log2(seen)).sum()), distinct, top, pairs, marked,
        np.log1p(len(lines)), 1 - len(set(lines)) / k, len(b) / k, ended / k,
    ]


class Forest(NamedTuple):
    """``feature`` and ``threshold``: a row a tree, its inner nodes in breadth order; ``leaf``: the values at the bottom."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1] if self.feature.size else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def constant(start: float = 0.0) -> Forest:
    return Forest(start, np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 0)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Forest:
    """Boost trees on a bounded sample."""
    n, width = x.shape
    share = (y.sum() + 1) / (n + 2)
    start = float(np.log(share / (1 - share)))
    if n < 2 * MIN_ROWS or y.min() == y.max():
        return constant(start)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    # one number for a feature's bin, so one bincount makes the histograms of all features
    flat = binned + np.arange(width) * BINS
    total = np.full(n, start)
    inner = 2**depth - 1
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, k = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (width * BINS) + flat).ravel()
            shape = (k, width, BINS)
            size = k * width * BINS
            g = np.bincount(at, np.repeat(gradient, width), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(weight, width), size).reshape(shape).cumsum(axis=2)
            c = np.bincount(at, minlength=size).reshape(shape).cumsum(axis=2)
            all_g, all_h, all_c = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
            gain[(c < MIN_ROWS) | (all_c - c < MIN_ROWS)] = 0
            for j in range(width):
                gain[:, j, len(cuts[j]) :] = 0
            best = gain.reshape(k, -1).argmax(axis=1)
            for i in range(k):
                j, cut = divmod(int(best[i]), BINS)
                if gain[i, j, cut] > 1e-6:
                    feature[first + i], threshold[first + i] = j, cuts[j][cut]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        bottom = node - inner
        leaf = rate * np.bincount(bottom, gradient, inner + 1) / (np.bincount(bottom, weight, inner + 1) + 1)
        total += leaf[bottom]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Forest(start, np.array(features), np.array(thresholds), np.array(leaves))


def _features(docs: DataFrame, extra: list[str]) -> DataFrame:
    """(*extra, x): the statistics of every text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            x = pa.array([statistics(t) for t in column(part, "text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*part.columns[1:], x], [*extra, "x"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)
    return docs.select("text", *extra).mapInArrow(run, f"{kinds}, x array<double>")


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """A forest for ``labels.quality`` from a bounded sample of the training rows."""
    usable = labels.filter(training_row(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("_y"))
    # the sample has a proven bound, so it may be sent to every task
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "_y").limit(sample_rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # rows of one id may be many, so what comes to the driver is bounded again, by an order of the rows' own
    few = joined.orderBy(F.xxhash64("doc_id"), "doc_id", "_y", F.xxhash64("text")).limit(sample_rows)
    got = _features(few, ["doc_id", "_y"]).collect()
    if not got:
        return constant()
    got = sorted(got, key=lambda r: (r["doc_id"], r["_y"], r["x"]))
    return grow(np.array([r["x"] for r in got]), np.array([float(r["_y"]) for r in got]))


def scored(docs: DataFrame, forest: Forest, name: str = "score") -> DataFrame:
    """The rows of ``docs`` with a score (0 to 1, higher is better); only the text is looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            texts = column(part, "text")
            x = np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sent.value.score(x), pa.float64())], [*part.schema.names, name])

    return mapped(docs, run, with_fields(docs, **{name: "double"}))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    found = scored(docs.select("doc_id", "text"), learn(docs, labels))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``."""
    (name,) = fresh(docs, "score")
    return scored(docs, learn(docs, labels), name).filter(F.col(name) >= threshold).select(*own(docs))
