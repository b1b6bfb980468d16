"""Operator 1: quality scores by histogram gradient-boosted trees over document statistics.

The statistics come from the text alone, vectorised over the bytes and words of many documents.
Trees are grown on binned statistics of a bounded sample of labelled documents; all trees are
flattened into arrays, and documents walk all of them together, one level a step.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NOT_SPACE, flat, steps, word_hashes, word_spans

#: The most labelled documents that the trees are grown on: those with the smallest hash of doc_id.
MAX_TRAINING = 20_000
THRESHOLD = 0.3
BINS, TREES, DEPTH, RATE, RIDGE, MIN_ROWS = 64, 80, 4, 0.15, 1.0, 10

_CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": bytes(range(48, 58)),
    "stop": b".", "comma": b",", "shout": b"!?", "bar": b"|", "markup": b"#$%&*+=@\\^_`~<>{}[]",
    "quote": b"\"'()-:;/", "space": b" \t", "line": b"\n", "control": bytes(range(0, 9)) + bytes(range(11, 32)),
}
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _k, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_members)] = _k
STATISTICS = [
    "log_bytes", "log_words", *_CLASSES, "beyond_ascii", "word_bytes", "word_bytes_spread", "distinct_words",
    "top_word", "repeats_last", "repeats_before_last", "distinct_pairs", "ends_plain", "begins_upper", "words_per_stop",
    "log_lines", "distinct_lines", "line_words",
]


def _sums(values: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[ranges[1:]] - total[ranges[:-1]]


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner: distinct values, and the count of the most frequent one."""
    most = np.zeros(n)
    if not len(values):
        return most, most
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])]))
    np.maximum.at(most, owner[first], np.diff(np.append(first, len(values))))
    return np.bincount(owner[first], minlength=n).astype(float), most


def statistics(text: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; all zero where it is null or empty."""
    data, offsets = flat(text)
    n = len(offsets) - 1
    size = np.diff(offsets) - 1.0  # without the line feed that flat() adds
    kind = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * (len(_CLASSES) + 1) + _CLASS_OF[data],
                       minlength=n * (len(_CLASSES) + 1)).reshape(n, -1).astype(float)
    kind[:, list(_CLASSES).index("line")] -= 1
    starts, ends, ranges = word_spans(data, offsets, NOT_SPACE)
    owner = np.repeat(np.arange(n), np.diff(ranges))
    words = np.diff(ranges).astype(float)
    some, bytes_ = np.maximum(words, 1), np.maximum(size, 1)
    hashes = word_hashes(LOWER[data], starts, ends)
    length = (ends - starts).astype(float)
    mean = _sums(length, ranges) / some
    spread = np.sqrt(np.maximum(0, _sums(length**2, ranges) / some - mean**2))
    distinct, top = _distinct(hashes, owner, n)

    def repeats(back):
        same = np.zeros(len(hashes))
        same[back:] = (hashes[back:] == hashes[:-back]) & (owner[back:] == owner[:-back])
        return _sums(same, ranges) / some

    pair = np.zeros(0, np.uint64)
    pair_owner = np.zeros(0, np.int64)
    if len(hashes) > 1:
        inner = owner[1:] == owner[:-1]
        pair, pair_owner = (hashes[:-1] * np.uint64(3) + hashes[1:])[inner], owner[1:][inner]
    first, last = data[starts], data[ends - 1]
    line_ends = np.flatnonzero(data == 10)
    line_starts = np.concatenate([[0], line_ends[:-1] + 1]) if len(line_ends) else line_ends
    full = line_ends > line_starts
    line_starts, line_ends = line_starts[full], line_ends[full]
    line_owner = np.searchsorted(offsets, line_starts, side="right") - 1
    lines = np.bincount(line_owner, minlength=n).astype(float)
    distinct_lines, _ = _distinct(word_hashes(data, line_starts, line_ends), line_owner, n)
    out = np.column_stack([
        np.log1p(size), np.log1p(words), kind / bytes_[:, None], mean, spread, distinct / some, top / some,
        repeats(1), repeats(2), _distinct(pair, pair_owner, n)[0] / np.maximum(1, words - 1),
        _sums((_CLASS_OF[last] == 1) | (last >= 128), ranges) / some, _sums(_CLASS_OF[first] == 0, ranges) / some,
        words / (1 + kind[:, list(_CLASSES).index("stop")]), np.log1p(lines), distinct_lines / np.maximum(1, lines),
        words / np.maximum(1, lines)])
    out[size <= 0] = 0
    return out


class Forest(NamedTuple):
    """All trees, node after node; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boosted trees for the logistic loss; every level's splits come from histograms of the
    gradients by node, statistic and bin."""
    n, m = x.shape
    share = (y.sum() + 1) / (n + 2)  # one example of each label more: no labels give one half
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(m)]
        binned = np.column_stack([np.searchsorted(edges[f], x[:, f]) for f in range(m)])  # x <= edges[b] where bin <= b
        flat_bins = binned + np.arange(m) * BINS
        score = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            own = np.zeros(n, np.int64)
            level = [len(nodes)]
            roots.append(len(nodes))
            nodes.append([0, np.inf, len(nodes), len(nodes), 0.0])
            for deep in range(depth + 1):
                k = len(level)
                sum_g, sum_h = np.bincount(own, g, k), np.bincount(own, h, k)
                for j, node in enumerate(level):
                    nodes[node][4] = float(-RATE * sum_g[j] / (sum_h[j] + RIDGE))
                if deep == depth:
                    break
                at = (own[:, None] * (m * BINS) + flat_bins).ravel()
                shape = (k, m, BINS)
                hist_g, hist_h, hist_n = (
                    np.cumsum(np.bincount(at, None if w is None else np.repeat(w, m), k * m * BINS).reshape(shape), axis=2) for w in (g, h, None))
                rest_g, rest_h = sum_g[:, None, None] - hist_g, sum_h[:, None, None] - hist_h
                gain = hist_g**2 / (hist_h + RIDGE) + rest_g**2 / (rest_h + RIDGE) - (sum_g**2 / (sum_h + RIDGE))[:, None, None]
                gain[(hist_n < MIN_ROWS) | (np.bincount(own, minlength=k)[:, None, None] - hist_n < MIN_ROWS)] = 0
                gain = gain.reshape(k, -1)
                best = gain.argmax(axis=1)
                feature, cut = best // BINS, best % BINS
                below, child = [], np.full((k, 2), -1)
                for j, node in enumerate(level):
                    split = gain[j, best[j]] > 1e-6 and cut[j] < len(edges[feature[j]])
                    sides = [len(nodes), len(nodes) + 1] if split else [node, node]
                    if split:
                        for s in sides:
                            nodes.append([0, np.inf, s, s, 0.0])
                        nodes[node][:4] = [int(feature[j]), float(edges[feature[j]][cut[j]]), *sides]
                        child[j] = [len(below), len(below) + 1]
                        below += sides
                    else:
                        child[j] = len(below)
                        below.append(node)
                own = child[own, (binned[np.arange(n), feature[own]] > cut[own]).astype(int)]
                level = below
            score = score + np.array([nodes[node][4] for node in level])[own]
    if not roots:
        roots, nodes = [0], [[0, np.inf, 0, 0, 0.0]]
    columns = [np.array(c) for c in zip(*nodes)]
    return Forest(columns[0], columns[1].astype(float), columns[2], columns[3], columns[4].astype(float), np.array(roots), base, depth)


def held_out(doc_id: str = "doc_id"):
    """The fold that no label is learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING) -> Forest:
    """Trees from at most ``max_rows`` labelled documents outside the held-out fold."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(~held_out() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))

    def measure(batches):
        for batch in steps(batches):
            found = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(list(found), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    rows = (
        docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")  # max_rows rows of two numbers
        .mapInArrow(measure, "doc_id long, quality int, x array<double>").dropDuplicates(["doc_id"]).orderBy("doc_id").limit(max_rows).collect())
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(STATISTICS))
    return grow(x, np.array([r["quality"] for r in rows], float))


def score(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)  # trees of fixed number and depth

    def judge(batches):
        for batch in steps(batches):
            found = shared.value.scores(statistics(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.withColumn("held_out", F.coalesce(held_out(), F.lit(False))).mapInArrow(
        judge, "doc_id long, held_out boolean, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (1 where score >= threshold).

    Null and empty texts have all-zero statistics and the score that the trees give those;
    repeated rows are scored alike; a null doc_id is kept and is not held out; without labels of
    both kinds every score is the share of label 1; an empty table gives no row; other columns,
    lang and source among them, are not read."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return score(docs, train(docs, labels, max_rows), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that quality_scores() predicts 1 for, with all their columns."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(train(plain, labels, max_rows))
    text_index = docs.columns.index("text")

    def keep(batches):
        for batch in steps(batches, text_index):
            yield batch.filter(pa.array(shared.value.scores(statistics(batch.column(text_index))) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
