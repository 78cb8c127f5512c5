"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from whole texts in Arrow batches. Trees are grown level
by level on binned statistics (per-node histograms of gradient and hessian) from
a bounded sample of labelled rows, then flattened into arrays, which a batch of
documents traverses all at once.
"""

from __future__ import annotations

import math
import operator
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import small_arrow_batches

SAMPLE_ROWS = 20_000     # most labelled rows that the trees are fitted on
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
L2 = 1.0
#: ASCII marks that plain prose rarely holds.
_ODD = np.frombuffer(b"!#$%&*+/<=>?@[\\]^`{|}~", np.uint8)

FEATURES = ("chars", "words", "word_length", "distinct", "repeats", "top_word", "capitals",
            "caps_words", "odd_marks", "exclaims", "digits", "bars", "line_length",
            "distinct_lines", "longest_word", "stops", "odd_ends", "max_run")


def statistics(text: str) -> list[float]:
    """Numbers that describe a text, in the order of FEATURES; all 0 if empty."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [math.log1p(size)] + [0.0] * (len(FEATURES) - 1)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    same = list(map(operator.eq, words, words[1:]))
    run = longest = 0
    if any(same):
        for x in same:
            run = run + 1 if x else 0
            longest = max(longest, run)
    byte = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    # ends of words: a letter, a stop or comma, or something odd
    ends = Counter(w[-1] for w in words)
    odd_ends = sum(c for ch, c in ends.items() if not ch.isalnum() and ch not in ".,;:'\")")
    return [math.log1p(size), math.log1p(n), sum(map(len, words)) / n, len(counts) / n,
            sum(same) / n, max(counts.values()) / n, int(byte[65:91].sum()) / size,
            sum(map(str.isupper, words)) / n, int(byte[_ODD].sum()) / size, int(byte[33]) / n,
            int(byte[48:58].sum()) / size, int(byte[124]) / n, math.log1p(n / len(lines)),
            len(set(lines)) / len(lines), math.log1p(max(map(len, words))),
            (ends["."] + ends[","]) / n, odd_ends / n, math.log1p(longest)]


@dataclass
class Trees:
    """Flattened trees: node arrays of (trees, 2^(depth+1)-1). A leaf above the
    last level has an infinite cut, so every row goes on to its left child."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        levels = int(math.log2(self.feature.shape[1] + 1)) - 1
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(levels):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            total += v[at]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees on the logistic loss; without rows, or with one label only,
    the constant share of that label."""
    nodes = 2 ** (depth + 1) - 1
    if not len(y) or y.min() == y.max():
        p = 0.5 if not len(y) else (0.99 if y[0] else 0.01)
        return Trees(np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes)),
                     math.log(p / (1 - p)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)])
    n_feat = len(cuts)
    base = math.log(y.mean() / (1 - y.mean()))
    raw = np.full(len(y), base)
    feats, tops, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        feature, cut, value = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            # histograms: node x feature x bin, by one weighted count each
            key = ((at - first) * n_feat + np.arange(n_feat)[:, None]) * BINS + binned
            hists = [np.bincount(key.ravel(), np.broadcast_to(w, key.shape).ravel(),
                                 width * n_feat * BINS).reshape(width, n_feat, BINS)
                     for w in (g, h)]
            gl, hl = (np.cumsum(a, axis=2) for a in hists)
            gt, ht = gl[..., -1:], hl[..., -1:]
            gain = gl ** 2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt ** 2 / (ht + L2)
            gain[(hl < 1) | (ht - hl < 1)] = -1
            flat = gain.reshape(width, -1)
            best = flat.argmax(axis=1)
            binary = np.full(width, BINS)
            for node in range(width):
                if flat[node, best[node]] > 1e-6:
                    f, b = divmod(int(best[node]), BINS)
                    feature[first + node], cut[first + node] = f, cuts[f][b]
                    binary[node] = b
            local = at - first
            at = 2 * at + 1 + (binned[feature[at], np.arange(len(y))] > binary[local])
        first = 2 ** depth - 1
        gs = np.bincount(at - first, g, 2 ** depth)
        hs = np.bincount(at - first, h, 2 ** depth)
        value[first:] = -RATE * gs / (hs + L2)
        raw += value[at]
        feats.append(feature)
        tops.append(cut)
        values.append(value)
    return Trees(np.array(feats), np.array(tops), np.array(values), base)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on at most ``sample_rows`` labelled documents, chosen by a hash of the
    id. Null labels and ids are left out; a document with several labels counts
    with the smallest, a repeated document with its first text."""
    chosen = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y"))
              .where("__id is not null and __y is not null")
              .groupBy("__id").agg(F.min("__y").alias("__y"))
              .orderBy(F.xxhash64("__id"), "__id").limit(sample_rows))
    few = F.broadcast(chosen)                       # at most sample_rows pairs of numbers
    texts = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
             .join(few, "__id"))
    rows = _with_statistics(texts, "__y").groupBy("id").agg(
        F.min(F.struct("x", "y")).alias("r")).select("r.*").limit(2 * sample_rows).collect()
    x = np.array([r["x"] for r in rows], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in rows], float))


def _with_statistics(texts: DataFrame, label: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(x, pa.list_(pa.float64())), b.column(2)],
                names=["id", "x", "y"])

    small_arrow_batches(texts.sparkSession)
    return texts.select("__id", "__text", F.col(label).cast("double")).mapInArrow(
        run, "id long, x array<double>, y double")


def score(docs: DataFrame, model: Trees, text_col: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text; null is empty.

    Repeated rows get equal scores, an empty table stays empty; a column that is
    already named ``into`` is replaced."""
    others = [c for c in docs.columns if c != into]
    schema = docs.select(*others).schema.add(into, "double")
    at = others.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t or "") for t in b.column(at).to_pylist()], float)
            s = model.score(x.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], names=[*others, into])

    small_arrow_batches(docs.sparkSession)
    return docs.select(*others).mapInArrow(run, schema)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
