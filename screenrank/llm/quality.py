"""Quality classifier (operator 4): histogram gradient-boosted trees.

A text becomes ``FEATURES``, statistics of its characters, words and lines.
Trees are grown level by level on binned features with the logistic loss: the
sums of gradients per (node, feature, bin) are one ``bincount``. They are kept
as flat arrays of complete trees, so scoring is a few array look-ups for all
documents and trees at once. The fit uses at most ``SAMPLE_ROWS`` labelled
documents (a few numbers each), chosen by a hash of their id.

Defined results: a null text counts as empty, and an empty text has a score;
label rows without id or quality are ignored, a document with several labels
has the least of them; without labels, or with one class only, every score is
the share of good labels (0.5 without any); rows that repeat are scored alike;
a null ``doc_id`` is scored and not held out; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenrank.session import ship_by_value

SAMPLE_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
GOOD_SCORE = 0.3
TREES, DEPTH, RATE, BINS = 80, 4, 0.15, 64

_CLASSES = {  # characters counted, by name
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": "abcdefghijklmnopqrstuvwxyz", "digit": "0123456789",
    "space": " \t", "line": "\n\r", "stop": ".", "comma": ",;:", "mark": "!?", "bar": "|",
    "symbol": "#$%&*@^~+=<>", "bracket": "()[]{}", "quote": "\"'`", "dash": "-_/\\",
}
FEATURES = ([f"share_{k}" for k in _CLASSES] + ["share_multibyte", "entropy", "log_chars", "log_words"]
            + ["mean_word", "long_words", "short_words", "distinct_words", "top_word", "repeated_next",
               "capital_words", "odd_ends", "log_lines", "distinct_lines", "mean_line", "words_per_stop"])
_CODE = np.zeros(256, dtype=np.int64)
for _i, _chars in enumerate(_CLASSES.values()):
    _CODE[[ord(c) for c in _chars]] = _i + 1
_CODE[128:] = len(_CLASSES) + 1


def statistics(text: str | None) -> list[float]:
    """``FEATURES`` of one whole text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    byte = np.bincount(raw, minlength=256)
    n = max(1, len(raw))
    by_class = np.bincount(_CODE, weights=byte, minlength=len(_CLASSES) + 2)[1:] / n
    p = byte[byte > 0] / n
    words = text.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    ends = Counter(x[-1] for x in words)
    starts = Counter(x[0] for x in words)
    return [*by_class, float(-(p * np.log2(p)).sum()), np.log1p(len(text)), np.log1p(len(words)),
            lengths.sum() / w, (lengths > 12).sum() / w, (lengths <= 3).sum() / w,
            len(seen) / w, max(seen.values(), default=0) / w,
            sum(map(eq, words, words[1:])) / w,
            sum(v for c, v in starts.items() if c.isupper()) / w,
            sum(v for c, v in ends.items() if not c.isalnum()) / w,
            np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), np.log1p(len(words) / max(1, len(lines))),
            np.log1p(len(words) / (1 + text.count(".")))]


class Trees:
    """Boosted complete trees in flat arrays."""

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray) -> None:
        self.base, self.feature, self.cut, self.leaf = base, feature, cut, leaf

    def score(self, x: np.ndarray, step: int = 2048) -> np.ndarray:
        """Probability of label 1 per row: all trees of a slice of rows descend together."""
        n_trees, inner = self.feature.shape
        depth = (inner + 1).bit_length() - 1
        tree = np.arange(n_trees)
        out = np.empty(len(x))
        for i in range(0, len(x), step):
            part = x[i:i + step]
            row = np.arange(len(part))[:, None]
            node = np.zeros((len(part), n_trees), dtype=np.int64)
            for _ in range(depth):
                right = part[row, self.feature[tree, node]] > self.cut[tree, node]
                node = 2 * node + 1 + right
            out[i:i + step] = self.base + self.leaf[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
              bins: int = BINS, ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Fit on rows ``x`` with labels ``y`` (0/1); ``least`` is the smallest sum
    of second derivatives in a child."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = min(max(y.mean() if len(y) else 0.5, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    feature = np.zeros((trees, inner), dtype=np.int64)
    cut = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    if not len(y) or y.min() == y.max():
        return Trees(base, feature, cut, leaf)
    n, m = x.shape
    quantiles = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0)  # bins - 1 cuts a feature
    place = np.stack([np.searchsorted(quantiles[:, f], x[:, f], side="left") for f in range(m)], axis=1)
    place += np.arange(m) * bins
    total = np.full(n, base)
    for t in range(trees):
        prob = 1 / (1 + np.exp(-total))
        grad, hess = prob - y, prob * (1 - prob)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            k = 2 ** level
            at = (node[:, None] * (m * bins) + place).ravel()
            g = np.bincount(at, np.repeat(grad, m), k * m * bins).reshape(k, m, bins).cumsum(axis=2)
            h = np.bincount(at, np.repeat(hess, m), k * m * bins).reshape(k, m, bins).cumsum(axis=2)
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            gl, hl, gr, hr = g[:, :, :-1], h[:, :, :-1], g_all - g[:, :, :-1], h_all - h[:, :, :-1]
            gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - g_all ** 2 / (h_all + ridge)
            gain[(hl < least) | (hr < least)] = 0
            best = gain.reshape(k, -1).argmax(axis=1)
            f, b = np.divmod(best, bins - 1)
            good = gain.reshape(k, -1)[np.arange(k), best] > 1e-9
            first = k - 1
            feature[t, first:first + k] = np.where(good, f, 0)
            cut[t, first:first + k] = np.where(good, quantiles[b, f], np.inf)
            node = 2 * node + (x[np.arange(n), feature[t, first + node]] > cut[t, first + node])
        g, h = np.bincount(node, grad, leaves), np.bincount(node, hess, leaves)
        leaf[t] = -rate * g / (h + ridge)
        total += leaf[t][node]
    return Trees(base, feature, cut, leaf)


def fold(folds: int) -> Column:
    """Remainder of crc32 of the id as text; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def _matrix(texts: pd.Series) -> np.ndarray:
    x = np.array([statistics(t) for t in texts], dtype=np.float64)
    return x.reshape(len(texts), len(FEATURES))


def _features() -> Callable[[str], Column]:
    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_matrix(texts)))

    return features


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on a bounded sample of the labelled documents outside the held-out fold."""
    chosen = (labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
              .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold(FOLDS) != HELD_OUT))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    got = (docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
           .select("doc_id", "quality", _features()("text").alias("x"))
           .dropDuplicates(["doc_id"]).orderBy("doc_id").collect())  # at most sample_rows
    x = np.array([r["x"] for r in got], dtype=np.float64).reshape(len(got), len(FEATURES))
    return fit_trees(x, np.array([r["quality"] for r in got], dtype=np.float64))


def scorer(model: Trees) -> Callable[[str], Column]:
    """Column function text -> probability of a good text."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(texts)))

    return score


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without those that the classifier rejects."""
    return docs.where(scorer(train(docs, labels, **options))("text") >= GOOD_SCORE)


ship_by_value(__name__)
