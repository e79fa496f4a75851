"""Language identification (operator 2): families first, then pairs.

A text becomes the square roots of its relative frequencies of hashed byte
2-, 3- and 4-grams (lower case, everything but letters as one blank). Linear
support vector machines, one per family against the rest, choose the language
family; within it, one machine per pair of languages votes. All machines have
the squared hinge loss and are fitted together by accelerated gradient steps on
a bounded sample: at most ``SAMPLE_ROWS`` labelled documents in all, the same
number for every language, chosen by a hash of their id.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
documents without ``lang`` teach nothing; a language outside ``FAMILIES`` is a
family of its own; with a single language all other texts get it with score 1,
with none everything is ``und``; rows that repeat are predicted alike; a null
``doc_id`` is predicted, not held out and not learnt from; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenrank.llm.common import small_side
from screenrank.session import ship_by_value

SAMPLE_ROWS = 6_000
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
WIDTH = 1 << 12
_GRAMS = (2, 3, 4)

# ISO 639-1 codes of closely related languages, by family.
FAMILIES = {
    "germanic": "en de nl af da no nb nn sv is fo lb fy yi",
    "romance": "fr es pt it ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt ug",
    "indic": "hi ur bn pa gu mr ne or si",
    "dravidian": "ta te kn ml",
    "semitic": "ar he mt am",
    "iranian": "fa ku ps tg",
    "austronesian": "id ms tl jv mg mi",
    "sinitic": "zh",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = True
_LETTER[128:] = True


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, lang)


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed byte n-grams of a whole text."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), dtype=np.uint8)
    letter = _LETTER[raw]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # one blank after each run of letters
    a = np.where(letter, raw, 32)[keep].astype(np.uint32)
    counts = np.zeros(WIDTH, dtype=np.int64)
    code = a
    for n in range(2, max(_GRAMS) + 1):
        code = (code[:-1] * np.uint32(0x01000193)) ^ a[n - 1:] if len(code) > 1 else code[:0]
        if n in _GRAMS:
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n)
            counts += np.bincount((mixed * np.uint32(0x85EBCA6B)) >> np.uint32(20), minlength=WIDTH)
    return counts


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _normal(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=-1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1)).astype(np.float32)


def fit_machines(x: np.ndarray, targets: np.ndarray, ridge: float = 1e-4,
                 steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x machines) and offsets; ``targets`` (rows x machines)
    are 1, -1, or 0 where a row doesn't concern a machine."""
    share = np.abs(targets) / np.maximum(np.abs(targets).sum(axis=0), 1)
    longest = max((float((x[i:i + 256] * x[i:i + 256]).sum(axis=1).max()) for i in range(0, len(x), 256)), default=0.0)
    step = 1.0 / (2 * float(x.dtype.type(longest) + 1) + ridge)
    w = np.zeros((x.shape[1], targets.shape[1]), dtype=np.float32)
    b = np.zeros(targets.shape[1], dtype=np.float32)
    w_old, b_old = w, b
    for t in range(steps):
        m = np.float32(t / (t + 3))
        wy, by = w + m * (w - w_old), b + m * (b - b_old)
        miss = np.maximum(0, 1 - targets * (x @ wy + by)) * targets * share
        w_old, b_old = w, b
        w = (wy - step * (ridge * wy - 2 * (x.T @ miss.astype(np.float32)))).astype(np.float32)
        b = (by + step * 2 * miss.sum(axis=0)).astype(np.float32)
    return w, b


class LanguageModel:
    """Family machines, then pair machines within each family. ``overwrite``: ``x``
    is centred in place, so that the sample is in memory once."""

    def __init__(self, x: np.ndarray, langs: list[str], overwrite: bool = False) -> None:
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(k) for k in self.langs})
        self.members = [[i for i, k in enumerate(self.langs) if family_of(k) == f] for f in self.families]
        self.pairs = [p for m in self.members for p in combinations(m, 2)]
        at = np.array([self.langs.index(k) for k in langs], dtype=np.int64)
        family = np.array([self.families.index(family_of(k)) for k in langs], dtype=np.int64)
        targets = [np.where(family == f, 1.0, -1.0) for f in range(len(self.families))]
        targets += [(at == i) * 1.0 - (at == j) * 1.0 for i, j in self.pairs]
        self.mean = x.mean(axis=0) if len(x) else np.zeros(WIDTH, dtype=np.float32)
        x = np.subtract(x, self.mean, out=x if overwrite else None)
        self.weights, self.offsets = (fit_machines(x, np.stack(targets, axis=1))
                                      if targets else (np.zeros((WIDTH, 0)), np.zeros(0)))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language numbers and scores: the chosen family's share of the family
        machines' confidence, times the mean confidence of the language's pairs."""
        margin = (x - self.mean) @ self.weights + self.offsets
        sure = 1 / (1 + np.exp(-4 * np.clip(margin.astype(np.float64), -20, 20)))
        nf = len(self.families)
        family = margin[:, :nf].argmax(axis=1)
        rows = np.arange(len(x))
        part = sure[rows, family] / sure[:, :nf].sum(axis=1) if nf > 1 else np.ones(len(x))
        votes = np.zeros((len(x), len(self.langs)))
        trust = np.zeros((len(x), len(self.langs)))
        for k, (i, j) in enumerate(self.pairs):
            p = sure[:, nf + k]
            votes[:, i] += p >= 0.5
            votes[:, j] += p < 0.5
            trust[:, i] += p
            trust[:, j] += 1 - p
        size = np.array([len(m) for m in self.members])[family]
        mine = np.array([[i in m for i in range(len(self.langs))] for m in self.members])[family]
        lang = np.where(mine, votes + trust / (len(self.langs) + 1), -1).argmax(axis=1)
        mean_trust = np.where(size > 1, trust[rows, lang] / np.maximum(size - 1, 1), 1.0)
        return lang, np.clip(part * mean_trust, 0, 1)


def fold(folds: int) -> Column:
    """Remainder of crc32 of the id as text; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on a bounded sample of the labelled documents outside the held-out fold."""
    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            c = gram_counts(t) if has_letter(t) else np.zeros(WIDTH, dtype=np.int64)
            at = np.flatnonzero(c)
            out.append(at.astype("<u2").tobytes() + c[at].astype("<u4").tobytes())
        return pd.Series(out, dtype=object)

    usable = docs.select(F.col("doc_id").cast("long"), "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(FOLDS) != HELD_OUT))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"))
    n_langs = max(1, counts.count())
    per_lang = max(1, sample_rows // n_langs)
    # a hash bound leaves about twice the rows wanted of each language, however
    # many it has; only those are ranked
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1) / F.lit(float(2 ** 63))
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = (usable.select("doc_id", "lang", place.alias("place")).join(small_side(counts, n_langs), "lang")
              .where(F.col("place") <= (2 * per_lang + 50) / F.col("n"))
              .withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_lang)
              .select("doc_id").distinct())
    got = (usable.join(F.broadcast(chosen), "doc_id").select("doc_id", "lang", packed("text").alias("x"))
           .dropDuplicates(["doc_id"]).orderBy(F.desc("doc_id")).collect())  # at most sample_rows, taken from the end
    langs, used = [], 0
    x = np.zeros((len(got), WIDTH), dtype=np.float32)
    while got:
        r = got.pop()
        n = len(r["x"]) // 6
        if n:
            c = np.zeros(WIDTH)
            c[np.frombuffer(r["x"], dtype="<u2", count=n)] = np.frombuffer(r["x"], dtype="<u4", offset=2 * n)
            langs.append(r["lang"])
            x[used] = _normal(c)
            used += 1
    return LanguageModel(x[:used], langs, overwrite=True)


def detector(model: LanguageModel, step: int = 256) -> Callable[[str], Column]:
    """Column function text -> struct(lang_pred, score)."""
    @F.pandas_udf("lang_pred string, score double")
    def detect(texts: pd.Series) -> pd.DataFrame:
        langs = np.full(len(texts), UNKNOWN, dtype=object)
        scores = np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if model.langs and has_letter(t)]
        for k in range(0, len(known), step):
            part = known[k:k + step]
            x = np.stack([_normal(gram_counts(texts.iloc[i])) for i in part])
            at, score = model.predict(x)
            langs[part] = [model.langs[i] for i in at]
            scores[part] = score
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    return detect


ship_by_value(__name__)
