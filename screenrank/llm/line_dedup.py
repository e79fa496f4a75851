"""Line dedup (operator 3): winnowing over line hashes, joined and extended.

A text is split at line feeds; a line counts by its content without blanks
around it, and lines without words only by their place. For every line the
shortest run of lines from it on, and the shortest run back from it, with at
least ``RUN_WORDS`` words is a window. Every window selects its line of least hash
(the last of equal ones) as fingerprint, so equal windows select the same line,
and windows next to each other mostly share one. A fingerprint with all the
lines of the windows that select it makes a block. Two joins find the repeats:

- equal blocks: the match reaches over all windows of the later ones;
- blocks that share a fingerprint but differ elsewhere (the ends of a common run):
  their windows are compared one by one, which extends the match to the last
  common line on both sides.

Of equal windows the first position (by doc_id, then line) stays and the lines of
all later ones are deleted; a window that overlaps its own first position stays
too. Every line of a repeated run of ``RUN_WORDS`` or more words lies in one of its
forward or backward windows, so the whole run goes, and nothing else does.
No pair of positions is ever written out: a group needs its least position
only, which is aggregated before the shuffle.

Defined results: null texts stay null and have no lines; very long texts count
whole; texts with fewer words
than a window keep everything; a null ``doc_id`` comes before all others; rows
that repeat a doc_id and text are one document, rows that repeat a doc_id with
other texts follow in the order of a hash of the text; an empty table gives no
rows; other columns pass through, but for ``lines`` and ``removed``, which are
replaced.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenrank.llm.common import saved
from screenrank.session import ship_by_value

RUN_WORDS = 50
_BLANKS = " \t\n\x0b\x0c\r"
_PLACE = ("doc_id", "form", "first", "last")


def windows(text: str | None, run_words: int) -> tuple[list[int], list[bytes], list[tuple[int, int, int]]]:
    """The text's lines with words, by their numbers and hashes, and its windows in
    order: first line, one behind the last, and fingerprint, as places among these."""
    lines = (text or "").split("\n")
    spoken = [(i, x) for i, x in ((i, x.strip(_BLANKS)) for i, x in enumerate(lines)) if x]
    total = np.concatenate([[0], np.cumsum([len(_words(x)) for _, x in spoken], dtype=np.int64)])
    if total[-1] < run_words:
        return [], [], []
    n = len(spoken)
    digest = [hashlib.md5(x.encode("utf-8", "replace")).digest() for _, x in spoken]
    spans = set()
    ends = np.searchsorted(total, total[:n] + run_words)  # forward: lines s .. end - 1
    spans.update((s, int(e)) for s, e in enumerate(ends) if e <= n)
    starts = np.searchsorted(total, total[1:] - run_words, side="right") - 1  # backward
    spans.update((int(s), e + 1) for e, s in enumerate(starts) if s >= 0)
    return ([i for i, _ in spoken], digest,
            [(s, e, min(range(e - 1, s - 1, -1), key=digest.__getitem__)) for s, e in sorted(spans)])


def _number(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def blocks(text: str | None, run_words: int) -> list[tuple[int, int, int, int, list[dict]]]:
    """(first line, last line, fingerprint, hash of the block, windows) of a text's
    blocks. As both ends of the windows only move on, so do their fingerprints."""
    lines, digest, spans = windows(text, run_words)
    out = []
    for at, group in itertools.groupby(spans, key=lambda w: w[2]):
        group = list(group)
        s, e = group[0][0], group[-1][1]
        # the place of the fingerprint in the block counts: it says which windows select it
        around = hashlib.md5(b"".join(digest[s:e]) + (at - s).to_bytes(8, "little")).digest()
        out.append((lines[s], lines[e - 1], _number(digest[at]), _number(around),
                    [{"first": lines[i], "last": lines[j - 1],
                      "key": _number(hashlib.md5(b"".join(digest[i:j])).digest())} for i, j, _ in group]))
    return out


def _words(line: str) -> list[str]:
    for c in _BLANKS[1:]:
        line = line.replace(c, " ")
    return [w for w in line.split(" ") if w]


def fingerprints(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, form, first, last, mark, around, windows): the blocks of every text,
    ``mark`` the hash of the fingerprint, ``around`` that of the whole block."""
    spans = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("key", pa.int64())]))
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found = [], []
            for i, text in enumerate(batch.column("text")):
                own = blocks(text.as_py(), run_words)
                row += [i] * len(own)
                found += own
            at = pa.array(row, pa.int64())
            columns = list(zip(*found)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("form").take(at)]
                + [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "form", "first", "last", "mark", "around", "windows"])

    return (docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("form"), "text")
            .mapInArrow(run, "doc_id long, form long, first int, last int, mark long, around long, "
                             "windows array<struct<first: int, last: int, key: long>>"))


def _origins(found: DataFrame, key: list[str]) -> DataFrame:
    return found.groupBy(*key).agg(F.min(F.struct(*_PLACE)).alias("origin"), F.count("*").alias("n"))


def repeated_runs(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, form, runs): per text with later repeats its runs of lines to
    delete, an array of (first, last), lines counted from 0."""
    found = saved(fingerprints(docs, run_words), "line-blocks")
    same_text = (F.col("doc_id").eqNullSafe(F.col("origin.doc_id"))
                 & (F.col("form") == F.col("origin.form")))
    behind = F.col("first") > F.col("origin.last")
    whole = ["mark", "around"]
    origins = saved(_origins(found, whole), "line-origins")
    # a block that overlaps its own first place is left to its windows
    repeats = saved(found.join(origins.where("n > 1").drop("n"), whole)
                    .where(~same_text | (F.col("first") > F.col("origin.first")))
                    .select(*_PLACE, "mark", (same_text & ~behind).alias("overlaps")), "line-repeats")
    later = repeats.where("NOT overlaps").select(*_PLACE)
    # the first place of any window is in a block that is the first of its kind, or overlaps that
    live = (origins.select("origin.*", "mark")
            .union(repeats.where("overlaps").select(*_PLACE, "mark")))
    shared = live.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    differing = live.join(shared, "mark").select(F.col("doc_id").alias("of_id"), F.col("form").alias("of_form"),
                                                 F.col("first").alias("of_first"), F.col("mark").alias("of_mark"))
    own = (F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("form") == F.col("of_form"))
           & (F.col("first") == F.col("of_first")) & (F.col("mark") == F.col("of_mark")))
    single = saved(found.join(differing, own, "left_semi")
                   .select("doc_id", "form", "mark", F.explode("windows").alias("w"))
                   .select("doc_id", "form", "w.first", "w.last", "mark", "w.key"), "line-windows")
    extended = (single.join(_origins(single, ["mark", "key"]).where("n > 1").drop("n"), ["mark", "key"])
                .where(~same_text | behind).select(*_PLACE))
    return (later.union(extended).groupBy("doc_id", "form")
            .agg(F.collect_set(F.struct("first", "last")).alias("runs")))


def _kept(text: str, runs) -> tuple[str, int]:
    lines = text.split("\n")
    gone = np.zeros(len(lines) + 1, dtype=np.int64)
    for r in runs:
        gone[r["first"]] += 1
        gone[r["last"] + 1] -= 1
    gone = gone.cumsum()[:-1] > 0
    return "\n".join(x for x, g in zip(lines, gone) if not g), int(gone.sum())


def dedup_lines(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """``docs`` with later repeated runs cut out of ``text``, and ``lines`` (of
    the input text, null for null) and ``removed`` (lines deleted)."""
    @F.pandas_udf("text string, removed int")
    def cut(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        done = [("", 0) if t is None else _kept(t, r) for t, r in zip(texts, runs)]
        return pd.DataFrame(done, columns=["text", "removed"])

    runs = repeated_runs(docs, run_words)
    own = docs.columns
    d = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"),
                    F.xxhash64("text").alias("own_form"))
    hit = F.col("runs").isNotNull()
    # texts without repeats don't travel to Python
    joined = (d.join(runs, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own_form") == F.col("form")), "left")
              .select("doc", hit.alias("hit"), cut(F.when(hit, F.col("doc.text")), "runs").alias("cut")))
    keep = [F.col(f"doc.`{c}`") for c in own if c not in ("text", "lines", "removed")]
    return joined.select(
        *keep, F.when(F.col("hit"), F.col("cut.text")).otherwise(F.col("doc.text")).alias("text"),
        F.size(F.split("doc.text", "\n", -1)).alias("lines"),
        F.when(F.col("hit"), F.col("cut.removed")).otherwise(F.lit(0)).alias("removed"))


ship_by_value(__name__)
