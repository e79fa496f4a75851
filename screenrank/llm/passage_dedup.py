"""Passage dedup: winnowing over word shingles, joined fingerprints, extension.

Beside ``line_dedup``, whose runs are made of whole lines, this finds repeated
runs of ``RUN_WORDS`` or more words wherever they begin and end, inside a line
or across line borders. A word is a maximal run of characters other than blanks,
compared as it stands.

Shingles of ``SEED_WORDS`` words are hashed; every window of ``RUN_WORDS`` words
selects its shingle of least hash, the last of equal ones. Windows next to each
other mostly select the same place, so about two words in 36 are fingerprints,
and equal windows select the same one. A fingerprint and all the words of the
windows that select it make a block. Two joins find the repeats:

- equal blocks: all windows of the later ones are repeats;
- blocks that share a fingerprint but differ elsewhere (the ends of a common
  run): their windows are compared one by one, which extends the match to the
  last common word on both sides.

A window that stands at an earlier place (by doc_id, then word) is a repeat,
and the words of repeats are deleted; a window that overlaps its own first place
stays. So exactly the words in common runs of ``RUN_WORDS`` or more go, but for
chance collisions of 64-bit hashes. No pair of places is ever written out.

What is cut goes from the first to the last deleted word, with the blanks that
follow on the line, and with the line feed if nothing stays on the line.

Defined results: null texts stay null and have no words; texts of fewer words
than a window stay; a null ``doc_id`` comes before all others; rows that repeat
a doc_id and text are one document, rows that repeat a doc_id with other texts
follow in the order of a hash of the text; an empty table gives no rows; other
columns pass through, but for ``removed``, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenrank.llm.common import saved
from screenrank.llm.words import blank_words, rolling
from screenrank.session import ship_by_value

RUN_WORDS = 50
SEED_WORDS = 16
_STEP = 32_768  # windows looked at together; bounds the memory of a long text
_BLOCK_BASE, _WINDOW_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def blocks(text: str | None, run_words: int, seed_words: int) -> tuple[np.ndarray, ...]:
    """(first word, last word, fingerprint, hash of the block) of a text's blocks."""
    w = blank_words(text)[2]
    n = len(w) - run_words + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 4
    seeds = rolling(w, seed_words)
    reach = run_words - seed_words + 1
    at = np.empty(n, np.int64)
    for i in range(0, n, _STEP):
        view = np.lib.stride_tricks.sliding_window_view(seeds[i:i + _STEP + reach - 1], reach)
        at[i:i + _STEP] = np.arange(i, i + len(view)) + reach - 1 - view[:, ::-1].argmin(axis=1)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], n) - 1 + run_words - 1
    mark = seeds[at[first]]
    # the place of the fingerprint in the block counts, and so does the length
    whole = rolling(w, last - first + 1, _BLOCK_BASE, first)
    whole = whole ^ rolling(np.stack([at[first] - first, last - first], 1).astype(np.uint64).ravel(), 2)[::2]
    return first, last, mark.view(np.int64), whole.view(np.int64)


def _emitted(batch: pa.RecordBatch, row: list, names: list[str], columns: list) -> pa.RecordBatch:
    at = pa.array(np.concatenate(row) if row else [], pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(at), batch.column("form").take(at)]
        + [pa.array(np.concatenate(c) if c else [], t) for c, t in columns],
        names=["doc_id", "form", *names])


def _origins(found: DataFrame, key: list[str]) -> DataFrame:
    return found.groupBy(*key).agg(F.min(F.struct("doc_id", "form", "first", "last")).alias("origin"),
                                   F.count("*").alias("n"))


def _same_text() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("origin.doc_id")) & (F.col("form") == F.col("origin.form"))


def repeated_words(docs: DataFrame, run_words: int = RUN_WORDS, seed_words: int = SEED_WORDS) -> DataFrame:
    """(doc_id, form, runs): per text with later repeats its runs of words to
    delete, an array of (first, last), words counted from 0."""
    def emit_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cols = [], ([], [], [], [])
            for i, text in enumerate(batch.column("text")):
                found = blocks(text.as_py(), run_words, seed_words)
                if len(found[0]):
                    row.append(np.full(len(found[0]), i))
                    for c, x in zip(cols, found):
                        c.append(x)
            yield _emitted(batch, row, ["first", "last", "mark", "around"],
                           list(zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))))

    def emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cols = [], ([], [], [], [])
            for i, (text, parts) in enumerate(zip(batch.column("text"), batch.column("parts"))):
                w = blank_words(text.as_py())[2]
                parts = parts.as_py()
                start = np.concatenate([np.arange(p["first"], p["last"] - run_words + 2) for p in parts])
                mark = np.concatenate([np.full(p["last"] - run_words + 2 - p["first"], p["mark"]) for p in parts])
                row.append(np.full(len(start), i))
                for c, x in zip(cols, (start, start + run_words - 1, mark,
                                       rolling(w, run_words, _WINDOW_BASE, start).view(np.int64))):
                    c.append(x)
            yield _emitted(batch, row, ["first", "last", "mark", "around"],
                           list(zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))))

    schema = "doc_id long, form long, first int, last int, mark long, around long"
    d = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("form"), "text")
    found = saved(d.mapInArrow(emit_blocks, schema), "passage-blocks")
    key = ["mark", "around"]
    origins = saved(_origins(found, key), "passage-origins")
    # a block that overlaps its own first place is left to its windows
    overlaps = _same_text() & (F.col("first") < F.col("origin.first") + run_words)
    repeats = saved(found.join(origins.where("n > 1").drop("n"), key)
                    .where(~_same_text() | (F.col("first") > F.col("origin.first")))
                    .select("doc_id", "form", "first", "last", "mark", overlaps.alias("overlaps")), "passage-repeats")
    place = ["doc_id", "form", "first", "last"]
    later = repeats.where(~F.col("overlaps")).select(*place)
    live = (origins.select("mark", "origin.*").select(*place, "mark")
            .union(repeats.where("overlaps").select(*place, "mark")))
    shared = live.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    parts = (live.join(shared, "mark").groupBy(F.col("doc_id").alias("id"), F.col("form").alias("f"))
             .agg(F.collect_set(F.struct("first", "last", "mark")).alias("parts")))
    singles = saved(
        d.join(parts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("form") == F.col("f")))
        .select("doc_id", "form", "text", "parts").mapInArrow(emit_windows, schema), "passage-windows")
    later_singles = (singles.join(_origins(singles, key).where("n > 1").drop("n"), key)
                     .where(~_same_text() | (F.col("first") > F.col("origin.last")))
                     .select(*place))
    return (later.union(later_singles).groupBy("doc_id", "form")
            .agg(F.collect_set(F.struct("first", "last")).alias("runs")))


def _kept(text: str, runs) -> tuple[str, int]:
    raw = text.encode("utf-8", "replace")
    start, end, _ = blank_words(text)
    edge = np.zeros(len(start) + 1, dtype=np.int64)
    for r in runs:
        edge[r["first"]] += 1
        edge[r["last"] + 1] -= 1
    gone = edge.cumsum()[:-1] > 0
    turn = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
    out, upto = bytearray(), 0
    for a, b in zip(start[turn[::2]].tolist(), end[turn[1::2] - 1].tolist()):
        out += raw[upto:a]
        upto = b
        while raw[upto:upto + 1] in (b" ", b"\t"):
            upto += 1
        if raw[upto:upto + 1] == b"\n" and not out[out.rfind(b"\n") + 1:].strip():
            upto += 1
    return (bytes(out) + raw[upto:]).decode("utf-8"), int(gone.sum())


def dedup_passages(docs: DataFrame, run_words: int = RUN_WORDS, seed_words: int = SEED_WORDS) -> DataFrame:
    """``docs`` with later repeated runs of words cut out of ``text``, and
    ``removed`` (words deleted)."""
    @F.pandas_udf("text string, removed int")
    def cut(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        done = [("", 0) if t is None else _kept(t, r) for t, r in zip(texts, runs)]
        return pd.DataFrame(done, columns=["text", "removed"])

    runs = repeated_words(docs, run_words, seed_words)
    d = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"),
                    F.xxhash64("text").alias("own_form"))
    hit = F.col("runs").isNotNull()
    # texts without repeats don't travel to Python
    joined = (d.join(runs, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own_form") == F.col("form")), "left")
              .select("doc", hit.alias("hit"), cut(F.when(hit, F.col("doc.text")), "runs").alias("cut")))
    keep = [F.col(f"doc.`{c}`") for c in docs.columns if c not in ("text", "removed")]
    return joined.select(
        *keep, F.when(F.col("hit"), F.col("cut.text")).otherwise(F.col("doc.text")).alias("text"),
        F.when(F.col("hit"), F.col("cut.removed")).otherwise(F.lit(0)).alias("removed"))


ship_by_value(__name__)
