"""Packing into fixed windows (operator 13): minimum bin slack on length counts.

A document's ids (with an end id behind them) are cut into whole windows and a
remainder. Remainders matter by their length only, and there are fewer lengths
than a window has places. So the packing is worked out on the counts per
length, whatever the number of documents: a bitset holds the sums that the
remaining lengths can reach, one shift per length and binary share of its
count; the reachable sum closest to the capacity is traced back into a multiset
of lengths (the largest remaining length is always in it), and that window is
repeated until one of its lengths runs out. Where no multiset fills the window,
one more remainder is cut to fill it, and the rest of it waits as a length of
its own. What is left below one window makes windows at falling powers of two.

The plan gives intervals of ranks per length, so a document finds its places
from its own rank among the remainders of its length: ranks are counted in the
tokenizing task and moved by the counts of the tasks before it. No ids are
shuffled, and no sequence is gathered in one place unless ``sequences`` is asked
for.

Defined results: a null or empty text has only the end id; every row is a
document of its own, whatever its ``doc_id`` (null and repeated ones included);
equal lengths are dealt in the order of reading; a very long text fills many
windows and its remainder is packed like any other; an empty table gives no
pieces; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenrank.llm.common import saved, small_side
from screenrank.session import ship_by_value

CAPACITY = 1024
END_ID = 0
#: Parts of text whose ids a worker keeps; it starts anew beyond that.
CACHE_PARTS = 1_000_000
#: Texts of one batch that leaves a task.
SLICE_TEXTS = 256

PLAN = "r int, spans array<struct<lo: long, hi: long, cut: int, length: int, first: long, each: int, base: long, at: int>>"

# ------------------------------------------------------------------ encoding

_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: White space other than blank and line feed, and what some take for it.
_WIDE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
#: Byte-level rules look at more than the next character here; and the first
#: mark of special tokens.
_NEAR = ("  ", "\n\n", " \n", "\n ", "<|")
_PROBE = "Hello, wörld's end.\n'tis \"so\" (a) x1y2 9,5 naïve!? it's\nDon't."


class _Encoder:
    """Text -> ids as little-endian 32-bit bytes, for byte-level tokenizers.

    Their pre-tokenizer cuts before every blank or line feed that stands alone
    between other characters, so a text's ids are those of its parts in turn
    (a part takes the blank before it along) and each distinct part is encoded
    once. A part that is a word and punctuation behind it is two lookups more.
    Texts with other white space go through the whole tokenizer, and so do all
    texts if the parts of ``_PROBE`` don't give what the whole gives.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model  # each access to the library's makes a new one
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in (0x20, *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100))]
        self.spelled = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in letters})
        self.heads, self.tails = _Parts(self, ""), _Parts(self, " ")
        self.marks = _Marks(self)
        self.feed = self.whole("\n")
        self.apart = self._by_parts(_PROBE) == self.whole(_PROBE)

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, text: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(text.translate(self.spelled))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _by_parts(self, text: str) -> bytes:
        heads, tails, out = self.heads, self.tails, []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(b"".join([heads[first], *map(tails.__getitem__, rest)]))
        return self.feed.join(out)

    def _simple(self, text: str) -> bool:
        return (text[0] not in " \n" and text[-1] not in " \n" and not any(x in text for x in _NEAR)
                and (text.replace("\n", "").isprintable() or not _WIDE.search(text)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.apart or not self._simple(text):
            return self.whole(text)
        for cache in (self.heads, self.tails, self.marks):
            if len(cache) > CACHE_PARTS:
                cache.clear()
        return self._by_parts(text)


class _Parts(dict):
    """Part -> its ids behind ``before`` (nothing or a blank), filled on demand."""

    def __init__(self, encoder: _Encoder, before: str) -> None:
        super().__init__()
        self.encoder, self.before = encoder, before

    def __missing__(self, text: str) -> bytes:
        word = text.rstrip(_PUNCTUATION)
        if not (word.isascii() and word.isalpha() or _LATIN.fullmatch(word)):
            ids = self.encoder.whole(self.before + text)
        elif len(word) < len(text):
            ids = self[word] + self.encoder.marks[text[len(word):]]
        else:
            ids = self.encoder.word(self.before + word)
        self[text] = ids
        return ids


class _Marks(dict):
    def __init__(self, encoder: _Encoder) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, text: str) -> bytes:
        self[text] = ids = self.encoder.whole(text)
        return ids


def _encoder(path: str) -> _Encoder:
    """One encoder a worker process, kept on the library's module: this module's
    own globals are shipped anew with every task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    kept = vars(tokenizers).setdefault("_packing_encoders", {})
    if path not in kept:
        kept[path] = _Encoder(path)
    return kept[path]


def _tokens(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """One row a document: ``ids`` as bytes, their number ``n``, and within the
    task (``part``) the number of whole windows before it and its rank among the
    remainders of its length."""
    names = ["doc_id", "part", "n", "windows", "rank", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end = _encoder(path).encode, np.array([end_id], dtype="<u4").tobytes()
        part, windows, seen = TaskContext.get().partitionId(), 0, defaultdict(int)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_TEXTS):
                ids = [encode(t) + end for t in batch.column("text").slice(i, SLICE_TEXTS).to_pylist()]
                size = [len(x) // 4 for x in ids]
                before, rank = [], []
                for n in size:
                    before.append(windows)
                    rank.append(seen[n % capacity])
                    windows += n // capacity
                    seen[n % capacity] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, SLICE_TEXTS), pa.array([part] * len(ids), pa.int32()),
                     pa.array(size, pa.int64()), pa.array(before, pa.int64()), pa.array(rank, pa.int64()),
                     pa.array(ids, pa.binary())], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, part int, n long, windows long, rank long, ids binary")


# ------------------------------------------------------------------- the plan

def closest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (length -> copies) with the sum closest to
    ``capacity`` from below that holds the largest length that fits."""
    fits = sorted((x for x, c in counts.items() if c and x <= capacity), reverse=True)
    if not fits:
        return {}
    room = capacity - fits[0]
    reach, steps, mask = 1, [], (2 << room) - 1
    for x in fits:
        copies = min(counts[x] - (x == fits[0]), room // x)
        share = 1
        while copies > 0:  # 1, 2, 4, ... and the rest make every number of copies
            share = min(share, copies)
            steps.append((x, share, reach))
            reach |= reach << share * x & mask
            copies -= share
            share *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, defaultdict(int, {fits[0]: 1})
    for x, share, before in reversed(steps):
        if not before >> total & 1:
            chosen[x] += share
            total -= share * x
    return dict(chosen)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Windows for ``counts`` remainders of each length: rows (r, lo, hi, cut,
    length, first, each, base, at) and the number of windows.

    Of the remainders of length ``r``, those of rank lo <= rank < hi put their
    ``length`` ids from place ``cut`` on into a window: with t = first + rank -
    lo into window base + t // each, at place at + t % each * length.
    """
    pool = {x: deque([(x, 0, 0, c)]) for x, c in counts.items() if c}  # r, cut, lo, hi
    left = {x: c for x, c in counts.items() if c}
    total, base, rows = sum(x * c for x, c in left.items()), 0, []

    def take(length: int, number: int) -> Iterator[tuple]:
        left[length] -= number
        while number:
            r, cut, lo, hi = pool[length].popleft()
            if hi - lo > number:
                pool[length].appendleft((r, cut, lo + number, hi))
                hi = lo + number
            number -= hi - lo
            yield r, cut, lo, hi

    def put(length: int, times: int, each: int, at: int, width: int) -> None:
        """``times * each`` items of ``length``, ``width`` ids of each; their rests go back."""
        first = 0
        for r, cut, lo, hi in take(length, times * each):
            rows.append((r, lo, hi, cut, width, first, each, base, at))
            first += hi - lo
            if width < length:
                pool.setdefault(length - width, deque()).append((r, cut + width, lo, hi))
                left[length - width] = left.get(length - width, 0) + hi - lo

    while total:
        room = capacity if total >= capacity else 1 << total.bit_length() - 1
        chosen = closest(left, room)
        slack = room - sum(x * k for x, k in chosen.items())
        times = min([total // room, *(left[x] // k for x, k in chosen.items())])
        if slack:  # whatever is left out is longer than the slack: else it would be in
            long = max(x for x, c in left.items() if c > chosen.get(x, 0))
            times = min(times, left[long] // (chosen.get(long, 0) + 1))
        at = 0
        for x, k in chosen.items():
            put(x, times, k, at, x)
            at += k * x
        if slack:
            put(long, times, 1, at, slack)
        base += times
        total -= times * room
    return rows, base


# --------------------------------------------------------------- the operator

def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, ids, doc_tokens, sequence_id, offset) per piece of ``docs``
    (doc_id, text); ``ids`` are the piece's ids as little-endian unsigned 32-bit
    integers, ``start`` their place in the document, ``offset`` in the sequence."""
    spark = docs.sparkSession
    tokens = saved(_tokens(docs, tokenizer_path, capacity, end_id), "packing-tokens", compression="zstd")
    r = F.pmod("n", F.lit(capacity)).cast("int").alias("r")
    # a row per task and remainder length
    parts = saved(tokens.groupBy("part", r).agg(
        F.count("*").alias("docs"), F.sum(F.floor(F.col("n") / capacity)).alias("full")), "packing-parts")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    ranks = parts.select("part", "r", F.coalesce(F.sum("docs").over(
        before.partitionBy("r").orderBy("part")), F.lit(0)).alias("rank_base"))
    # a row per task
    windows = (parts.groupBy("part").agg(F.sum("full").alias("full"))
               .select("part", F.coalesce(F.sum("full").over(before.orderBy("part")), F.lit(0)).alias("window_base")))
    # fewer rows than a window has places
    counts = {x["r"]: x["docs"] for x in parts.where("r > 0").groupBy("r").agg(F.sum("docs").alias("docs")).collect()}
    rows, base = plan(counts, capacity)
    spans: dict[int, list[tuple]] = defaultdict(list)
    for x in rows:
        spans[x[0]].append(x[1:])
    spans_of = spark.createDataFrame(list(spans.items()), PLAN)

    bases = ranks.join(windows, "part")
    placed = (tokens.withColumn("r", r).join(small_side(bases, parts.count()), ["part", "r"])
              .join(F.broadcast(spans_of), "r", "left"))  # bounded by the window, not by the rows
    rank, full = F.col("rank") + F.col("rank_base"), F.floor(F.col("n") / capacity)
    in_full = F.transform(F.when(full > 0, F.sequence(F.lit(0).cast("long"), full - 1)).otherwise(
        F.array().cast("array<long>")), lambda i: F.struct(
            (i * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
            (F.lit(base) + F.col("window_base") + F.col("windows") + i).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset")))
    mine = F.filter(F.coalesce("spans", F.array()), lambda x: (x["lo"] <= rank) & (rank < x["hi"]))

    def rest(x):
        t = x["first"] + rank - x["lo"]
        return F.struct((full * capacity + x["cut"]).alias("start"), x["length"].cast("long").alias("length"),
                        (x["base"] + F.floor(t / x["each"])).alias("sequence_id"),
                        (x["at"] + F.pmod(t, x["each"].cast("long")) * x["length"]).alias("offset"))

    def cut(p):
        return F.struct(p["start"].alias("start"), p["sequence_id"].alias("sequence_id"),
                        p["offset"].alias("offset"), F.substring(
                            "ids", (p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int")).alias("ids"))

    pieces = F.explode(F.transform(F.concat(in_full, F.transform(mine, rest)), cut)).alias("p")
    return placed.select("doc_id", F.col("n").alias("doc_tokens"), pieces).select(
        "doc_id", "p.start", "p.ids", "doc_tokens", "p.sequence_id", "p.offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts) per sequence: the ids of its pieces in place
    (at most a window of them), and where each piece starts."""
    whole = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(whole.alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
                    F.transform("p", lambda x: x["offset"]).alias("starts")))


ship_by_value(__name__)
