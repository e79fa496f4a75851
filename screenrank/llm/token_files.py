"""Token-ID files (operator 9): ORC with run-length encoded ids.

Documents are dealt to files by ranges of ``doc_id`` and sorted within, so the
files in name order are one ascending sequence. A file holds (doc_id, ids);
ORC stores the ids with integer run-length encoding in independent stripes,
with row indexes and a Bloom filter on ``doc_id``: readers take stripes in
parallel, and a filter on ``doc_id`` skips files, stripes and row groups by
their metadata.

Defined results: a null or empty text has only the end id; a null ``doc_id``
sorts first and its row is kept; rows that repeat a ``doc_id`` are all kept,
ordered by text; an empty table gives files without rows; other columns are
ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from screenrank.llm.common import saved
from screenrank.session import ship_by_value

END_ID = 2
#: Pieces of text whose ids a worker keeps; it starts anew beyond that.
CACHE_PIECES = 500_000
#: Texts of one batch that leaves a task.
SLICE_TEXTS = 256

SCHEMA = "doc_id long, ids array<int>"


# A word of Latin letters and ASCII punctuation behind it, but for apostrophes.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_LETTERS = [chr(c) for c in (*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100))]
_PROBES = ["Hello,", "na\u00efve", "\u00dcBER!!", "a", "the", "r\u00e9union.", "stra\u00dfe", "Zz|", "x$$$", "end.\""]


class _Encoder(dict):
    """Text -> ids as little-endian 32-bit bytes.

    For tokenizers whose pieces never cross a blank (their pre-tokenizer
    removes white space), a text's ids are those of its blank-separated parts
    in turn, so each distinct part is encoded once and looked up afterwards.
    Most parts are a plain word and some punctuation: the tokenizer's model
    takes the lower-cased word, and the same word under other punctuation is
    known already. That shortcut is taken only if it agrees with the whole
    tokenizer on ``_PROBES``; all other parts go through the whole tokenizer.

    The encoder is the mapping part -> ids itself and fills on demand.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = str.maketrans({c: byte_level.pre_tokenize_str(c)[0][0] for c in _LETTERS})
        self.words: dict[str, bytes] = {}
        self.plain = all(self._plain(p) == self._whole(p) for p in _PROBES)

    def __missing__(self, part: str) -> bytes:
        ids = self._plain(part) if self.plain else None
        self[part] = ids = self._whole(part) if ids is None else ids
        return ids

    def _whole(self, part: str) -> bytes:
        ids = self.library.encode(part, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _plain(self, part: str) -> bytes | None:
        """The part's ids, or None if it isn't a plain word."""
        found = _PLAIN.fullmatch(part)
        if found is None:
            return None
        word, tail = found.groups()
        word = word.lower()
        ids = self.words.get(word)
        if ids is None:
            pieces = self.library.model.tokenize(word.translate(self.spelled))
            ids = self.words[word] = struct.pack(f"<{len(pieces)}I", *[t.id for t in pieces])
        if not tail:
            return ids
        if tail not in self.words:
            self.words[tail] = self._whole(tail)
        return ids + self.words[tail]

    def encode(self, text: str | None) -> bytes:
        if len(self) > CACHE_PIECES:
            self.clear()
        if len(self.words) > CACHE_PIECES:
            self.words.clear()
        return b"".join(map(self.__getitem__, (text or "").replace("\n", " ").split(" ")))


def _encoder(path: str) -> _Encoder:
    """One encoder a worker process: kept on the library's module, because this
    module's own globals are shipped anew with every task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    kept = vars(tokenizers).setdefault("_token_files_encoders", {})
    if path not in kept:
        kept[path] = _Encoder(path)
    return kept[path]


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids) in the order of ``docs`` within each partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            texts = batch.column("text")
            for i in range(0, batch.num_rows, SLICE_TEXTS):
                parts = [encode(t) + end for t in texts.slice(i, SLICE_TEXTS).to_pylist()]
                offsets = np.zeros(len(parts) + 1, dtype=np.int32)
                np.cumsum([len(b) // 4 for b in parts], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, SLICE_TEXTS),
                     pa.ListArray.from_arrays(pa.array(offsets), values)], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                      stripe_bytes: int = 64 << 20) -> None:
    """Write ``docs`` (doc_id, text) as token files below ``path``."""
    ordered = (docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id")
               .sortWithinPartitions("doc_id", "text"))
    (token_ids(ordered, tokenizer_path, end_id).write
     .option("compression", "zstd").option("orc.stripe.size", str(stripe_bytes))
     .option("orc.create.index", "true").option("orc.row.index.stride", "10000")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .orc(path))


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, ids); ``doc_ids`` is pushed to the ORC reader."""
    df = spark.read.schema(SCHEMA).orc(path)
    return df if doc_ids is None else df.where(F.col("doc_id").isin(doc_ids))


def token_index(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of token files read back: each
    document's place in the one sequence that all files make."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            ends = ids.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in place] + [pa.array(np.diff(ends).astype(np.int64)),
                                                    pa.array(crc, pa.int64())],
                names=[*place, "n_tokens", "ids_crc32"])

    # a row's place in its file: the block it is read in, then the order of reading
    place = ["file", "block", "row", "doc_id"]
    rows = saved(files.select(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"),
                              F.monotonically_increasing_id().alias("row"), "doc_id", "ids")
                 .mapInArrow(digest, "file string, block long, row long, doc_id long, "
                                     "n_tokens long, ids_crc32 long"), "token-index")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # one row a file
    files_at = (rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
                .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at")))
    within = (Window.partitionBy("file").orderBy("block", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("own", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
            .join(files_at, "file")
            .select("doc_id", (F.col("at") + F.col("own")).alias("start"), "n_tokens", "ids_crc32"))


ship_by_value(__name__)
