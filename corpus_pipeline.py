"""Training-data pipeline over ``documents``: five operators in turn.

quality classifier (rejected documents go), n-gram Jaccard join (one document
of each near-duplicate class stays), benchmark decontamination (documents that
hold an item go), mixing (each document as often as the mix takes it), token
files. Every stage works on all that its predecessor kept and is written to
the shared scratch folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from screenrank.llm.catalogue import tokenizer_path
from screenrank.llm.common import saved
from screenrank.llm.decontaminate import clean_documents
from screenrank.llm.mixing import mixed_documents
from screenrank.llm.ngram_join import one_per_class
from screenrank.llm.quality import good_documents
from screenrank.llm.token_files import read_token_files, token_index, write_token_files
from screenrank.session import scratch_path


#: Rows of the batches that go to Python and back: each holds whole texts, and
#: Spark's usual 10,000 of them would take a large part of an executor's memory.
BATCH_ROWS = 1000


def _bounded_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores as good; empty and null texts are scored like any
    other, repeated rows alike, very long texts whole; no rows give no rows."""
    _bounded_batches(spark)
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, whatever its id; texts without words
    stay; see ``one_per_class``."""
    _bounded_batches(spark)
    return one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item, each by its own text, rows without an id
    included; see ``clean_documents``."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it; texts without words, which take
    nothing, at most as often as their rate says; see ``mix``."""
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files, read back; null ids
    come first, null and empty texts have the end id only."""
    _bounded_batches(spark)
    path = scratch_path(spark, "corpus-token-files")
    write_token_files(docs, path, tokenizer_path())
    return token_index(read_token_files(spark, path))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

#: A trained classifier and a tokenizer are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
