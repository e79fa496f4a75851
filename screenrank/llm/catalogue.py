"""Registered queries of this package: each applies one operator, with its
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from screenrank.llm import language, oracles
from screenrank.llm.decontaminate import contaminated
from screenrank.llm.common import saved
from screenrank.llm.hard_negatives import hard_negatives
from screenrank.llm.lexical_search import ranked_search
from screenrank.llm.licenses import licensed
from screenrank.llm.line_dedup import dedup_lines
from screenrank.llm.mixing import mix, n_words
from screenrank.llm.ngram_join import ngram_links
from screenrank.llm.packing import pack
from screenrank.llm.passage_dedup import dedup_passages
from screenrank.llm.quality import FOLDS, GOOD_SCORE, HELD_OUT, fold, scorer, train
from screenrank.llm.token_counts import TokenRollup, change
from screenrank.llm.token_files import read_token_files, token_index, write_token_files
from screenrank.llm.topk_search import exact_topk
from screenrank.llm.words import WORD_PATTERN
from screenrank.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    detect = language.detector(language.train(docs))
    return (docs.select("doc_id", detect("text").alias("p"))
            .select("doc_id", F.coalesce(language.fold(language.FOLDS) == language.HELD_OUT,
                                         F.lit(False)).alias("held_out"), "p.lang_pred", "p.score"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "lines", "removed", F.md5("text").alias("kept_md5"))


def passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 for runs of words that begin and end anywhere; the runs of
    op3_line_dedup, as its SQL states them, are made of whole lines."""
    return dedup_passages(_table(spark, sf_dir, "documents")).select(
        "doc_id", "removed", F.md5("text").alias("kept_md5"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    score = scorer(train(docs, _table(spark, sf_dir, "labels")))
    return (docs.select("doc_id", score("text").alias("score"))
            .select("doc_id", F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= GOOD_SCORE).cast("int").alias("predicted")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).selectExpr(
        "doc.doc_id AS doc_id", "size", "source_size", "target", "copies * size AS taken", "copies")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_links(_table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source/lang/doc_id if doc_id ends in 0, the others
    one directory deeper, by the thousand of their doc_id. What is nothing but
    a notice or licence text is a licence file."""
    docs = _table(spark, sf_dir, "documents")
    top = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")))
    name = F.col("doc_id").cast("string")
    path = F.when(F.col("doc_id") % 10 == 0, F.concat_ws("/", top, name)).otherwise(
        F.concat_ws("/", top, F.floor(F.col("doc_id") / 1000).cast("string"), name))
    return (licensed(docs.select("doc_id", "text", path.alias("path"), F.lit(None).cast("boolean").alias("is_licence_file")))
            .select("doc_id", "license", "via"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of two word counts, as two tokenizer versions, over the distinct
    texts, reached by deltas: estimates, their revision, deletion of all but one
    copy of a text, and the second version. The first batches are folded on the
    way, and one before and one behind the fold are replayed."""
    text = F.coalesce("text", F.lit(""))
    docs = saved(_table(spark, sf_dir, "documents").select(
        F.struct(F.col("doc_id").isNull().alias("none"), "doc_id").alias("id"), "source", "lang",
        F.md5(text).alias("text_key"), F.floor(F.length(text) / 5).alias("estimate"), n_words().alias("blanks"),
        F.regexp_count(F.lower(text), F.lit(WORD_PATTERN)).alias("letters")), "token-counts")
    # of each text the row of the smallest doc_id stays; a text is one row per source and lang here
    group = docs.groupBy("text_key", "source", "lang").agg(
        F.min("id").alias("id"), F.count("*").alias("n"), F.first("blanks").alias("blanks"),
        F.first("letters").alias("letters"))
    first = F.row_number().over(Window.partitionBy("text_key").orderBy("id", "source", "lang")) == 1
    copies = saved(group.withColumn("times", F.col("n") - first.cast("long")).where("times > 0"), "token-copies")
    one, two = F.lit("blanks-1").alias("version"), F.lit("letters-1").alias("version")
    rollup = TokenRollup(spark, scratch_path(spark, "token-rollup"))
    inserted = docs.select("source", "lang", one, *change("insert", "estimate"))
    rollup.commit(0, inserted)
    rollup.commit(1, docs.select("source", "lang", one, *change("revise", "blanks", "estimate")))
    rollup.commit(3, docs.select("source", "lang", two, *change("insert", "letters")))
    deleted = (copies.select("source", "lang", one, "times", *change("delete", "blanks"))
               .union(copies.select("source", "lang", two, "times", *change("delete", "letters"))))
    rollup = rollup.fold(1, scratch_path(spark, "token-rollup"))
    for batch, changes in ((2, deleted), (0, inserted), (2, deleted)):
        rollup.commit(batch, changes)
    return rollup.totals()


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_index(read_token_files(spark, path))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_language": op2_language,
    "op3_line_dedup": op3_line_dedup,
    "passage_dedup": passage_dedup,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_ngram_join": op6_ngram_join,
    "op7_licenses": op7_licenses,
    "op8_token_counts": op8_token_counts,
    "op9_token_files": op9_token_files,
    "op10_topk_search": op10_topk_search,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical_search": op12_lexical_search,
    "op13_packing": op13_packing,
}

ORACLES: dict[str, str] = {
    "op1_decontaminate": oracles.DECONTAMINATE,
    "op3_line_dedup": oracles.LINE_DEDUP,
    "op6_ngram_join": oracles.NGRAM_JOIN,
    "op7_licenses": oracles.license_scan(),
    "op8_token_counts": oracles.TOKEN_COUNTS,
    "op10_topk_search": oracles.TOPK_SEARCH,
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
    "op12_lexical_search": oracles.LEXICAL_SEARCH,
}
