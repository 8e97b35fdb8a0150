"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Every stage works on all rows that its predecessor kept. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import language_id, pieces
from lectern.llm.decontaminate import decontaminate
from lectern.llm.jaccard_join import jaccard_join
from lectern.llm.secrets import redact
from lectern.llm.shared import durable, new_path, remove_path, scratch, without

#: A document is rejected if no language is likelier than all others together.
LEAST_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model tells with LEAST_SCORE or more; null texts and those without letters go.

    Columns named like the model's are kept: all of a row's travel as one.
    """
    rows = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    found = language_id.identify(rows, language_id.fit(docs))
    kept = found.filter((F.col("lang_pred") != language_id.UNDECIDED) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked rows the one of least doc_id, nulls last; of equal texts under one doc_id, one.

    Where a doc_id is null or repeated, rows are numbered in the order of doc_id and linked by number, so that rows of
    different texts are judged each by its own. Null and empty texts link with nothing and stay.
    """
    if docs.groupBy("doc_id").count().filter("doc_id is null or count > 1").isEmpty():
        return without(docs, jaccard_join(docs).filter("doc_id <> component_id").select("doc_id"))
    order = F.col("doc_id").asc_nulls_last()
    with scratch(spark) as place:
        rows = docs.repartitionByRange(order, F.xxhash64("text")).sortWithinPartitions(order).withColumn("__row", F.monotonically_increasing_id())
        rows = place.table(rows, "rows")
        found = jaccard_join(rows.select(F.col("__row").alias("doc_id"), "text"))
        kept = without(rows, found.filter("doc_id <> component_id").select("doc_id"), "__row").drop("__row")
        return durable(kept.filter("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(kept.filter("doc_id is null")))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text holds no item of the benchmark; null and empty texts hold none and stay."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the secrets in its text masked, n_chars with it; null texts stay as they are."""
    masked = redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and token_ids of every document; its ids decode to its text."""
    found = pieces.encode_lists(docs.select("doc_id", "lang", "source", "text"))
    return found.select("doc_id", "lang", "source", F.size("token_ids").alias("n_tokens"), "token_ids")


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("secret_scan", mask_secrets),
    ("sentencepiece", encode_pieces),
]

#: Learned models, hashing and graph components aren't for SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents. The last one's table stays in the shared folder; others are removed."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
