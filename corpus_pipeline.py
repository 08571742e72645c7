"""A corpus pipeline of five stages, each of which takes the documents that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arraymetrics.llm import bpe, decontaminate, jaccard, langid, linededup
from arraymetrics.llm.common import in_fold, stored

#: Texts whose best language knows less than this share of their n-grams are rejected, where there are langid.ENOUGH of them.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in a language that the labelled ones teach; texts without letters, or in none of these, go. A row stays or
    goes by its text alone, so rows that share an id are judged apart."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = langid.fit(src.where(in_fold(F.col("doc_id"), 5, 0)))
    return langid.keep(docs, model, LEAST_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out lines that an earlier place also has, or nearly has; the edits allowed grow with the line."""
    return linededup.deduplicate(docs, None, linededup.LEAST_CHARS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return jaccard.one_of_each(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least=1)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left; decoding is checked on the way."""
    return bpe.encode_decode(docs, digest=True)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmarks", benchmarks), ("tokens", tokens)]

#: The stages learn, hash and tokenize; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
