"""The corpus pipeline: toxicity, near duplicates, benchmark passages, secrets, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages it is written as Parquet and read again.
All but the last return the columns of documents. Every stage reads whole texts, however long, keeps rows with nulls in any
column unless its decision says otherwise, and makes an empty table of an empty one; further columns of any name are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import decontam, jaccard, mixing, secrets, toxicity
from tidings.llm.labelled import held_out
from tidings.session import shared_dir

#: Toxicity, pruned candidates and alignments can't be said in SQL; the tests compare with brute force instead.
ORACLE_SQL = None


#: Rows that a stage passes to Python at a time: whole texts can be long, and an executor's workers share its memory.
TEXTS_AT_A_TIME = 500


def _whole_texts(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_AT_A_TIME))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's threshold. Rows whose id hashes to 0 of 5 teach nothing, as in query op1.

    Null and empty texts get the score of no evidence; a null language uses the general threshold; equal texts share a verdict.
    """
    _whole_texts(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, ~held_out(F.col("doc_id"), 5, 0))
    scored = toxicity.score_toxicity(docs, model)
    return scored.where("toxic_verdict = 0").select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of least id (null last); of fully equal rows one.

    Null texts and texts without a word are all kept.
    """
    _whole_texts(spark)
    return jaccard.keep_one(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found: null, empty and very short texts are kept, equal rows share a verdict."""
    _whole_texts(spark)
    found = decontam.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("leaks") == 0).select(*docs.columns)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret, and their new length (null for a null text); no row goes."""
    _whole_texts(spark)
    return secrets.redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: `copy` counts from 1.

    Texts without words take no room in the mix, and come along as their place decides; equal rows are taken equally often.
    """
    mixed = mixing.mix_sources(docs).where("mix_copies > 0")
    return mixed.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("copy"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("near_duplicates", keep_one_of_each_group), ("benchmark", drop_benchmark_passages), ("secrets", remove_secrets), ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What lies between is written below the folder that the cluster shares."""
    at = shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
