"""A corpus pipeline of five stages, each an operator of ``tellerlake.llm``.

Every stage takes the whole of what its predecessor kept and returns the
columns of documents, the last one the tokens; each result is written to the
shared folder and read again, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm import bpe, decontaminate, mil, queries, secret_scan, simhash
from tellerlake.sources.workspace import new_dir

#: Texts travel to Python workers in batches of this size, so that what a worker and
#: its executor hold beside the heap stays small however long the texts are.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def small_batches(stage):
    """The stage, planned with BATCHES."""

    @wraps(stage)
    def planned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return planned


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, fitted to the labelled ones among them, rejects."""
    labels = queries.table(spark, sf_dir, "labels").where(queries.fold("doc_id", 4) != 2)
    scored = mil.score(docs, mil.train(docs, labels), out="__quality")
    return scored.where(F.col("__quality") >= queries.QUALITY_CUT).drop("__quality")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with too much benchmark text."""
    return decontaminate.drop_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes secrets out of the texts; no document goes."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The byte-pair tokens of each text, as digests."""
    encoded = bpe.encode(docs, queries.word_vocabulary(), finish=queries.bpe_digest, fields=queries.BPE_FIELDS)
    return encoded.select("doc_id", "bpe.*")


STAGES = [
    ("quality classifier", small_batches(quality)),
    ("SimHash near-dedup", small_batches(near_duplicates)),
    ("benchmark decontamination", small_batches(decontamination)),
    ("secret scans", small_batches(secrets)),
    ("BPE encoding and decoding", small_batches(tokens)),
]

#: The classifier, the fingerprints and the tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_dir(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
