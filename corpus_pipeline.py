"""Corpus pipeline: language ID, quality, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame over all that its
predecessor kept. The first four return the columns of documents; packing
returns one row per piece. ``run`` writes every stage as Parquet in the shared
folder named by spark.checkpoint.dir and reads it again, so a lost executor
never recomputes an earlier stage.

Defined cases follow the operators; columns of ``docs`` other than those of
documents are dropped by the first stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.llm import langid, mixing, packing, quality, superminhash
from veracity.llm.queries import TOKENIZER
from veracity.llm.shared import WORD, table
from veracity.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned: those whose mean log-probability an n-gram lies within the spread of the
    training documents of the language predicted."""
    own = docs.select(*COLUMNS)
    model = langid.fit(own)
    return langid.predict(own, model, COLUMNS, langid.spread(own, model)).filter("known").select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the best grade is 0.5 or more."""
    own = docs.select(*COLUMNS)
    model = quality.fit(own, table(spark, sf_dir, "labels"))
    return quality.score(own, model, COLUMNS).filter("kept").select(*COLUMNS)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more).

    A document is a pair of id and text, known by their hash; the smallest hash of a group stays. Different texts under
    one id are judged one by one; of rows that repeat both id and text one stays. Texts without a word stay, but for
    rows that repeat such a text under one id.
    """
    own = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("_key"))
    groups = superminhash.near_duplicates(own.select(F.col("_key").alias("doc_id"), "text"), k=5, percent=80)
    left = own.join(groups.filter("NOT kept").select(F.col("doc_id").alias("_key")).distinct(), "_key", "left_anti")
    twice = (left.filter(F.col("doc_id").isNotNull() | F.coalesce("text", F.lit("")).rlike(WORD))
             .groupBy("_key", "doc_id", F.crc32("text")).count().filter("count > 1").select("_key"))
    if twice.isEmpty():
        return left.drop("_key")
    # equal rows meet in a partial aggregate, however many there are
    row = F.struct(F.col("doc_id"), "text", "lang", "source", "n_chars")
    again = left.join(twice, "_key", "left_semi").groupBy("_key").agg(F.min(row).alias("row")).select("row.*").select(*COLUMNS)
    return left.join(twice, "_key", "left_anti").select(*COLUMNS).union(again)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mixing.mix(docs.select(*COLUMNS), keep=COLUMNS)
    return (mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", language_stage),
    ("quality", quality_stage),
    ("near_duplicates", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Fitted models, shingle sets and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
