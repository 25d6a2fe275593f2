"""The corpus pipeline: filter, deduplicate, decontaminate and tokenise `documents`.

Each stage is a function of (spark, docs, sf_dir) that works on all its predecessor
kept; its result is written as Parquet and read again for the next one. All but the last
return the columns of their input.

1. toxicity: documents that the model rejects go.
2. minhash_near_dedup: of documents whose sets of five-word shingles are alike by 0.8 or
   more, directly or over others, the one with the smallest doc_id stays.
3. benchmark_decontamination: documents that hold a benchmark item, with at most a fifth
   of its words edited, go.
4. byte_level_bpe: the rest is encoded; a row per document with its token count and the
   digests of its ids and of the bytes decoded from them.

Texts of any length are taken whole. Null and empty texts are kept by the filters (they
have no toxic term, no shingle and no item) and have no tokens. Rows without doc_id are
kept by stage 2; of rows that share a doc_id the one with the least text stays, nulls
first. Ties go to the smallest doc_id. Empty tables give empty results, and extra
columns of `documents`, whatever they are called, pass through to stage 3.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivekit.llm import decontaminate, neardup, queries, toxicity
from archivekit.llm.text import bound_batches
from archivekit.operators.workspace import stage as written

#: Documents of this score or more are rejected.
REJECTED = 0.7
#: Ids of dropped documents that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    """The stage in batches of bounded bytes, whether `run` calls it or it is called alone."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@bounded
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score stays below `REJECTED`; repeated rows share their fate."""
    score = toxicity.score_column(docs, queries.table(spark, sf_dir, "labels"))
    return docs.filter(score < REJECTED)


@bounded
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, as a single row."""
    found = neardup.near_duplicates(docs.select("doc_id", "text"), size=5, percent=80)
    gone = written(found.filter("NOT kept").select("doc_id").distinct(), "gone")
    few = gone.count() <= BROADCAST_IDS
    left = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    # Rows that repeat a doc_id are one document.
    repeated = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = written(repeated, "repeated")
    if repeated.isEmpty():
        return left
    # The same row in every attempt of a task; the rank is cut before the shuffle.
    first = Window.partitionBy("doc_id").orderBy(F.asc_nulls_first("text"), F.xxhash64(*docs.columns))
    once = left.join(repeated, "doc_id", "left_semi").withColumn("__place", F.row_number().over(first))
    once = once.filter("__place = 1").drop("__place")
    return left.join(repeated, "doc_id", "left_anti").unionByName(once).select(*docs.columns)


@bounded
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


@bounded
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of each row; repeated rows give repeated results."""
    return queries.bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("byte_level_bpe", encode),
]

#: SQL can't express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`, each written before the next one reads it."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = written(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
