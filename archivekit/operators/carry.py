"""Carried recorder families without the whole history: summaries of periods.

What a later day needs to know of a period is the last family decided in it, if any.
Summaries join (of two neighbours the later decided one counts), so a scan over the few
periods of a station gives each period what comes in, and a run reads its own days and
the summaries before them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from archivekit.operators.classify import count_by_family, decide_type
from archivekit.operators.workspace import exists
from archivekit.params import Params

SUMMARY = "station_dir string, period date, first_day date, last_day date, decided string, stored_at timestamp"


def period_summaries(days: DataFrame, period: str = "month") -> DataFrame:
    """First and last day and last decided family of each station and period.

    `days` as from `decide_type`.
    """
    decided = F.max_by("decided", F.when(F.col("decided").isNotNull(), F.col("day")))
    return days.groupBy("station_dir", F.trunc("day", period).alias("period")).agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), decided.alias("decided")
    )


def write_carry(files: DataFrame, path: str, params: Params = Params(), period: str = "month") -> None:
    """Store summaries of the listing's periods; those of a period stored again replace it.

    To be run for whole periods, whenever their listing is stored or gets late files.
    """
    days = decide_type(count_by_family(files), params)
    summary = period_summaries(days, period).withColumn("stored_at", F.current_timestamp())
    summary.repartition(1).write.mode("append").parquet(path)


def read_carry(spark: SparkSession, path: str) -> DataFrame:
    """The summary stored last for each station and period."""
    stored = spark.read.schema(SUMMARY).parquet(path) if exists(spark, path) else spark.createDataFrame([], SUMMARY)
    last = F.max_by(F.struct("first_day", "last_day", "decided"), "stored_at").alias("s")
    return stored.groupBy("station_dir", "period").agg(last).select("station_dir", "period", "s.*")


def carried_into(summaries: DataFrame) -> DataFrame:
    """The family each station brings into each of its periods."""
    before = Window.partitionBy("station_dir").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    return summaries.select("station_dir", "period", F.last("decided", ignorenulls=True).over(before).alias("carried"))


def carried_before(summaries: DataFrame, day) -> DataFrame:
    """The family each station brings to `day`, the first of a period."""
    decided = summaries.filter((F.col("period") < F.lit(day).cast("date")) & F.col("decided").isNotNull())
    return decided.groupBy("station_dir").agg(F.max_by("decided", "period").alias("carried"))


def recorder_type_stored(
    files: DataFrame, summaries: DataFrame, start, params: Params = Params(), period: str = "month"
) -> DataFrame:
    """As `recorder_type` from `start` on, from the periods that hold those days and summaries of earlier ones."""
    first = F.trunc(F.lit(start).cast("date"), period)
    mine = files.filter(F.col("day") >= first)
    if "year" in files.columns:
        mine = mine.filter(F.col("year") >= F.year(first))
    days = decide_type(count_by_family(mine), params)
    return carry_on(days, carried_before(summaries, first), params).filter(F.col("day") >= F.lit(start).cast("date"))


def carry_on(days: DataFrame, carried: DataFrame, params: Params = Params()) -> DataFrame:
    """Add `recorder` to decided days, going on from what each station brings along."""
    history = Window.partitionBy("station_dir").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last("decided", ignorenulls=True).over(history)
    joined = days.join(carried, "station_dir", "left")
    return joined.withColumn("recorder", F.coalesce(last, F.col("carried"), F.lit(params.first_type))).drop("carried")
