"""Records that can't be filed, with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from archivekit.operators.records import IDENTITY

#: Why a record can't be filed, as a reject says it.
NO_START, NO_END, BACKWARDS, NO_SAMPLES, NO_FOLDER = (
    "no start time", "no end time", "ends before it starts", "no sample count", "code that names no folder",
)


def reject_reason() -> Column:
    """The first reason that holds for a record, NULL for one that can be filed."""
    names = [F.contains(F.coalesce(F.col(c), F.lit("")), F.lit("/")) for c in IDENTITY]
    slashed = names[0] | names[1] | names[2] | names[3]
    return (
        F.when(F.col("start_ts").isNull(), NO_START)
        .when(F.col("end_ts").isNull(), NO_END)
        .when(F.col("end_ts") < F.col("start_ts"), BACKWARDS)
        .when(F.col("n_samples").isNull() | (F.col("n_samples") < 0), NO_SAMPLES)
        .when(slashed, NO_FOLDER)
    )


def rejected_days(rejects: DataFrame) -> DataFrame:
    """Rejects and their commonest reason per station-day."""
    counted = rejects.groupBy("station_dir", "day", "reason").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("station_dir", "day").agg(
        F.sum("n").alias("n_rejected"), F.max(F.struct("n", "reason")).alias("_most")
    ).select("station_dir", "day", "n_rejected", F.col("_most.reason").alias("reason"))
