"""Reports on the seconds stamps in file names.

The recorder writes continuous minutes at a constant second, so a day's files
share one or a few stamps, while triggered files scatter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from archivekit.functions import names as N
from archivekit.params import Params
from archivekit.operators.lookup import attach

DAY = ["station_dir", "day"]


def _source(source: str, literal: bool) -> tuple[Column, Column]:
    """(which files a report considers, the value it counts)."""
    name = F.col("name")
    if source == "underscored":
        return N.n_underscores(name) >= 3, N.stamp_underscored(name, literal)
    if source == "spaced_echo":
        return N.is_strict_spaced_echo(name), N.stamp_spaced(name, literal)
    if source == "spaced_gecko":
        return N.is_strict_spaced_gecko(name), N.stamp_spaced(name, literal)
    if source == "underscored_gecko":
        # These names hold no seconds; what varies is the station.
        third = N.stamp_underscored(name, literal=True)
        return N.is_underscored_gecko(name), third
    raise ValueError(f"unknown source: {source}")


def stamp_counts(files: DataFrame, source: str, literal: bool = False) -> DataFrame:
    considered, stamp = _source(source, literal)
    return (
        files.filter(considered)
        .groupBy(*DAY, stamp.alias("stamp"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def stamp_histogram(
    files: DataFrame, source: str = "underscored", literal: bool = False
) -> DataFrame:
    """Files per stamp, ranked from the commonest; ties put the larger stamp first.

    The window runs over counts: at most one row per two-digit stamp and day.
    """
    order = Window.partitionBy(*DAY).orderBy(F.desc("n"), F.desc_nulls_last("stamp"))
    return stamp_counts(files, source, literal).withColumn(
        "rank", F.row_number().over(order)
    )


def total_considered(files: DataFrame, source: str = "underscored") -> DataFrame:
    considered, _ = _source(source, False)
    return (
        files.groupBy(*DAY)
        .agg(F.count_if(considered).alias("n_considered"))
    )


def _mode(counts: DataFrame) -> DataFrame:
    return (
        counts.filter(F.col("stamp").isNotNull())
        .groupBy(*DAY)
        .agg(F.max(F.struct("n", "stamp")).alias("best"))
        .select(*DAY, F.col("best.stamp").alias("stamp"), F.col("best.n").alias("n"))
    )


def stamp_mode(files: DataFrame) -> DataFrame:
    """Commonest stamp among names with exactly three underscores."""
    exact = files.filter(N.n_underscores(F.col("name")) == 3)
    return _mode(stamp_counts(exact, "underscored"))


def stamp_diff(files: DataFrame) -> DataFrame:
    """How many three-underscore names share, or do not share, the commonest stamp."""
    exact = files.filter(N.n_underscores(F.col("name")) == 3)
    return (
        stamp_counts(exact, "underscored")
        .groupBy(*DAY)
        .agg(
            F.sum("n").alias("total"),
            F.max(
                F.when(F.col("stamp").isNotNull(), F.struct("n", "stamp"))
            ).alias("best"),
        )
        .select(
            *DAY,
            "total",
            F.col("best.stamp").alias("stamp"),
            F.coalesce("best.n", F.lit(0)).alias("matching"),
            (F.col("total") - F.coalesce("best.n", F.lit(0))).alias("not_matching"),
        )
    )


def day_modes(files: DataFrame) -> DataFrame:
    """Commonest stamp of local and of telemetered files, side by side per day."""
    name = F.col("name")
    known = files.filter(~F.rlike(name, F.lit(r"trig\.dmx|\.mseed")))
    kind = F.when(N.n_underscores(name) >= 3, "us").when(N.n_spaces(name) >= 3, "sp")
    stamp = F.when(N.n_underscores(name) >= 3, N.stamp_underscored(name)).otherwise(
        N.stamp_spaced(name)
    )
    counts = (
        known.withColumns({"kind": kind, "stamp": stamp})
        .filter(F.col("stamp").isNotNull() & F.col("kind").isNotNull())
        .groupBy(*DAY, "kind", "stamp")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = lambda k: F.max(F.when(F.col("kind") == k, F.struct("n", "stamp"))).alias(k)
    return counts.groupBy(*DAY).agg(best("us"), best("sp")).select(
        *DAY,
        F.col("us.stamp").alias("us_stamp"),
        F.col("us.n").alias("us_n"),
        F.col("sp.stamp").alias("sp_stamp"),
        F.col("sp.n").alias("sp_n"),
    )


def rare_stamp_files(files: DataFrame, params: Params = Params()) -> DataFrame:
    """Local files whose stamp is rare that day: triggered, though not named so."""
    name = F.col("name")
    stamped = files.filter(N.n_underscores(name) >= 3).withColumn(
        "stamp", N.stamp_underscored(name)
    )
    rare = stamp_counts(files, "underscored").filter(F.col("n") < params.stamp_min)
    return attach(stamped, rare, [*DAY, "stamp"], ["path"], params)
