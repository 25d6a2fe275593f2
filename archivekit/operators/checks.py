"""What a run notices about the station-days it files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from archivekit.operators.classify import errant_station, station_errants
from archivekit.operators.records import too_many_streams
from archivekit.params import Params

DAY = ["station_dir", "day"]
# Kinds of findings.
ERRANT_NAME, ERRANT_RECORD, MANY_STREAMS = "errant_name", "errant_record", "too_many_streams"


def day_checks(files: DataFrame, chosen: DataFrame, renamed: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per finding: station_dir, day, finding, item, n.

    File names that carry another station than most names of their day (item: that
    station, n: files), chosen records of another station than their folder's (item: that
    station, n: records), and days that file more than three streams (n: streams). Each is
    an aggregate over names and identities; payloads are not read.
    """
    named = station_errants(files, params).select(
        *DAY, F.lit(ERRANT_NAME).alias("finding"), F.col("errant").alias("item"), "n")
    strays = errant_station(chosen, "sta").groupBy(*DAY, "sta").agg(F.count(F.lit(1)).alias("n")).select(
        *DAY, F.lit(ERRANT_RECORD).alias("finding"), F.col("sta").alias("item"), "n")
    many = too_many_streams(renamed, DAY).select(
        *DAY, F.lit(MANY_STREAMS).alias("finding"), F.lit("").alias("item"), F.col("n_streams").alias("n"))
    return named.union(strays).union(many)
