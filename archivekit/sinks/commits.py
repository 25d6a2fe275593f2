"""Which of the files below an archive's root count.

Every write has a run name, which its records carry, and counts only from the moment its
commit record is there: a run that breaks leaves nothing behind that is read. A run may
replace station-days: what earlier runs filed from those days no longer counts.

Records without a run name come from archives written before commits were kept; they
count. Names order runs by their start. One run writes to an archive at a time.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from archivekit.functions import names as N
from archivekit.operators.lookup import attach_small
from archivekit.operators.workspace import exists
from archivekit.params import Params

DAY = ["station_dir", "day"]
#: Run names compared in place; more are joined.
LISTED_RUNS = 1000

_RUNS = "run string, committed_at timestamp"
_DAYS = "run string, station_dir string, day date"


def new_run() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _read(spark: SparkSession, root: str, kind: str, schema: str) -> DataFrame:
    path = f"{root}/_commits/{kind}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def publish(spark: SparkSession, root: str, run: str, replaced: DataFrame | None = None) -> None:
    """Make the records of `run` count. The one row written last is the commit."""
    if replaced is not None:
        replaced.select(F.lit(run).alias("run"), *DAY).write.mode("append").parquet(f"{root}/_commits/days")
    row = spark.range(0, 1, 1, 1).select(F.lit(run).alias("run"), F.current_timestamp().alias("committed_at"))
    row.write.mode("append").parquet(f"{root}/_commits/runs")


def committed_runs(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "runs", _RUNS).select("run").distinct()


def replaced_days(spark: SparkSession, root: str) -> DataFrame:
    """The last run that replaced each day, for the days that were replaced at all."""
    days = _read(spark, root, "days", _DAYS).join(committed_runs(spark, root), "run", "left_semi")
    return days.groupBy(*DAY).agg(F.max("run").alias("_by"))


def counting(rows: DataFrame, spark: SparkSession, root: str, params: Params = Params()) -> DataFrame:
    """Rows (with `run` and `src_path`) that are committed and not replaced.

    Days that were replaced are few beside the rows, and nothing is joined while there
    are none.
    """
    runs = committed_runs(spark, root)
    few = [r["run"] for r in runs.limit(LISTED_RUNS + 1).collect()]
    if len(few) <= LISTED_RUNS:
        rows = rows.filter(F.col("run").isNull() | F.col("run").isin(few))
    else:
        known = rows.filter(F.col("run").isNotNull())
        rows = rows.filter(F.col("run").isNull()).unionByName(attach_small(known, runs, ["run"], ["src_path"], params))
    replaced = replaced_days(spark, root)
    if not few or replaced.isEmpty():
        return rows
    kept = rows.columns
    keyed = N.with_path_keys(rows.withColumn("_path", F.col("src_path")), "_path")
    # The keys take names of their own: an archive may have columns like them.
    keyed = keyed.select(*kept, F.col("station_dir").alias("_station"), F.col("day").alias("_day"))
    facts = replaced.select(F.col("station_dir").alias("_station"), F.col("day").alias("_day"), "_by")
    found = attach_small(keyed, facts, ["_station", "_day"], ["src_path"], params, "left")
    return found.filter(F.col("_by").isNull() | (F.coalesce("run", F.lit("")) >= F.col("_by"))).select(*kept)
