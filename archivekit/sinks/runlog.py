"""Run log, run summary and failure reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from archivekit import schemas
from archivekit.operators.workspace import exists
from archivekit.params import Params


def write_run_log(runs: DataFrame, path: str) -> None:
    """Append one row per processed day."""
    lacking = [f for f in schemas.STORED_RUNS.fields if f.name not in runs.columns]
    runs = runs.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})
    runs.select(*schemas.STORED_RUNS.fieldNames()).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    if exists(spark, path):
        return spark.read.schema(schemas.STORED_RUNS).parquet(path)
    return spark.createDataFrame([], schemas.STORED_RUNS)


def run_lines(runs: DataFrame) -> DataFrame:
    """The run log as text: time, day, recorder, status."""
    return runs.select(
        "station",
        "day",
        F.concat_ws(
            " | ",
            F.date_format("run_ts", "yyyy-MM-dd'T'HH:mm:ssXXX"),
            F.col("day").cast("string"),
            F.coalesce("recorder", F.lit("-")),
            F.concat(F.lit("Status: "), F.col("status")),
        ).alias("line"),
    )


def day_lines(plan: DataFrame) -> DataFrame:
    """Each station-day's own log, told from its plan row; `error` tells of a failed day."""
    say = lambda text, *cols: F.format_string(text, *cols)
    lines = F.array(
        say("Station-day taken up: %s", F.col("day").cast("string")),
        say("Recorder family: %s", "recorder"),
        say("Selected files: %d", "n_selected"),
        say("Rename rules: %d", "n_rules"),
        say("Status: %s", "status"),
    )
    return plan.select(
        F.col("station_dir").alias("station"), "day", F.posexplode(lines).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no").cast("bigint"))


def write_day_lines(lines: DataFrame, path: str) -> None:
    if "run_ts" not in lines.columns:
        lines = lines.withColumn("run_ts", F.lit(None).cast("timestamp"))
    lines.select(*schemas.STORED_LINES.fieldNames()).write.mode("append").parquet(path)


def run_summary(runs: DataFrame) -> DataFrame:
    return runs.groupBy("station", "status").agg(F.count(F.lit(1)).alias("n_days"))


def last_lines(log_lines: DataFrame, params: Params = Params()) -> DataFrame:
    """Last lines of each station-day's log, of each run apart if the lines name it.

    The rank limit is applied within each input partition before the shuffle,
    so a long log never travels whole.
    """
    newest = Window.partitionBy(*_log_key(log_lines)).orderBy(F.desc("line_no"))
    return (
        log_lines.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= params.tail_lines)
        .drop("_rank")
    )


def crash_report(
    runs: DataFrame, log_lines: DataFrame, params: Params = Params()
) -> DataFrame:
    """Failed days with the last lines of their logs.

    A day whose streams yield no rename rule counts as failed. If both tables name their
    runs, a failure gets the lines of its own run.
    """
    key = [c for c in _log_key(log_lines) if c in runs.columns]
    failed = runs.filter(F.col("status").isin("FAILED", "NO_RULES")).select(
        *key, F.col("detail").alias("error")
    )
    return failed.join(last_lines(log_lines, params), key, "left")


def _log_key(log_lines: DataFrame) -> list[str]:
    return ["station", "day", *(["run_ts"] if "run_ts" in log_lines.columns else [])]
