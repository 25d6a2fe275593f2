"""Which station-days changed since they were filed: late, grown or vanished files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DAY = ["station_dir", "day"]


def fingerprint(files: DataFrame) -> list[Column]:
    """Aggregates that tell one set of files from another: `n_files` and `fingerprint`.

    The sum of 64-bit hashes of name, length and time needs no order and no second pass,
    and partial sums meet in any number of tasks.
    """
    parts = [c for c in ("name", "length", "modified") if c in files.columns]
    return [
        F.count(F.lit(1)).alias("n_files"),
        F.sum(F.xxhash64(*parts).cast("decimal(20,0)")).cast("decimal(38,0)").alias("fingerprint"),
    ]


def day_fingerprints(files: DataFrame) -> DataFrame:
    return files.groupBy(*DAY).agg(*fingerprint(files))


def last_filed(runs: DataFrame) -> DataFrame:
    """What the last successful run of each station-day saw, from the run log."""
    seen = F.max_by(F.struct("n_files", "fingerprint", "recorder"), "run_ts").alias("_seen")
    return (
        runs.filter(F.col("status") == "OK")
        .groupBy(F.col("station").alias("station_dir"), "day").agg(seen)
        .select(*DAY, F.lit(True).alias("_filed"), F.col("_seen.n_files").alias("n_before"),
                F.col("_seen.fingerprint").alias("_before"), F.col("_seen.recorder").alias("_recorder"))
    )


def days_changed(days: DataFrame, runs: DataFrame) -> DataFrame:
    """`days` (with n_files and fingerprint) against the run log: adds `n_before` and `change`.

    `new`: never filed; `changed`: the files are not those it was filed from, or (where
    `days` tells) the recorder family is another, as carried from earlier days; `same`:
    all others, also where the log is older than fingerprints.
    """
    unlike = F.col("_before") != F.col("fingerprint")
    if "recorder" in days.columns:
        unlike = unlike | (F.col("_recorder") != F.col("recorder"))
    unlike = F.col("_before").isNotNull() & F.coalesce(unlike, F.lit(False))
    return (
        days.join(last_filed(runs), DAY, "left")
        .withColumn("change", F.when(F.col("_filed").isNull(), "new").when(unlike, "changed").otherwise("same"))
        .drop("_filed", "_before", "_recorder")
    )
