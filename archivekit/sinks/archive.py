"""Write the chosen files and the filed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from archivekit import schemas
from archivekit.functions import names as N, streams as S
from archivekit.operators.filters import key_bitmaps, with_may_hold
from archivekit.operators.lookup import attach_small
from archivekit.operators.records import IDENTITY, RECORD_KEY, payload_digest
from archivekit.operators.rename import RenameRule, apply_wildcard_rename
from archivekit.operators.workspace import discard, exists, stage
from archivekit.params import Params
from archivekit.sinks import commits, keys as keys_of
from archivekit.sources.catalog import scan_sds

FILED_KEY = [*RECORD_KEY, "digest"]


def write_manifest(
    chosen: DataFrame, path: str, mode: str = "overwrite", years: Sequence[int] | None = None
) -> None:
    """Store the chosen files by station and year, days sorted inside.

    Appending leaves out files that the manifest already holds, so a run may repeat. It
    reads the manifest of `years` alone (by default the years of the files).
    """
    if mode == "append" and exists(chosen.sparkSession, path):
        held = read_manifest(chosen.sparkSession, path)
        if years is None:
            low, high = chosen.agg(F.min(F.year("day")), F.max(F.year("day"))).first()
            years = [] if low is None else range(low, high + 1)
        held = held.filter(F.col("year").isin(*years))
        chosen = chosen.join(held.select("path").distinct(), "path", "left_anti").select(*chosen.columns)
    (
        chosen.withColumn("year", F.year("day"))
        .hint("rebalance", F.col("station_dir"), F.col("year"))
        .sortWithinPartitions("station_dir", "year", "day", "name")
        .write.mode(mode).partitionBy("station_dir", "year").parquet(path)
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest with its partition columns under fixed types."""
    stored = spark.read.parquet(path).schema
    for field in stored.fields:
        if field.name == "station_dir":
            field.dataType = schemas.FILES["station_dir"].dataType
    return spark.read.schema(stored).parquet(path)


def assign_sds_day(records: DataFrame) -> DataFrame:
    """Year and day of year a record is filed under: those of its own start.

    Records past midnight therefore leave their folder's day.
    """
    return records.withColumns({"year": F.year("start_ts"), "doy": F.dayofyear("start_ts")})


def with_sds_path(records: DataFrame) -> DataFrame:
    keyed = assign_sds_day(records)
    return keyed.withColumn(
        "sds_path",
        S.sds_path(*[F.col(c) for c in ("year", "net", "sta", "loc", "cha", "doy")]),
    )


def sds_day_counts(records: DataFrame) -> DataFrame:
    """Records and samples of each day file."""
    return (
        assign_sds_day(records)
        .groupBy("year", *IDENTITY, "doy")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("n_samples").alias("samples"))
        .withColumn(
            "sds_path",
            S.sds_path(*[F.col(c) for c in ("year", "net", "sta", "loc", "cha", "doy")]),
        )
    )


def skip_present(rows: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose exact key is not present yet."""
    return rows.join(present.select(*keys).distinct(), list(keys), "left_anti")


def new_records(records: DataFrame, filed: DataFrame, keys: Sequence[str] = RECORD_KEY) -> DataFrame:
    """Records not filed yet, compared by full record key.

    The join key is exactly the key `dedup_records` shuffles by, so records
    coming from there are not shuffled again.
    """
    keys = list(keys)
    return records.join(filed.select(*keys), keys, "left_anti")


def with_identity(records: DataFrame) -> DataFrame:
    """No part of a stream's identity is NULL, and none that names a folder is blank.

    A NULL never equals itself, and a blank folder name is read back as NULL; such a
    record would be filed again at every run.
    """
    named = {
        c: F.when(F.trim(F.col(c)) != "", F.col(c)).otherwise(schemas.BLANK) for c in ("net", "sta", "cha")
    }
    return records.withColumns({**named, "loc": F.coalesce("loc", F.lit(""))})


def year_span(records: DataFrame) -> list[int]:
    """Years the records fall in; one row reaches the driver."""
    first, last = records.agg(
        F.min(F.year("start_ts")), F.max(F.year("start_ts"))
    ).first()
    return [] if first is None else list(range(first, last + 1))


def _filed_keys(
    spark: SparkSession, root: str, years: Sequence[int], stations: Sequence[str] | None,
    replaced: DataFrame | None, params: Params, key_table: str | None = None,
) -> DataFrame:
    """Keys of the records filed in these years, without those of days about to be replaced."""
    if key_table:
        filed = keys_of.filed_keys(spark, key_table, root, years)
    else:
        filed = scan_sds(spark, root, years, stations)
        # Payloads are read only where files of older archives have no digest.
        old = filed.filter(F.col("digest").isNull()).withColumn("digest", payload_digest())
        filed = filed.filter(F.col("digest").isNotNull()).drop("payload").unionByName(old.drop("payload"))
    if replaced is None:
        return filed.select(*FILED_KEY)
    keyed = N.with_path_keys(filed.select(*FILED_KEY, "src_path"), "src_path")
    facts = replaced.select("station_dir", "day", F.lit(True).alias("_replaced"))
    kept = attach_small(keyed, facts, ["station_dir", "day"], ["start_ts", "cha"], params, "left")
    return kept.filter("_replaced IS NULL").select(*FILED_KEY)


def _best_first() -> list[Column]:
    """Local copies first, then by source path."""
    return [F.coalesce(N.is_spaced(N.base_name(F.col("src_path"))), F.lit(True)), F.col("src_path")]


def fresh_records(
    records: DataFrame,
    filed: DataFrame,
    params: Params = Params(),
    staged: list[str] | None = None,
    keys: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """One copy of each record that is not among the `filed` keys, with its `digest`.

    Keys are compared without payloads: those that occur twice, or are filed under the
    same name, are contested. A bitmap of contested keys is probed while the payloads
    stream by; all other records pass, are neither shuffled nor sorted. Where records
    are filed under contested keys, digests are compared, again without payloads, and
    only records that are found to be wanted are brought together to leave one copy each.

    `keys` has the keys of the records, if they are at hand. `filed` comes in so many
    `buckets` of the record key, if any: the keys are then dealt alike, and the filed
    side stays where it lies. Tables written on the way are added to `staged`, to be
    discarded once the records are written.
    """
    own = (records if keys is None else keys).select(*RECORD_KEY)
    own = own.repartition(buckets, *RECORD_KEY) if buckets else own
    counted = own.groupBy(*RECORD_KEY).agg(F.count(F.lit(1)).alias("_n"))
    held = filed.groupBy(*RECORD_KEY).agg(F.collect_set("digest").alias("_held"))
    seen = Observation()
    state = counted.join(held, RECORD_KEY, "left").observe(
        seen, F.count(F.lit(1)).alias("keys"), F.count("_held").alias("held"),
        F.count_if(F.expr("_n > 1 OR _held IS NOT NULL")).alias("contested"),
    )
    contested = stage(state.filter("_n > 1 OR _held IS NOT NULL").select(*RECORD_KEY, "_held"), "contested", staged)
    seen = seen.get
    if not seen["contested"]:
        return records.withColumn("digest", payload_digest())
    bits, bitmaps = key_bitmaps(contested, RECORD_KEY, params)
    keyed = stage(bits, "bitmaps", staged), bitmaps
    marked = with_may_hold(records, keyed, RECORD_KEY, "_contested")
    suspects = marked.filter("_contested").drop("_contested").withColumn("digest", payload_digest())
    if seen["held"]:
        wanted = suspects.groupBy(*FILED_KEY).agg(F.min(F.struct(*_best_first())).alias("_best")).select(
            *FILED_KEY, F.coalesce(F.col("_best.src_path"), F.lit("")).alias("_path")
        )
        known = wanted.join(contested, RECORD_KEY, "left")
        wanted = known.filter("_held IS NULL OR NOT array_contains(_held, digest)").drop("_held")
        wanted = stage(wanted, "wanted", staged)
        if seen["contested"] == seen["keys"] and wanted.isEmpty():
            return records.limit(0).withColumn("digest", payload_digest())
        named = suspects.withColumn("_path", F.coalesce("src_path", F.lit("")))
        suspects = attach_small(named, wanted, [*FILED_KEY, "_path"], ["src_path"], params).drop("_path")
    first = Window.partitionBy(*FILED_KEY).orderBy(*_best_first(), "rate")
    once = suspects.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")
    if seen["contested"] == seen["keys"]:
        return once
    clean = marked.filter("NOT _contested").drop("_contested").withColumn("digest", payload_digest())
    return clean.unionByName(once)


def write_sds(
    records: DataFrame,
    root: str,
    years: Sequence[int] | None = None,
    folders: Sequence[str] = tuple(schemas.SDS_PARTITIONS),
    stations: Sequence[str] | None = None,
    replaced: DataFrame | None = None,
    params: Params = Params(),
    keys: DataFrame | None = None,
    key_table: str | None = None,
) -> None:
    """Make records unique, append those not filed yet and publish them.

    Records under one key with different samples are all filed (see
    `record_conflicts`); of equal ones the local copy's path is kept. `stations` limits
    the folders compared against, as `years` does. What earlier runs filed from the
    station-days in `replaced` stops counting as the new records start to. Until then
    nothing that is written is read; a write that breaks leaves the archive as it was.
    `keys` may hold the record keys of `records` as a stored table. With `key_table`, the
    name of a table of filed keys (`sinks.keys`), the comparison reads that table, bucket
    by bucket, instead of the archive's folders.

    `years` limits the folders compared against; by default it is read off the
    records. Rebalancing by day file gives few files per folder and splits a
    day file that holds too much. Millions of day folders are slow to list: a
    large archive may leave `doy` out of `folders`; files then share the folder
    of their channel and year, and `scan_sds` reads either layout.
    """
    spark = records.sparkSession
    run = commits.new_run()
    years = year_span(records) if years is None else list(years)
    staged: list[str] = []
    try:
        if years:
            if key_table:
                keys_of.open_keys(spark, key_table, root, params)
            filed = _filed_keys(spark, root, years, stations, replaced, params, key_table)
            keys = None if keys is None else with_identity(keys)
            buckets = params.key_buckets if key_table else None
            fresh = fresh_records(with_identity(records), filed, params, staged, keys, buckets)
            (
                assign_sds_day(fresh)
                .withColumn("run", F.lit(run))
                .select(*schemas.SDS.fieldNames())
                .hint("rebalance", *[F.col(c) for c in schemas.SDS_PARTITIONS])
                .sortWithinPartitions(*schemas.SDS_PARTITIONS, "loc", "end_ts", "start_ts")
                .write.mode("append").partitionBy(*folders).parquet(root)
            )
            if key_table and exists(spark, f"{root}/year=*"):
                keys_of.add_keys(spark, key_table, root, run, params)
    finally:
        discard(spark, staged)
    if years or replaced is not None:
        commits.publish(spark, root, run, replaced)


def rehome_archive(
    spark: SparkSession,
    source: str,
    target: str,
    rules: str | list[RenameRule],
    years: Sequence[int] | None = None,
    doy: int | None = None,
    folders: Sequence[str] = tuple(schemas.SDS_PARTITIONS),
    progress: str | None = None,
    step_days: int = 31,
    params: Params = Params(),
) -> None:
    """Copy a filed archive, made unique and renamed, into another one.

    With `progress`, days are copied in steps of `step_days`, and each day is logged
    there with its source and target counts once its step is published. A copy that
    stopped goes on with the days that are not logged, or whose source has grown.
    """
    filed = scan_sds(spark, source, years)
    if doy is not None:
        filed = filed.filter(F.col("doy") == doy)
    if progress is None:
        records = filed.select(*schemas.RECORDS.fieldNames())
        write_sds(apply_wildcard_rename(records, rules), target, years, folders, params=params)
        return
    counts = filed.groupBy("year", "doy").agg(F.count(F.lit(1)).alias("n_in"))
    due = counts.join(read_progress(spark, progress), ["year", "doy", "n_in"], "left_anti")
    # One row per calendar day of the archive.
    days = [(r["year"], r["doy"]) for r in due.select("year", "doy").orderBy("year", "doy").collect()]
    number = F.col("year") * 1000 + F.col("doy")
    for at in range(0, len(days), step_days):
        step = days[at : at + step_days]
        numbers, step_years = [y * 1000 + d for y, d in step], sorted({y for y, _ in step})
        records = scan_sds(spark, source, step_years).filter(number.isin(numbers)).select(*schemas.RECORDS.fieldNames())
        write_sds(apply_wildcard_rename(records, rules), target, step_years, folders, params=params)
        of_day = scan_sds(spark, target, step_years).filter(number.isin(numbers)).groupBy("year", "doy")
        written = of_day.agg(F.count(F.lit(1)).alias("n_out"))
        done = counts.filter(number.isin(numbers)).join(written, ["year", "doy"], "left")
        done.select(
            "year", "doy", "n_in", F.coalesce("n_out", F.lit(0)).cast("bigint").alias("n_out"),
            F.current_timestamp().alias("copied_at"),
        ).repartition(1).write.mode("append").parquet(progress)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Days copied so far, each with the counts of its last copy."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.PROGRESS)
    log = spark.read.schema(schemas.PROGRESS).parquet(path)
    last = F.max_by(F.struct("n_in", "n_out"), "copied_at").alias("n")
    return log.groupBy("year", "doy").agg(last, F.max("copied_at").alias("copied_at")).select(
        "year", "doy", "n.n_in", "n.n_out", "copied_at")
