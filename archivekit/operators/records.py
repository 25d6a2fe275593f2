"""Records and the streams they form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from archivekit.functions import names as N, streams as S

IDENTITY = ["net", "sta", "loc", "cha"]
RECORD_KEY = [*IDENTITY, "start_ts", "end_ts", "n_samples"]


def payload_digest() -> Column:
    """Tells apart the samples of records with one key; a missing payload has its own."""
    return F.xxhash64("payload")


def record_conflicts(records: DataFrame) -> DataFrame:
    """Keys under which records with different samples occur, and their source files."""
    return (
        records.groupBy(*RECORD_KEY, payload_digest().alias("_digest"))
        .agg(F.min("src_path").alias("src_path"))
        .groupBy(*RECORD_KEY)
        .agg(F.count(F.lit(1)).alias("versions"), F.sort_array(F.collect_list("src_path")).alias("sources"))
        .filter(F.col("versions") > 1)
    )


def dedup_records(
    records: DataFrame, compare_payload: bool = False, keys: Sequence[str] = RECORD_KEY
) -> DataFrame:
    """One copy of each repeated record: of a local file before a telemetered one, then
    the one with the smallest source path.

    Written as an aggregate so that copies are merged before the shuffle.
    `compare_payload=True` keeps records whose samples differ.
    """
    keys = list(keys)
    others = [c for c in records.columns if c not in keys]
    rows, by = records, list(keys)
    if compare_payload:
        rows = records.withColumn("_digest", payload_digest())
        by.append("_digest")
    if not others:
        return rows.select(*by).distinct().select(*keys)
    ordered = sorted(others, key=lambda c: c != "src_path")
    if "src_path" in others:
        spaced = F.coalesce(N.is_spaced(N.base_name(F.col("src_path"))), F.lit(True)).alias("_spaced")
        ordered = [spaced, *ordered]
    return (
        rows.groupBy(*by)
        .agg(F.min(F.struct(*ordered)).alias("_copy"))
        .select(*keys, *[F.col(f"_copy.{c}").alias(c) for c in others])
        .select(*records.columns)
    )


def sort_records(records: DataFrame) -> DataFrame:
    """Global order by stream, end and start, range-partitioned over the cluster."""
    order = [*IDENTITY, "end_ts", "start_ts", "n_samples"]
    return records.repartitionByRange(*order).sortWithinPartitions(*order)


def record_positions(records: DataFrame) -> DataFrame:
    """Position of each record in its stream's day, by end and start.

    Rows are ranked within their minute only; counts per minute (a window of a
    day's 1440 minutes) give each minute its offset.
    """
    rows = records.withColumns({
        "_day": F.col("start_ts").cast("date"), "_minute": F.date_trunc("minute", "end_ts"),
    })
    bucket = [*IDENTITY, "_day", "_minute"]
    before = Window.partitionBy(*IDENTITY, "_day").orderBy("_minute").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        rows.groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    in_minute = Window.partitionBy(*bucket).orderBy("end_ts", "start_ts", "n_samples")
    return (
        rows.withColumn("_rank", F.row_number().over(in_minute))
        .join(offsets, bucket)
        .withColumn("position", F.col("_offset") + F.col("_rank"))
        .drop("_day", "_minute", "_rank", "_offset")
    )


def distinct_streams(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return records.select(*by, *IDENTITY).distinct().withColumn("stream_id", S.stream_id())


def stream_inventory(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Time range, record and sample counts and rate of every stream."""
    return (
        records.groupBy(*by, *IDENTITY)
        .agg(
            F.min("start_ts").alias("start_ts"),
            F.max("end_ts").alias("end_ts"),
            F.count(F.lit(1)).alias("records"),
            F.sum("n_samples").alias("samples"),
            F.max("rate").alias("rate"),
        )
        .select(*by, S.stream_id().alias("stream_id"), "start_ts", "end_ts",
                "records", "samples", "rate")
    )


def inventory_summary(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals over the inventory; distinct counts run over streams, not records."""
    inventory = stream_inventory(records, by)
    sid = F.col("stream_id")
    return inventory.groupBy(*by).agg(
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.count_distinct(S.id_part(sid, 1)).alias("networks"),
        F.count_distinct(S.id_part(sid, 1), S.id_part(sid, 2)).alias("stations"),
        F.count(F.lit(1)).alias("streams"),
        F.sum("records").alias("records"),
        F.sum("samples").alias("samples"),
    )


def too_many_streams(
    records: DataFrame, by: Sequence[str] = ("station_dir", "day"), limit: int = 3
) -> DataFrame:
    """Groups with more than `limit` streams: accelerometers slipped in."""
    return (
        distinct_streams(records, by)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_streams"))
        .filter(F.col("n_streams") > limit)
    )
