"""List the archive once and keep the listing as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from archivekit import schemas
from archivekit.functions import names as N
from archivekit.operators.workspace import exists, stage
from archivekit.sinks import commits


def scan_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Regular files below `root`. Contents are never read: the scan prunes them.

    Spark's listing passes through the driver and leaves out empty files and
    names starting with `_` or `.`. It suits a station-year; `scan_day_folders`
    lists any number of days inside tasks.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(
        "path", "length", F.col("modificationTime").alias("modified")
    )


def scan_day_folders(
    spark: SparkSession, root: str, stations: Sequence[str], start: str, end: str
) -> DataFrame:
    """Files of the day folders of `stations` from `start` to `end`, listed in tasks.

    One row per possible month is spread over the cluster and each task lists its own
    months, so names never pass through the driver. Folders of months and days may have
    one digit or two. Folders that do not exist give no rows.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    months = F.sequence(F.trunc(first, "month"), last, F.expr("interval 1 month"))
    folders = (
        spark.createDataFrame([(s,) for s in stations], "station string")
        .select("station", F.explode(months).alias("month"))
        .select(
            F.concat_ws("/", "station", F.lit("continuous"), F.date_format("month", "yyyy")).alias("folder"),
            F.month("month").alias("month"),
            F.when(F.trunc(first, "month") == F.col("month"), F.dayofmonth(first)).otherwise(1).alias("low"),
            F.when(F.trunc(last, "month") == F.col("month"), F.dayofmonth(last)).otherwise(31).alias("high"),
        )
    )
    # A fixed number of tasks: so little data would be merged into one otherwise.
    tasks = spark.sparkContext.defaultParallelism * 4

    def list_folders(batches):
        import pandas as pd
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)

        def entries(folder, kind):
            found = store.get_file_info(fs.FileSelector(f"{base}/{folder}", allow_not_found=True))
            return [i for i in found if i.type == kind]

        def numbered(folder, low, high):
            return [
                f"{folder}/{i.base_name}" for i in entries(folder, fs.FileType.Directory)
                if i.base_name.isdecimal() and len(i.base_name) <= 2 and low <= int(i.base_name) <= high
            ]

        for batch in batches:
            days = [
                day for row in batch.itertuples()
                for month in numbered(row.folder, row.month, row.month)
                for day in numbered(month, row.low, row.high)
            ]
            for folder in days:
                files = entries(folder, fs.FileType.File)
                yield pd.DataFrame({
                    "path": [f"{root}/{folder}/{i.base_name}" for i in files],
                    "length": [i.size for i in files],
                    "modified": pd.to_datetime([i.mtime for i in files], utc=True),
                }).astype({"path": "object", "length": "int64"})

    return folders.repartition(tasks, "folder", "month").mapInPandas(
        list_folders, "path string, length bigint, modified timestamp"
    )


def walk_folders(spark: SparkSession, root: str, levels: int = 32) -> DataFrame:
    """Every file below `root`, whatever the folders between are called.

    Folders are rows: each level of them is listed in tasks and gives the files found
    and the next level's folders, so neither stations nor depth need be known and no
    name passes through the driver. Empty files and names that start with `_` or `.` are
    listed too. A tree deeper than `levels` is an error: links may run in circles.
    `catalog` of the result are the files that lie in day folders.
    """
    tasks = spark.sparkContext.defaultParallelism * 4

    def list_level(batches):
        import pandas as pd
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for folder in batch["folder"]:
                found = store.get_file_info(fs.FileSelector(f"{base}/{folder}" if folder else base))
                names = [f"{folder}/{i.base_name}" if folder else i.base_name for i in found]
                is_file = [i.type == fs.FileType.File for i in found]
                yield pd.DataFrame({
                    "folder": [None if f else n for f, n in zip(is_file, names)],
                    "path": [f"{root}/{n}" if f else None for f, n in zip(is_file, names)],
                    "length": [i.size if f else 0 for f, i in zip(is_file, found)],
                    "modified": pd.to_datetime([i.mtime for i in found], utc=True),
                }).astype({"folder": "object", "path": "object", "length": "int64"})

    level = spark.range(1).select(F.lit("").alias("folder"))
    out = None
    for _ in range(levels):
        spread = level.repartition(tasks, "folder")
        seen = stage(spread.mapInPandas(list_level, "folder string, path string, length bigint, modified timestamp"), "walk")
        files = seen.filter("path IS NOT NULL").select("path", "length", "modified")
        out = files if out is None else out.unionByName(files)
        level = seen.filter("folder IS NOT NULL").select("folder")
        if level.isEmpty():
            return out
    raise ValueError(f"more than {levels} levels of folders below {root}")


def catalog(listing: DataFrame) -> DataFrame:
    """Files inside day folders, with name, station folder and day."""
    return N.with_path_keys(listing).filter(F.col("day").isNotNull())


def write_catalog(files: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store the listing by station and year, so later jobs prune by folder."""
    keyed = files.withColumn("year", F.year("day"))
    (
        keyed.select(*schemas.FILES.fieldNames())
        .hint("rebalance", F.col("station_dir"), F.col("year"))
        .sortWithinPartitions("station_dir", "year", "day", "name")
        .write.mode(mode).partitionBy("station_dir", "year").parquet(path)
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FILES).parquet(path)


def between_days(files: DataFrame, start=None, end=None) -> DataFrame:
    """Days from `start` to `end` inclusive; a year, month or single day root."""
    out = files
    if start is not None:
        out = out.filter(F.col("day") >= F.lit(start).cast("date"))
        if "year" in files.columns:
            out = out.filter(F.col("year") >= F.year(F.lit(start).cast("date")))
    if end is not None:
        out = out.filter(F.col("day") <= F.lit(end).cast("date"))
        if "year" in files.columns:
            out = out.filter(F.col("year") <= F.year(F.lit(end).cast("date")))
    return out


def day_folders(files: DataFrame, start=None, end=None) -> DataFrame:
    """Day folders holding files, as rows."""
    return between_days(files, start, end).select("station_dir", "day").distinct()


def write_records(records: DataFrame, path: str, mode: str = "append") -> None:
    """Store decoded records by station folder and year of their source file.

    A run over a few days or stations then reads their folders alone, and in these the
    row groups that hold its days.
    """
    keyed = N.with_path_keys(records, "src_path").withColumn("year", F.year("day"))
    (
        keyed.select(*schemas.RECORDS.fieldNames(), "station_dir", "year", "day")
        .hint("rebalance", F.col("station_dir"), F.col("year"))
        .sortWithinPartitions("station_dir", "year", "day")
        .write.mode(mode).partitionBy("station_dir", "year").parquet(path)
    )


def read_records(spark: SparkSession, path: str, partitioned: bool = False) -> DataFrame:
    """Record table: one row per record, under a fixed schema.

    `partitioned` tables are those of `write_records`; they also have `station_dir`,
    `year` and `day`, by which `run_archive` prunes.
    """
    schema = schemas.STORED_RECORDS if partitioned else schemas.RECORDS
    return spark.read.schema(schema).parquet(path)


def scan_sds(
    spark: SparkSession,
    root: str,
    years: Sequence[int] | None = None,
    stations: Sequence[str] | None = None,
) -> DataFrame:
    """Filed records that count (see `sinks.commits`).

    Years and stations narrow the folders that are listed at all.
    """
    alternatives = lambda values: "*" if values is None else "{%s}" % ",".join(map(str, values))
    where = root
    if years is not None or stations is not None:
        where = f"{root}/year={alternatives(years)}/net=*/sta={alternatives(stations)}"
    if not exists(spark, where):
        return spark.createDataFrame([], schemas.SDS)
    stored = spark.read.schema(schemas.SDS).option("basePath", root).parquet(where)
    return commits.counting(stored, spark, root)


def filed_days(sds: DataFrame) -> DataFrame:
    """Station-days present in the archive; needs partition columns only."""
    return sds.select("net", "sta", "year", "doy").distinct()
