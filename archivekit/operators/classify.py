"""What is in the archive: recorder family, folder level, station names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from archivekit.functions import names as N
from archivekit.params import Params

DAY = ["station_dir", "day"]

# What a listing may be called.
KNOWN_RECORDERS = ("echo", "gecko")


# --- recorder family -------------------------------------------------------

def count_by_family(files: DataFrame) -> DataFrame:
    """Files of each recorder family per station-day, triggered ones included."""
    name = F.col("name")
    return files.groupBy(*DAY).agg(
        F.count_if(N.has_extension(name, "echo")).alias("n_dmx"),
        F.count_if(N.has_extension(name, "gecko")).alias("n_ms"),
    ).withColumn("n_total", F.col("n_dmx") + F.col("n_ms"))


def decide_type(counts: DataFrame, params: Params = Params()) -> DataFrame:
    """Add `decided`: the family a day shows by itself, NULL if it does not."""
    dmx, ms = F.col("n_dmx"), F.col("n_ms")
    enough = F.col("n_total") >= params.min_files
    return counts.withColumn(
        "decided",
        F.when((ms == 0) & (dmx > 0), "echo")
        .when((dmx == 0) & (ms > 0), "gecko")
        .when(enough & (dmx > ms), "echo")
        .when(enough, "gecko"),
    )


def carry_type(
    days: DataFrame, params: Params = Params(), reset: str | None = None
) -> DataFrame:
    """Add `recorder`: undecided days take the station's last decided family.

    `reset="month"` starts afresh every month, `reset="day"` never looks back.
    """
    if reset == "day":
        carried = F.col("decided")
    else:
        # One row per station and calendar day: a window stays a few thousand rows.
        by = ["station_dir"] + ([F.trunc("day", "month")] if reset == "month" else [])
        history = Window.partitionBy(*by).orderBy("day").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        carried = F.last("decided", ignorenulls=True).over(history)
    return days.withColumn("recorder", F.coalesce(carried, F.lit(params.first_type)))


def recorder_type(
    files: DataFrame, params: Params = Params(), reset: str | None = None
) -> DataFrame:
    """Recorder family of each station-day."""
    return carry_type(decide_type(count_by_family(files), params), params, reset)


def is_known_recorder(days: DataFrame) -> DataFrame:
    return days.filter(F.col("recorder").isin(*KNOWN_RECORDERS))


# --- folder level ----------------------------------------------------------

def folder_shape(files: DataFrame, levels: int | None = None) -> DataFrame:
    """Per folder: data files directly inside, and kinds of subfolders.

    Files are first counted per folder, so only folders, not files, are repeated for the
    folders above them: up to the root, or `levels` of them with their own.
    """
    name = F.col("name")
    leaves = (
        files.groupBy(N.folder(F.col("path")).alias("leaf"))
        .agg(
            F.count_if(N.has_extension(name, "data")).alias("n_data"),
            F.count_if(N.has_extension(name, "archive")).alias("n_archive"),
        )
    )
    up = (
        leaves.withColumn("parts", F.split("leaf", "/"))
        .withColumn("up", F.explode(F.sequence(F.lit(0), F.size("parts") if levels is None else F.lit(levels - 1))))
        .filter(F.size("parts") > F.col("up") + 1)
        .select(
            F.concat_ws("/", F.slice("parts", F.lit(1), F.size("parts") - F.col("up"))).alias("folder"),
            F.get("parts", F.size("parts") - F.col("up")).alias("child"),
            "up", "n_data", "n_archive",
        )
    )
    # One row per (folder, child) before counting, so the last step is small.
    children = up.groupBy("folder", "child").agg(
        F.sum(F.when(F.col("up") == 0, F.col("n_data")).otherwise(0)).alias("n_data"),
        F.sum(F.when(F.col("up") == 0, F.col("n_archive")).otherwise(0)).alias("n_archive"),
        F.bool_or((F.col("up") == 1) & (F.col("n_data") > 0)).alias("child_has_data"),
    )
    return children.groupBy("folder").agg(
        F.sum("n_data").alias("n_data"),
        F.sum("n_archive").alias("n_archive"),
        F.bool_or("child_has_data").alias("child_has_data"),
        F.count("child").alias("n_subfolders"),
        F.count_if(F.rlike("child", F.lit(r"^\d{2}$"))).alias("n_two_digit"),
    )


def archive_level(files: DataFrame, mode: str = "content", levels: int | None = None) -> DataFrame:
    """DAY, MONTH, YEAR or UNKNOWN for every folder of the listing.

    `content` looks for data files one level down, `name` also at the folder's
    own and its parent's name, `count` only at the number of subfolders. Folders
    without any file below them do not appear in a listing.
    """
    shape = folder_shape(files, levels)
    two, subs = F.col("n_two_digit"), F.col("n_subfolders")
    folder = F.col("folder")
    if mode == "content":
        level = (
            F.when(F.col("n_data") > 0, "DAY")
            .when(F.col("child_has_data"), "MONTH")
            .when(subs > 0, "YEAR")
        )
    elif mode == "name":
        level = (
            F.when(F.col("n_archive") > 0, "DAY")
            .when(F.rlike(folder, F.lit(r"(^|/)\d{4}/(0[1-9]|1[0-2])$")), "MONTH")
            .when(two >= 28, "MONTH")
            .when((two <= 12) & (subs > 0), "YEAR")
        )
    elif mode == "count":
        level = (
            F.when(F.col("n_archive") > 0, "DAY")
            .when(two >= 28, "MONTH")
            .when((two > 0) & (two <= 12), "YEAR")
        )
    else:
        raise ValueError(f"unknown mode: {mode}")
    return shape.select("folder", F.coalesce(level, F.lit("UNKNOWN")).alias("level"))


# --- station names ---------------------------------------------------------

def _token_counts(files: DataFrame, params: Params) -> DataFrame:
    """Files per station-day and station token, for the day's own family.

    One pass counts files by the token each family would see in them and by
    extension; the family of the day comes out of the same counts.
    """
    name = F.col("name")

    def token(family: str):
        text = N.station_token(name, family)
        return F.when(
            ~F.rlike(name, F.lit(params.ignore(family))) & N.is_station_token(text), text
        )

    groups = files.groupBy(
        *DAY,
        token("echo").alias("echo_token"),
        token("gecko").alias("gecko_token"),
        N.family_of(name).alias("family"),
    ).agg(F.count(F.lit(1)).alias("n"))

    of = lambda family: F.sum(F.when(F.col("family") == family, F.col("n")).otherwise(0))
    counts = groups.groupBy(*DAY).agg(of("echo").alias("n_dmx"), of("gecko").alias("n_ms"))
    counts = counts.withColumn("n_total", F.col("n_dmx") + F.col("n_ms"))
    types = carry_type(decide_type(counts, params), params, reset="day")
    seen = F.when(F.col("recorder") == "echo", F.col("echo_token")).otherwise(F.col("gecko_token"))
    return (
        groups.join(types.select(*DAY, "recorder"), DAY)
        .withColumn("token", seen)
        .filter(F.col("token").isNotNull())
        .groupBy(*DAY, "token")
        .agg(F.sum("n").alias("n"))
    )


def _best(value: str) -> F.Column:
    """Most frequent value; on a tie the largest value wins."""
    return F.max(F.struct("n", value))


def majority_station(files: DataFrame, params: Params = Params()) -> DataFrame:
    """Station name carried by most data files of each station-day."""
    return (
        _token_counts(files, params)
        .groupBy(*DAY).agg(_best("token").alias("best"))
        .select(*DAY, F.col("best.token").alias("station"))
    )


def station_census(files: DataFrame, params: Params = Params()) -> DataFrame:
    """How uniform the station names of each station-day are."""
    return (
        _token_counts(files, params)
        .groupBy(*DAY)
        .agg(
            _best("token").alias("best"),
            F.sum("n").alias("n_files"),
            F.count(F.lit(1)).alias("n_names"),
        )
        .select(
            *DAY,
            F.col("best.token").alias("station"),
            F.col("best.n").alias("n_station"),
            "n_files",
            "n_names",
            (F.col("best.n") >= params.min_count).alias("count_ok"),
            (F.col("best.n").cast("double") / F.col("n_files")).alias("confidence"),
        )
    )


def station_errants(files: DataFrame, params: Params = Params()) -> DataFrame:
    """Station names other than the majority one, a row each, with counts."""
    counts = _token_counts(files, params)
    best = counts.groupBy(*DAY).agg(_best("token").alias("best"))
    return (
        counts.join(best, DAY)
        .filter(F.col("token") != F.col("best.token"))
        .select(*DAY, F.col("token").alias("errant"), "n")
    )


def resolve_station(files: DataFrame, params: Params = Params()) -> DataFrame:
    """Station of each day folder: folder name, else majority name, else UNKNOWN."""
    days = files.select(*DAY).distinct()
    good = F.rlike("station_dir", F.lit(r"^[A-Z0-9]{4,5}$"))
    return days.join(majority_station(files, params), DAY, "left").select(
        *DAY,
        F.coalesce(
            F.when(good, F.col("station_dir")), F.col("station"), F.lit("UNKNOWN")
        ).alias("station"),
    )


def errant_station(rows: DataFrame, station: str = "station") -> DataFrame:
    """Files or records whose own station differs from their folder's."""
    return rows.filter(F.col(station) != F.col("station_dir"))
