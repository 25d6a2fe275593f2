"""Choose the files of each station-day that go into the archive.

Decisions are taken on aggregates with a few rows per station-day and joined back
to the files; files are never gathered per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from archivekit.functions import minutes as M
from archivekit.functions import names as N
from archivekit.operators.lookup import attach
from archivekit.operators.stamps import stamp_counts
from archivekit.params import Params

DAY = ["station_dir", "day"]
SIDE = [*DAY, "kind"]


# --- candidates ------------------------------------------------------------

def with_extensions(files: DataFrame, family: str) -> DataFrame:
    return files.filter(N.has_extension(F.col("name"), family))


def drop_ignored(files: DataFrame, pattern: str) -> DataFrame:
    """Drop names matching `pattern`, tested on the base name only."""
    return files.filter(~F.rlike("name", F.lit(pattern)))


def valid_files(files: DataFrame, family: str, params: Params = Params()) -> DataFrame:
    return drop_ignored(with_extensions(files, family), params.ignore(family))


def select_all_valid(files: DataFrame, params: Params = Params()) -> DataFrame:
    """Every uncompressed dmx file that is not ignored."""
    return drop_ignored(with_extensions(files, "dmx"), params.ignore_echo)


def _styled(files: DataFrame) -> DataFrame:
    return files.withColumn("style", N.style(F.col("name")))


def count_by_style(files: DataFrame) -> DataFrame:
    """Local, telemetered and all files per station-day."""
    s = N.style(F.col("name"))
    return files.groupBy(*DAY).agg(
        F.count_if(s == "underscored").alias("n_underscored"),
        F.count_if(s == "spaced").alias("n_spaced"),
        F.count(F.lit(1)).alias("n_files"),
    )


def day_completeness(files: DataFrame, params: Params = Params()) -> DataFrame:
    """How much of each day the local and telemetered files cover."""
    full = float(params.expected)
    return count_by_style(files).select(
        *DAY,
        "n_underscored",
        "n_spaced",
        "n_files",
        (F.lit(params.expected) - F.col("n_underscored")).alias("missing"),
        (F.col("n_underscored") / F.lit(full)).alias("share_underscored"),
        (F.col("n_spaced") / F.lit(full)).alias("share_spaced"),
        (F.col("n_underscored") >= params.near_complete).alias("near_complete"),
    )


# --- whole-day rules -------------------------------------------------------

def near_complete_rule(us: Column, sp: Column, params: Params) -> Column:
    """Which style a day keeps, from its local and telemetered counts."""
    return (
        F.when((us > 0) & (sp > 0) & (us < params.near_complete), "all")
        .when(us > 0, "underscored")
        .when(sp > 0, "spaced")
    )


def select_near_complete(
    files: DataFrame, family: str, params: Params = Params()
) -> DataFrame:
    """Local files alone where the day is nearly complete, else all files.

    Names of neither style survive only on days that hold both styles and are
    not nearly complete.
    """
    valid = valid_files(files, family, params)
    keep = near_complete_rule(F.col("n_underscored"), F.col("n_spaced"), params)
    days = count_by_style(valid).select(*DAY, keep.alias("keep")).filter("keep is not null")
    return (
        attach(_styled(valid), days, DAY, ["path"], params)
        .filter((F.col("keep") == "all") | (F.col("keep") == F.col("style")))
        .drop("keep")
    )


def select_near_complete_v0(files: DataFrame, params: Params = Params()) -> DataFrame:
    """Earlier rule: dmx only, any `_` makes a name local, no look at the other style."""
    valid = select_all_valid(files, params)
    local = F.contains("name", F.lit("_"))
    days = valid.groupBy(*DAY).agg(
        (F.count_if(local) >= params.near_complete).alias("local_only")
    )
    return (
        attach(_styled(valid), days, DAY, ["path"], params)
        .filter(~F.col("local_only") | local)
        .drop("local_only")
    )


# --- per-minute rules ------------------------------------------------------

def with_minute(files: DataFrame) -> DataFrame:
    """Add `minute`, `kind` and `style`; names without a time of day are left out."""
    name = F.col("name")
    return files.withColumns({
        "minute": N.minute_of_day(N.hhmm(name)),
        "kind": N.data_kind(name),
        "style": N.style(name),
    }).filter(F.col("minute").isNotNull())


def patch_minutes(local: DataFrame, others: DataFrame, params: Params = Params()) -> DataFrame:
    """`local`, plus those `others` whose minute no local file covers.

    Both as from `with_minute`. What `local` covers travels as one set of minutes
    per station-day and kind.
    """
    words = M.minute_words(local, SIDE, F.col("minute"))
    covered = M.minute_sets(words, SIDE, "covered")
    lacking = (
        attach(others, covered, SIDE, ["path"], params, "left")
        .filter(~M.has_minute(F.col("covered"), F.col("minute")))
        .drop("covered")
    )
    return local.unionByName(lacking)


def select_per_minute(
    files: DataFrame, params: Params = Params(), grid: bool = False
) -> DataFrame:
    """Per minute all local files if there are any, else all others.

    `grid=True` also drops triggered names.
    """
    minutes = with_minute(with_extensions(files, "minute"))
    if grid:
        minutes = minutes.filter(~N.is_triggered(F.col("name")))
    is_local = F.col("style") == "underscored"
    return patch_minutes(minutes.filter(is_local), minutes.filter(~is_local), params)


def select_larger(files: DataFrame, params: Params = Params()) -> DataFrame:
    """The largest file of each minute; local before others on equal size.

    The rank filter is applied within each input partition first, so a busy
    minute reaches the shuffle as one row per partition.
    """
    minutes = with_minute(with_extensions(files, "minute"))
    order = Window.partitionBy(*SIDE, "minute").orderBy(
        F.desc("length"),
        F.when(F.col("style") == "underscored", 0).otherwise(1),
        "name",
    )
    return (
        minutes.withColumn("_rank", F.row_number().over(order))
        .filter("_rank = 1")
        .drop("_rank")
    )


# --- stamp rules -----------------------------------------------------------

def _stamped(files: DataFrame, literal: bool = False) -> DataFrame:
    name = F.col("name")
    return files.filter(N.n_underscores(name) >= 3).withColumn(
        "stamp", N.stamp_underscored(name, literal)
    )


def select_by_stamp(
    files: DataFrame, params: Params = Params(), literal: bool = False
) -> DataFrame:
    """Local files of exactly full days, else those of every common enough stamp."""
    common = (F.col("n") >= params.stamp_min) & F.col("stamp").isNotNull()
    days = (
        stamp_counts(files, "underscored", literal)
        .groupBy(*DAY)
        .agg(
            (F.sum("n") == params.expected).alias("full"),
            F.collect_set(F.when(common, F.col("stamp"))).alias("common"),  # at most 100
        )
    )
    return (
        attach(_stamped(files, literal), days, DAY, ["path"], params)
        .filter(F.col("full") | F.array_contains("common", F.col("stamp")))
        .drop("full", "common")
    )


def _about_full(n: Column, params: Params) -> Column:
    return F.abs(n - params.expected) <= params.threshold_missing


def _stamp_of_local(name: Column) -> Column:
    return F.when(N.n_underscores(name) >= 3, N.stamp_underscored(name))


def _local_kept(style: Column, stamp: Column) -> Column:
    """Local files a day's rule takes, given its `rule` and `stamps`."""
    rule = F.col("rule")
    return (style == "underscored") & (
        rule.isin("local", "patched")
        | (rule.isin("one_stamp", "stamps", "stamps_patched") & F.array_contains("stamps", stamp))
    )


def _cascade_groups(valid: DataFrame) -> DataFrame:
    """Files and minutes of each station-day, style and stamp: all the rules need.

    At most 23 rows per day, style and stamp, one for each word of minutes.
    """
    name = F.col("name")
    minute = N.minute_of_day(N.hhmm(name))
    return valid.groupBy(
        *DAY,
        N.style(name).alias("style"),
        _stamp_of_local(name).alias("stamp"),
        M.word_of(minute).alias("word"),
    ).agg(F.count(F.lit(1)).alias("n"), F.bit_or(M.bit_of(minute)).alias("bits"))


def _cascade_days(groups: DataFrame, params: Params) -> DataFrame:
    n = F.col("n")
    local = F.col("style") == "underscored"
    stamped = local & F.col("stamp").isNotNull()
    common = stamped & (n >= params.stamp_min)
    stamps = groups.groupBy(*DAY, "style", "stamp").agg(F.sum("n").alias("n"))
    days = stamps.groupBy(*DAY).agg(
        F.sum(F.when(local, n).otherwise(0)).alias("us"),
        F.sum(F.when(F.col("style") == "spaced", n).otherwise(0)).alias("sp"),
        F.max(F.when(stamped & _about_full(n, params), F.struct("n", "stamp"))).alias("full"),
        F.sum(F.when(stamped, n).otherwise(0)).alias("n_stamped"),
        F.sum(F.when(common, n).otherwise(0)).alias("n_common"),
        F.collect_set(F.when(common, F.col("stamp"))).alias("common"),  # at most 100
    )
    us, sp = F.col("us"), F.col("sp")
    few = us < params.near_complete
    many = us > params.expected + params.threshold_missing
    return days.select(
        *DAY,
        F.when(_about_full(us, params), "local")
        .when(few & _about_full(sp, params), "telemetered")
        .when(many & F.col("full").isNotNull(), "one_stamp")
        .when(many & (F.col("n_stamped") == 0), "patched")
        .when(many & (F.col("n_common") >= params.near_complete), "stamps")
        .when(many, "stamps_patched")
        .otherwise("patched")
        .alias("rule"),
        F.when(many & F.col("full").isNotNull(), F.array("full.stamp"))
        .otherwise(F.col("common"))
        .alias("stamps"),
    )


def cascade_plan(
    files: DataFrame, family: str = "echo", params: Params = Params()
) -> DataFrame:
    """Which rule each station-day follows, from style and stamp counts alone.

    local: about a full day of local files; telemetered: about a full day of
    telemetered files and few local ones; one_stamp: too many local files, one
    stamp of about a full day; stamps: too many, common stamps nearly make a
    day; stamps_patched: common stamps fall short; patched: too few local files, or too
    many whose names carry no stamp.
    """
    groups = _cascade_groups(valid_files(files, family, params))
    return _cascade_days(groups, params).drop("stamps")


def select_cascade(
    files: DataFrame, family: str = "echo", params: Params = Params()
) -> DataFrame:
    """Files chosen by the rule of their day (see `cascade_plan`).

    The day's rule and the minutes its kept local files cover reach the files
    together, in one join.
    """
    valid = valid_files(files, family, params)
    groups = _cascade_groups(valid)
    days = _cascade_days(groups, params)
    kept = groups.join(days, DAY).filter(_local_kept(F.col("style"), F.col("stamp")))
    covered = M.minute_sets(kept, DAY, "covered")
    name, rule = F.col("name"), F.col("rule")
    minute = N.minute_of_day(N.hhmm(name))
    patch = (
        rule.isin("patched", "stamps_patched")
        & minute.isNotNull()
        & ~M.has_minute(F.col("covered"), minute)
    )
    return (
        attach(_styled(valid), days.join(covered, DAY, "left"), DAY, ["path"], params)
        .filter(
            _local_kept(F.col("style"), _stamp_of_local(name))
            | ((F.col("style") == "spaced") & ((rule == "telemetered") | patch))
        )
        .drop("stamps", "covered")
    )


# --- gaps ------------------------------------------------------------------

def _minutes_present(files: DataFrame) -> DataFrame:
    return M.minute_words(files, DAY, N.minute_of_day(N.hhmm(F.col("name"))))


def missing_minutes(files: DataFrame) -> DataFrame:
    """Minutes of the day grid that no file covers, a row each."""
    words = _minutes_present(files)
    # Days without any minute lack all of them: keep them with an empty word.
    words = words.select(
        *DAY, F.coalesce("word", F.lit(0)).alias("word"),
        F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"),
    )
    return M.minute_sets(words, DAY, "minutes").select(
        *DAY, F.explode(M.lacking_minutes(F.col("minutes"))).alias("minute")
    )


def missing_minute_counts(files: DataFrame) -> DataFrame:
    present = F.coalesce(F.sum(F.bit_count("bits")), F.lit(0))
    return _minutes_present(files).groupBy(*DAY).agg(
        (F.lit(M.MINUTES) - present).alias("n_missing")
    )
