"""The whole run: decide each station-day, then file its records."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from archivekit import schemas
from archivekit.functions import names as N
from archivekit.operators.carry import carried_before, carry_on, read_carry
from archivekit.operators.changes import days_changed, fingerprint
from archivekit.operators.checks import day_checks
from archivekit.operators.classify import KNOWN_RECORDERS, carry_type, decide_type, is_known_recorder
from archivekit.operators.lookup import attach, attach_small
from archivekit.operators.records import RECORD_KEY
from archivekit.operators.rejects import reject_reason, rejected_days
from archivekit.operators.rename import day_rules, rename_by_day_rules, select_channels
from archivekit.operators.select import near_complete_rule
from archivekit.operators.workspace import discard, stage
from archivekit.params import Params
from archivekit.sinks.archive import write_manifest, write_sds, year_span
from archivekit.sinks.runlog import day_lines, read_run_log, write_day_lines, write_run_log
from archivekit.sources.catalog import between_days

DAY = ["station_dir", "day"]


def archive_days(
    files: DataFrame, params: Params = Params(), reset: str | None = None, carried: DataFrame | None = None
) -> DataFrame:
    """One row per station-day: recorder family, style kept, files chosen, fingerprint.

    Both families are counted in the same pass over the names, so the family of
    the day and the file set it implies come out of one aggregation. `carried` has the
    family each station brings along from before these files.
    """
    name = F.col("name")
    style = N.style(name)

    def valid(family: str):
        return N.has_extension(name, family) & ~F.rlike(name, F.lit(params.ignore(family)))

    per_family = []
    for fam in KNOWN_RECORDERS:
        per_family += [
            F.count_if(valid(fam) & (style == "underscored")).alias(f"us_{fam}"),
            F.count_if(valid(fam) & (style == "spaced")).alias(f"sp_{fam}"),
            F.count_if(valid(fam)).alias(f"all_{fam}"),
        ]
    counts = files.groupBy(*DAY).agg(
        F.count_if(N.has_extension(name, "echo")).alias("n_dmx"),
        F.count_if(N.has_extension(name, "gecko")).alias("n_ms"),
        *per_family,
        *fingerprint(files),
    ).withColumn("n_total", F.col("n_dmx") + F.col("n_ms"))
    decided = decide_type(counts, params)
    days = carry_type(decided, params, reset) if carried is None else carry_on(decided, carried, params)

    # An unknown family has no files to choose.
    pick = lambda what: F.when(
        F.col("recorder") == "echo", F.col(f"{what}_echo")
    ).when(F.col("recorder") == "gecko", F.col(f"{what}_gecko"))
    days = days.withColumns({"us": pick("us"), "sp": pick("sp"), "n_valid": pick("all")})
    days = days.withColumn("keep", near_complete_rule(F.col("us"), F.col("sp"), params))
    return days.select(
        *DAY,
        "recorder",
        "keep",
        F.when(F.col("keep") == "all", F.col("n_valid"))
        .when(F.col("keep") == "underscored", F.col("us"))
        .when(F.col("keep") == "spaced", F.col("sp"))
        .otherwise(0)
        .alias("n_selected"),
        "n_files",
        "fingerprint",
    )


def _kept_by_day(params: Params):
    """Does a file name survive the facts (`recorder`, `keep`) of its day?"""
    name = F.col("name")
    ignored = F.when(
        F.col("recorder") == "echo", F.rlike(name, F.lit(params.ignore_echo))
    ).otherwise(F.rlike(name, F.lit(params.ignore_gecko)))
    return (
        (N.family_of(name) == F.col("recorder"))
        & ~ignored
        & ((F.col("keep") == "all") | (N.style(name) == F.col("keep")))
    )


def choose_files(
    files: DataFrame, days: DataFrame, params: Params = Params()
) -> DataFrame:
    """Files of each day's own family that its near-complete rule keeps."""
    facts = days.filter(F.col("keep").isNotNull()).select(*DAY, "recorder", "keep")
    return attach(files, facts, DAY, ["path"], params).filter(_kept_by_day(params))


def choose_records(
    records: DataFrame, days: DataFrame, params: Params = Params()
) -> DataFrame:
    """Records whose source file is chosen, without looking the file up.

    The choice depends only on the file's name and its day's facts, and a
    record carries its source path, so the list of files is not joined. Other
    columns of `days` come along.
    """
    keyed = N.with_path_keys(records, "src_path")
    facts = days.filter(F.col("keep").isNotNull())
    return (
        attach_small(keyed, facts, DAY, ["src_path", "start_ts", "cha"], params)
        .filter(_kept_by_day(params))
        .drop("recorder", "keep", "name")
    )


def day_plan(
    days: DataFrame, channels: DataFrame, present: DataFrame, params: Params = Params()
) -> DataFrame:
    """Final status of each station-day.

    `days` as from `archive_days`, `channels` as from `select_channels`,
    `present` holds the station-days already filed.
    """
    rules = channels.groupBy(*DAY).agg(F.count(F.lit(1)).alias("n_rules"))
    done = present.select(*DAY).distinct().withColumn("_present", F.lit(True))
    n_rules = F.coalesce("n_rules", F.lit(0))
    return (
        days.join(rules, DAY, "left")
        .join(done, DAY, "left")
        .select(
            *DAY,
            "recorder",
            "n_selected",
            n_rules.alias("n_rules"),
            F.when(F.col("_present"), "PRESENT")
            .when(~F.col("recorder").isin(*KNOWN_RECORDERS), "UNKNOWN_RECORDER")
            .when(F.col("n_selected") == 0, "EMPTY")
            .when(n_rules == 0, "NO_RULES")
            .otherwise("OK")
            .alias("status"),
        )
    )


def run_archive(
    spark: SparkSession,
    files: DataFrame,
    records: DataFrame,
    sds_root: str,
    run_log: str | None = None,
    day_logs: str | None = None,
    manifest: str | None = None,
    params: Params = Params(),
    start=None,
    end=None,
    reset: str | None = None,
    skip_present: bool = True,
    folders: Sequence[str] = tuple(schemas.SDS_PARTITIONS),
    stations: Sequence[str] | None = None,
    carry: str | None = None,
    rejects: str | None = None,
    key_table: str | None = None,
    checks: str | None = None,
) -> DataFrame:
    """File the records of all station-days from `start` to `end`.

    `files` is the listing of the whole archive, `records` the decoded records; a record
    table of `write_records` is read for the days and `stations` of the run alone. Where
    `carry` names stored summaries (`operators.carry`), recorder types are carried from
    them and the listing is read from the first month of the run on; else they are
    carried over all days before `start`, or with a `reset` over those it leaves.

    Days logged as OK are skipped while their files stay the same. A day whose files
    changed since is decided anew, and what it files replaces what it had filed. A day
    that only received records spilled over midnight is not skipped, and records already
    filed are never written twice.

    Records that can't be filed go to the table `rejects`, if given, and their day is
    logged as FAILED while all others, and its other records, are filed.
    `key_table` names a bucketed table of filed keys to compare with (`sinks.keys`). What
    looks wrong about the days being filed (`operators.checks`: errant stations, too many
    streams) is added to the table `checks`, if given, before anything is filed. If a
    step fails altogether, the days it was meant for are logged as FAILED with the error,
    which is then raised. Returns the plan: one row per station-day with its status.
    """
    staged: list[str] = []
    run_ts = F.lit(datetime.now(timezone.utc))
    if stations is not None:
        files = files.filter(F.col("station_dir").isin(*stations))
    records = _of_run(records, start, end, stations)
    plan = todo = None
    error = None
    try:
        logged = read_run_log(spark, run_log) if run_log else spark.createDataFrame([], schemas.STORED_RUNS)
        days = _decided_days(spark, files, start, end, params, reset, carry)
        days = stage(days_changed(days, logged), "days", staged)
        present = days.filter(F.col("change") == "same") if skip_present else days.limit(0)
        todo = days.join(present.select(*DAY), DAY, "left_anti")

        if manifest:
            write_manifest(
                choose_files(between_days(files, start, end), todo, params), manifest, "append"
            )

        # Streams need identities and paths only; payloads are not read here.
        narrow = records.drop("payload", "rate")
        facts = is_known_recorder(todo).select(*DAY, "recorder", "keep")
        chosen = choose_records(narrow, facts, params)
        channels = stage(select_channels(chosen, params), "channels", staged)
        plan = stage(day_plan(days, channels, present, params), "plan")

        # Everything a record needs to know about its day, in one row per day, so
        # payloads meet one join here.
        go = plan.filter(F.col("status") == "OK").select(*DAY)
        ready = stage(
            facts.join(go, DAY, "left_semi").join(day_rules(channels, params), DAY), "ready", staged
        )
        filed = rename_by_day_rules(choose_records(records, ready, params))
        renamed = rename_by_day_rules(choose_records(narrow, ready, params)).withColumn("reason", reject_reason())
        renamed = stage(renamed, "keys", staged)
        # Only folders of the records being filed are compared with.
        years, codes, any_bad = _span(renamed, params)
        if any_bad:
            plan = _with_rejects(renamed, plan, run_ts, rejects, staged)
            filed = filed.filter(reject_reason().isNull())
        if checks:
            of_run = attach_small(between_days(files, start, end), go, DAY, ["name"], params)
            found = day_checks(of_run, attach_small(chosen, go, DAY, ["start_ts", "cha"], params), renamed, params)
            found.select(run_ts.alias("run_ts"), "*").write.mode("append").parquet(checks)
        replaced = todo.filter(F.col("change") == "changed").join(go, DAY, "left_semi").select(*DAY)
        replaced = None if replaced.isEmpty() else stage(replaced, "replaced", staged)
        write_sds(
            filed.select(*schemas.RECORDS.fieldNames()), sds_root, years, folders, codes, replaced, params,
            renamed.filter("reason IS NULL"), key_table,
        )
    except Exception as raised:
        error = raised
    try:
        if plan is None and todo is not None:
            plan = todo.select(
                *DAY, "recorder", "n_selected", F.lit(0).cast("bigint").alias("n_rules"), F.lit("OK").alias("status")
            )
        if plan is not None:
            _log(plan, days, error, run_ts, run_log, day_logs)
    finally:
        discard(spark, staged)
    if error is not None:
        raise error
    return plan


def _decided_days(spark, files, start, end, params, reset, carry) -> DataFrame:
    """`archive_days` from `start` to `end`, with as much of the days before as they need."""
    first = start
    if start is not None and carry is not None and reset is None:
        first = F.trunc(F.lit(start).cast("date"), "month")
        carried = carried_before(read_carry(spark, carry), first)
        return between_days(archive_days(between_days(files, first, end), params, None, carried), start, end)
    if start is not None and reset is not None:
        first = F.trunc(F.lit(start).cast("date"), "month") if reset == "month" else start
    return between_days(archive_days(between_days(files, first if reset else None, end), params, reset), start, end)


def _span(records: DataFrame, params: Params) -> tuple[list[int], list[str] | None, bool]:
    """Years and station codes (if few) of the records being filed, and whether some can't be."""
    sta = F.coalesce(F.when(F.trim("sta") != "", F.col("sta")), F.lit(schemas.BLANK))
    seen = records.groupBy(F.year("start_ts").alias("year"), sta.alias("sta")).agg(F.count("reason").alias("bad"))
    rows = seen.limit(params.folder_globs + 1).collect()
    if len(rows) > params.folder_globs:
        return year_span(records), None, not records.filter("reason IS NOT NULL").isEmpty()
    years = sorted({r["year"] for r in rows if r["year"] is not None})
    plain = all(re.fullmatch(r"[A-Za-z0-9_-]+", r["sta"]) for r in rows)
    return years, sorted({r["sta"] for r in rows}) if plain else None, any(r["bad"] for r in rows)


def _with_rejects(renamed, plan, run_ts, path, staged) -> DataFrame:
    """The plan with days FAILED that have records which can't be filed; writes those to `path`."""
    bad = renamed.filter("reason IS NOT NULL").select(
        run_ts.alias("run_ts"), "station_dir", "day", "reason", *RECORD_KEY, "src_path")
    bad = stage(bad, "rejects", staged)
    if path:
        bad.write.mode("append").parquet(path)
    broken = rejected_days(bad)
    error = F.when(F.col("reason").isNotNull(), F.format_string("%d records rejected: %s", "n_rejected", "reason"))
    status = F.when(F.col("reason").isNotNull(), "FAILED").otherwise(F.col("status"))
    joined = plan.join(broken, DAY, "left").withColumns({"status": status, "error": error})
    return stage(joined.drop("n_rejected", "reason"), "plan")


def _log(plan, days, error, run_ts, run_log, day_logs) -> None:
    done = plan.filter(F.col("status") != "PRESENT")
    detail = F.format_string("files=%d rules=%d", "n_selected", "n_rules")
    if "error" in plan.columns:
        detail = F.coalesce("error", detail)
    status = F.col("status")
    if error is not None:
        failed = status == "OK"
        detail = F.when(failed, F.lit(f"{type(error).__name__}: {error}"[:500])).otherwise(detail)
        status = F.when(failed, "FAILED").otherwise(status)
    done = done.withColumns({"detail": detail, "status": status})
    if run_log:
        seen = done.join(days.select(*DAY, "n_files", "fingerprint"), DAY, "left")
        write_run_log(
            seen.select(
                run_ts.alias("run_ts"),
                F.col("station_dir").alias("station"),
                "day", "recorder", "status", "detail", "n_files", "fingerprint",
            ),
            run_log,
        )
    if day_logs:
        write_day_lines(day_lines(done).withColumn("run_ts", run_ts), day_logs)


def _of_run(records: DataFrame, start, end, stations: Sequence[str] | None) -> DataFrame:
    """Records of the run's stations and days; on a stored table by its folders and row groups.

    A day's files lie in the folder of its own year, whenever their records start.
    Tables stored without days are read for whole years.
    """
    if "station_dir" in records.columns and stations is not None:
        records = records.filter(F.col("station_dir").isin(*stations))
    for bound, at_least in ((start, True), (end, False)):
        if bound is None:
            continue
        day = F.lit(bound).cast("date")
        beyond = (lambda a, b: a >= b) if at_least else (lambda a, b: a <= b)
        if "year" in records.columns:
            records = records.filter(beyond(F.col("year"), F.year(day)))
        if "day" in records.columns:
            records = records.filter(F.col("day").isNull() | beyond(F.col("day"), day))
    return records.select(*schemas.RECORDS.fieldNames())
