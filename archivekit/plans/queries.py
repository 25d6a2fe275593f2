"""Named queries: every operator over the tables of one data folder.

Files, records and log lines are derived from the whole `events` table. The
thresholds are scaled to about eighty files per station-day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from archivekit.functions import names as N
from archivekit.operators import carry, changes, classify, records as R, rejects, rename, select, stamps
from archivekit.operators.workspace import new_folder
from archivekit.params import Params
from archivekit.plans import archive
from archivekit.sinks import archive as sink, runlog
from archivekit.sources import catalog, derived, members

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = ["station_dir", "day"]
FILE = [*DAY, "name", "length"]
SCALED = Params(
    expected=40, threshold_missing=5, min_files=80, min_count=20, stamp_min=3, tail_lines=5
)
PRESENT_BEFORE = "2024-01-11"
ONE_DAY = "2024-01-15"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return derived.load_events(spark, folder)


def _files(spark: SparkSession, folder: str, ancillary: bool = False) -> DataFrame:
    """The listing with its keys as plain columns, as a stored catalog has them.

    The generator keeps Catalyst from copying the parsing of paths into every
    predicate on `name`, `station_dir` and `day`.
    """
    keyed = N.with_path_keys(derived.files(_events(spark, folder), ancillary))
    return keyed.select(F.inline(F.array(F.struct(*keyed.columns))))


def _all(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder, ancillary=True)


def _raw_records(spark: SparkSession, folder: str) -> DataFrame:
    return derived.records(_events(spark, folder))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Unique records with the station-day of their folder."""
    unique = R.dedup_records(_raw_records(spark, folder).drop("payload"))
    return N.with_path_keys(unique, "src_path").drop("name")


def _local(name: str = "name"):
    return N.is_underscored(F.col(name))


# --- names -----------------------------------------------------------------

@query
def parse_names(spark, folder):
    name = F.col("name")
    return N.parse_name(_all(spark, folder)).select(
        "path", "station_dir", "day", "name", "date", "hhmm", "ss", "station", "cha",
        "ext", "style", "is_trig",
        N.stem(name).alias("stem"),
        N.n_underscores(name).alias("n_underscores"),
        N.minute_of_day(F.col("hhmm")).alias("minute"),
        N.is_compressed(name).alias("compressed"),
        N.family_of(name).alias("family"),
    )


@query
def strict_spaced_names(spark, folder):
    name = F.col("name")
    return _all(spark, folder).select(
        *DAY, "name",
        N.is_strict_spaced_echo(name).alias("strict_echo"),
        N.is_strict_spaced_gecko(name).alias("strict_gecko"),
    )


@query
def valid_files(spark, folder):
    files = _all(spark, folder)
    parts = [
        select.valid_files(files, fam).select(F.lit(fam).alias("family"), *FILE)
        for fam in classify.KNOWN_RECORDERS
    ]
    return parts[0].unionByName(parts[1])


@query
def day_folders(spark, folder):
    return catalog.day_folders(_all(spark, folder), start="2024-01-10", end="2024-01-20")


# --- classification ----------------------------------------------------------

@query
def family_counts(spark, folder):
    return classify.count_by_family(_all(spark, folder))


@query
def recorder_type(spark, folder):
    return classify.recorder_type(_all(spark, folder), SCALED)


@query
def recorder_type_monthly(spark, folder):
    return classify.recorder_type(_all(spark, folder), SCALED, reset="month")


@query
def recorder_type_alone(spark, folder):
    return classify.recorder_type(_all(spark, folder), SCALED, reset="day")


@query
def folder_shape(spark, folder):
    return classify.folder_shape(_all(spark, folder))


@query
def archive_level(spark, folder):
    return classify.archive_level(_all(spark, folder))


@query
def archive_level_by_name(spark, folder):
    return classify.archive_level(_all(spark, folder), mode="name")


@query
def archive_level_by_count(spark, folder):
    return classify.archive_level(_all(spark, folder), mode="count")


@query
def majority_station(spark, folder):
    return classify.majority_station(_all(spark, folder), SCALED)


@query
def station_census(spark, folder):
    return classify.station_census(_all(spark, folder), SCALED)


@query
def station_errants(spark, folder):
    return classify.station_errants(_all(spark, folder), SCALED)


@query
def resolve_station(spark, folder):
    return classify.resolve_station(_all(spark, folder), SCALED)


@query
def errant_files(spark, folder):
    return classify.errant_station(N.parse_name(_all(spark, folder))).select(
        *FILE, "station"
    )


# --- stamps ------------------------------------------------------------------

@query
def stamp_histogram(spark, folder):
    return stamps.stamp_histogram(_all(spark, folder), "underscored")


@query
def stamp_histogram_spaced_echo(spark, folder):
    return stamps.stamp_histogram(_all(spark, folder), "spaced_echo")


@query
def stamp_histogram_spaced_gecko(spark, folder):
    return stamps.stamp_histogram(_all(spark, folder), "spaced_gecko")


@query
def underscored_gecko_stations(spark, folder):
    return stamps.stamp_histogram(_all(spark, folder), "underscored_gecko")


@query
def stamp_totals(spark, folder):
    files = _all(spark, folder)
    out = None
    for source in ("underscored", "spaced_echo", "spaced_gecko", "underscored_gecko"):
        part = stamps.total_considered(files, source).withColumn("source", F.lit(source))
        out = part if out is None else out.unionByName(part)
    return out


@query
def stamp_mode(spark, folder):
    return stamps.stamp_mode(_all(spark, folder))


@query
def stamp_diff(spark, folder):
    return stamps.stamp_diff(_all(spark, folder))


@query
def day_modes(spark, folder):
    return stamps.day_modes(_all(spark, folder))


@query
def rare_stamp_files(spark, folder):
    return stamps.rare_stamp_files(_all(spark, folder), SCALED).select(*FILE, "stamp", "n")


# --- selection ---------------------------------------------------------------

@query
def style_counts(spark, folder):
    return select.count_by_style(_all(spark, folder))


@query
def day_completeness(spark, folder):
    valid = select.valid_files(_all(spark, folder), "echo", SCALED)
    return select.day_completeness(valid, SCALED)


@query
def select_near_complete(spark, folder):
    return select.select_near_complete(_all(spark, folder), "echo", SCALED).select(*FILE)


@query
def select_near_complete_gecko(spark, folder):
    return select.select_near_complete(_all(spark, folder), "gecko", SCALED).select(*FILE)


@query
def select_near_complete_v0(spark, folder):
    return select.select_near_complete_v0(_all(spark, folder), SCALED).select(*FILE)


@query
def select_all_valid(spark, folder):
    return select.select_all_valid(_all(spark, folder)).select(*FILE)


@query
def select_per_minute(spark, folder):
    return select.select_per_minute(_all(spark, folder), SCALED).select(*FILE)


@query
def select_per_minute_grid(spark, folder):
    return select.select_per_minute(_all(spark, folder), SCALED, grid=True).select(*FILE)


@query
def select_larger(spark, folder):
    return select.select_larger(_all(spark, folder), SCALED).select(*FILE)


@query
def select_by_stamp(spark, folder):
    return select.select_by_stamp(_all(spark, folder), SCALED).select(*FILE)


@query
def cascade_plan(spark, folder):
    return select.cascade_plan(_all(spark, folder), "echo", SCALED)


@query
def select_cascade(spark, folder):
    return select.select_cascade(_all(spark, folder), "echo", SCALED).select(*FILE, "rule")


@query
def patch_minutes(spark, folder):
    valid = select.with_minute(select.valid_files(_all(spark, folder), "echo", SCALED))
    return select.patch_minutes(
        valid.filter(_local()), valid.filter(~_local()), SCALED
    ).select(*FILE)


@query
def missing_minutes(spark, folder):
    return select.missing_minutes(_all(spark, folder))


@query
def missing_minute_counts(spark, folder):
    return select.missing_minute_counts(_all(spark, folder))


@query
def choose_files(spark, folder):
    files = _all(spark, folder)
    days = archive.archive_days(files, SCALED)
    return archive.choose_files(files, days, SCALED).select(*FILE, "recorder", "keep")


# --- records and streams -------------------------------------------------------

@query
def dedup_records(spark, folder):
    return R.dedup_records(_raw_records(spark, folder).drop("payload"))


@query
def sorted_records(spark, folder):
    return R.record_positions(_records(spark, folder)).select(
        *R.RECORD_KEY, "position"
    )


@query
def stream_inventory(spark, folder):
    return R.stream_inventory(_records(spark, folder))


@query
def stream_inventory_daily(spark, folder):
    return R.stream_inventory(_records(spark, folder), DAY)


@query
def inventory_summary(spark, folder):
    return R.inventory_summary(_records(spark, folder))


@query
def too_many_streams(spark, folder):
    return R.too_many_streams(_records(spark, folder))


@query
def select_channels(spark, folder):
    return rename.select_channels(_records(spark, folder))


@query
def select_channels_v0(spark, folder):
    return rename.select_channels(_records(spark, folder), legacy=True)


@query
def rename_rules(spark, folder):
    return rename.build_rename_rules(rename.select_channels(_records(spark, folder)))


@query
def rename_strings(spark, folder):
    return rename.rename_strings(rename.select_channels(_records(spark, folder)))


@query
def channel_spec(spark, folder):
    return rename.channel_spec(rename.select_channels(_records(spark, folder)))


@query
def renamed_records(spark, folder):
    recs = _records(spark, folder)
    return rename.apply_rename(recs, rename.select_channels(recs)).select(
        *R.RECORD_KEY, *DAY
    )


@query
def renamed_wildcard(spark, folder):
    rules = "AB.ST1.*.DLZ:VW.-.00.-,AB.ST1.*.DL*:VX.-.-.-,AB.*.60.DLE:VY.-.10.BHE,ZZ.-.-.-"
    return rename.apply_wildcard_rename(_records(spark, folder), rules).select(*R.RECORD_KEY)


@query
def band_codes(spark, folder):
    recs = _records(spark, folder)
    # Rates and corner periods spread over the whole code table.
    rate = F.element_at(
        F.array(*[F.lit(float(r)) for r in (5, 20, 100, 250, 500, 1000)]),
        (F.col("n_samples") / 100 % 6).cast("int") + 1,
    )
    corner = F.when(F.col("n_samples") % 700 == 0, 60.0).otherwise(2.0)
    return rename.with_band_codes(
        recs.withColumns({"rate": rate, "corner_period": corner}), F.col("corner_period")
    ).select(*R.RECORD_KEY, "rate", "corner_period", "band_code", "instrument")


# --- filing --------------------------------------------------------------------

@query
def sds_keys(spark, folder):
    return sink.with_sds_path(_records(spark, folder)).select(
        *R.RECORD_KEY, "year", "doy", "sds_path"
    )


@query
def sds_day_counts(spark, folder):
    return sink.sds_day_counts(_records(spark, folder))


@query
def midnight_spill(spark, folder):
    """Records whose end lies past their folder's day."""
    return (
        _records(spark, folder)
        .filter(F.col("end_ts").cast("date") > F.col("day"))
        .select(*DAY, *R.RECORD_KEY)
    )


def _days_of(records: DataFrame) -> DataFrame:
    return catalog.filed_days(sink.assign_sds_day(records))


@query
def skip_present_days(spark, folder):
    recs = _records(spark, folder)
    present = recs.filter(F.col("start_ts") < F.lit(PRESENT_BEFORE).cast("timestamp_ntz"))
    return sink.skip_present(_days_of(recs), _days_of(present), ["net", "sta", "year", "doy"])


@query
def new_records(spark, folder):
    recs = _records(spark, folder)
    filed = recs.filter(F.col("start_ts") < F.lit(PRESENT_BEFORE).cast("timestamp_ntz"))
    return sink.new_records(recs, filed).select(*R.RECORD_KEY)


_SDS_OUT = [*R.RECORD_KEY, "rate", "year", "doy"]


@query
def write_sds_roundtrip(spark, folder):
    """File the raw records twice; the second time nothing is left to write."""
    root = new_folder(spark, "sds")
    raw = _raw_records(spark, folder)
    sink.write_sds(raw, root)
    once = catalog.scan_sds(spark, root).count()
    sink.write_sds(raw, root)
    filed = catalog.scan_sds(spark, root)
    return filed.select(*_SDS_OUT, F.lit(filed.count() - once).alias("written_again"))


@query
def rehome_roundtrip(spark, folder):
    source, target = new_folder(spark, "sds"), new_folder(spark, "rehomed")
    sink.write_sds(_raw_records(spark, folder), source)
    sink.rehome_archive(spark, source, target, "AB.*.*.*:VX.-.-.-")
    return catalog.scan_sds(spark, target).select(*_SDS_OUT)


@query
def manifest_roundtrip(spark, folder):
    root = new_folder(spark, "manifest")
    sink.write_manifest(
        select.select_near_complete(_all(spark, folder), "echo", SCALED), root
    )
    return sink.read_manifest(spark, root).select(*FILE, "style", "year")


@query
def catalog_roundtrip(spark, folder):
    root = new_folder(spark, "catalog")
    catalog.write_catalog(_all(spark, folder), root)
    return catalog.read_catalog(spark, root).select("path", "year", *FILE)


@query
def expand_members(spark, folder):
    packed = derived.packed_files(_events(spark, folder))
    return members.expand_members(packed).select(
        "path", "member", "member_size", F.md5("content").alias("digest")
    )


# --- runs ----------------------------------------------------------------------

def _plan(spark, folder) -> DataFrame:
    files, recs = _all(spark, folder), _raw_records(spark, folder).drop("payload")
    days = archive.archive_days(files, SCALED)
    channels = rename.select_channels(archive.choose_records(recs, days, SCALED), SCALED)
    present = days.filter(F.col("day") < F.lit(PRESENT_BEFORE).cast("date"))
    return archive.day_plan(days, channels, present, SCALED)


@query
def day_plan(spark, folder):
    return _plan(spark, folder)


def _runs(spark, folder) -> DataFrame:
    return _plan(spark, folder).select(
        F.current_timestamp().alias("run_ts"),
        F.col("station_dir").alias("station"),
        "day", "recorder", "status",
        F.format_string("files=%d rules=%d", "n_selected", "n_rules").alias("detail"),
    )


@query
def run_summary(spark, folder):
    """Two runs appended to one log, then summed up."""
    root = new_folder(spark, "runs")
    runs = _runs(spark, folder)
    runlog.write_run_log(runs, root)
    runlog.write_run_log(runs, root)
    return runlog.run_summary(runlog.read_run_log(spark, root))


@query
def run_lines(spark, folder):
    runs = _runs(spark, folder).withColumn(
        "run_ts", F.lit("2024-02-01 00:00:00").cast("timestamp")
    )
    return runlog.run_lines(runs).select(
        "station", "day", F.substring_index("line", " | ", -3).alias("line")
    )


@query
def day_lines(spark, folder):
    return runlog.day_lines(_plan(spark, folder))


@query
def last_log_lines(spark, folder):
    return runlog.last_lines(derived.log_lines(_events(spark, folder)), SCALED)


@query
def crash_report(spark, folder):
    """Days with a large share of error events stand for failed ones."""
    events = _events(spark, folder)
    lines = derived.log_lines(events)
    errors = F.count_if(F.contains("line", F.lit(" error ")))
    runs = lines.groupBy("station", "day").agg(
        F.when(errors * 4 > F.count(F.lit(1)), "FAILED").otherwise("OK").alias("status"),
        errors.cast("string").alias("detail"),
    )
    return runlog.crash_report(runs, lines, SCALED)


@query
def filed_payloads(spark, folder):
    """The samples filed, by digest, and the source file they are credited to."""
    root = new_folder(spark, "sds")
    sink.write_sds(_raw_records(spark, folder), root)
    filed = catalog.scan_sds(spark, root)
    return filed.select(*R.RECORD_KEY, F.md5("payload").alias("digest"), "src_path")


@query
def import_one_day(spark, folder):
    """The run for one day, on a record table stored by station and year."""
    sds, table = new_folder(spark, "sds"), new_folder(spark, "records")
    catalog.write_records(_raw_records(spark, folder), table)
    recs = catalog.read_records(spark, table, partitioned=True)
    archive.run_archive(
        spark, _all(spark, folder), recs, sds, params=SCALED, start=ONE_DAY, end=ONE_DAY)
    return catalog.scan_sds(spark, sds).select(*_SDS_OUT)


@query
def import_archive(spark, folder):
    """The whole run, repeated: choose, rename, file, log; the repeat writes nothing."""
    sds, log = new_folder(spark, "sds"), new_folder(spark, "runs")
    files, recs = _all(spark, folder), _raw_records(spark, folder)
    archive.run_archive(spark, files, recs, sds, run_log=log, params=SCALED)
    archive.run_archive(spark, files, recs, sds, run_log=log, params=SCALED, skip_present=False)
    return catalog.scan_sds(spark, sds).select(*_SDS_OUT)


# --- runs that meet what has changed -----------------------------------------------

#: Files of every 29th event come late, from this day on; days from the other one on are new.
LATE_FROM, NEW_FROM = "2024-01-11", "2024-01-20"
CARRIED_FROM = "2024-01-15"
#: Thresholds by which stations with few files of a family show every rule.
SPARSE = SCALED.with_(expected=3, threshold_missing=1)


def _early(spark, folder) -> DataFrame:
    late = (F.col("event_id") % 29 == 0) & (F.col("ts") >= F.lit(LATE_FROM).cast("timestamp_ntz"))
    return _events(spark, folder).filter(~late)


def _keyed(listing: DataFrame) -> DataFrame:
    keyed = N.with_path_keys(listing)
    return keyed.select(F.inline(F.array(F.struct(*keyed.columns))))


@query
def days_changed(spark, folder):
    """The listing against a log of what earlier files were filed from."""
    root = new_folder(spark, "runs")
    before = changes.day_fingerprints(_keyed(derived.files(_early(spark, folder), True)))
    logged = before.filter(F.col("day") < F.lit(NEW_FROM).cast("date")).select(
        F.current_timestamp().alias("run_ts"), F.col("station_dir").alias("station"), "day",
        F.lit("echo").alias("recorder"), F.lit("OK").alias("status"), F.lit("").alias("detail"),
        "n_files", "fingerprint",
    )
    runlog.write_run_log(logged, root)
    now = changes.day_fingerprints(_all(spark, folder))
    return changes.days_changed(now, runlog.read_run_log(spark, root)).drop("fingerprint")


@query
def refiled_days(spark, folder):
    """A run over the early files, then one over all: changed days replace what they filed."""
    sds, log = new_folder(spark, "sds"), new_folder(spark, "runs")
    early = _early(spark, folder)
    archive.run_archive(
        spark, _keyed(derived.files(early, True)), derived.records(early), sds, run_log=log, params=SCALED)
    archive.run_archive(spark, _all(spark, folder), _raw_records(spark, folder), sds, run_log=log, params=SCALED)
    return catalog.scan_sds(spark, sds).select(*_SDS_OUT)


@query
def recorder_type_stored(spark, folder):
    """Carried types of the later days, from stored summaries of the weeks before."""
    root, files = new_folder(spark, "carry"), _all(spark, folder)
    carry.write_carry(files.filter(F.col("day") < F.lit(CARRIED_FROM).cast("date")), root, SCALED, "week")
    return carry.recorder_type_stored(files, carry.read_carry(spark, root), CARRIED_FROM, SCALED, "week")


@query
def carried_into_weeks(spark, folder):
    """The family each station brings into each week, by a scan over weekly summaries."""
    days = classify.decide_type(classify.count_by_family(_all(spark, folder)), SCALED)
    return carry.carried_into(carry.period_summaries(days, "week"))


@query
def rehome_resumed(spark, folder):
    """A copy that did one day and then goes on: counts of every day copied."""
    source, target, progress = (new_folder(spark, n) for n in ("sds", "rehomed", "progress"))
    sink.write_sds(_raw_records(spark, folder), source)
    sink.rehome_archive(spark, source, target, "AB.*.*.*:VX.-.-.-", doy=5, progress=progress)
    sink.rehome_archive(spark, source, target, "AB.*.*.*:VX.-.-.-", progress=progress, step_days=15)
    return sink.read_progress(spark, progress).drop("copied_at")


@query
def renamed_by_table(spark, folder):
    parts = "struct<net: string, sta: string, loc: string, cha: string>"
    rules = spark.createDataFrame([
        (1, ("AB", "ST1", "*", "DLZ"), ("VW", "-", "00", "-")), (2, ("AB", "*", "60", "DLE"), ("VY", "-", "10", "BHE")),
        (3, ("*", "ST1", "*", "*"), ("VX", "-", "-", "-")), (4, ("AB", "*", "*", "DLE"), ("NO", "NO", "NO", "NO")),
        (5, ("*", "*", "*", "*"), ("ZZ", "-", "-", "-")),
    ], f"ord int, src {parts}, dst {parts}")
    return rename.rename_by_table(_records(spark, folder), rules).select(*R.RECORD_KEY)


@query
def failed_days(spark, folder):
    """A run in which the records of some days can't be filed: those days fail, all others are filed."""
    sds, log, lost = (new_folder(spark, n) for n in ("sds", "runs", "rejects"))
    bad = (F.dayofmonth("start_ts") % 7 == 3) & (F.col("n_samples") % 200 == 0)
    recs = _raw_records(spark, folder).withColumn("end_ts", F.when(~bad, F.col("end_ts")))
    archive.run_archive(spark, _all(spark, folder), recs, sds, run_log=log, params=SCALED, rejects=lost)
    runs = runlog.read_run_log(spark, log).select(F.col("station").alias("station_dir"), "day", "status")
    filed = N.with_path_keys(catalog.scan_sds(spark, sds), "src_path").groupBy(*DAY).agg(F.count(F.lit(1)).alias("n_filed"))
    broken = rejects.rejected_days(spark.read.parquet(lost))
    return runs.join(broken, DAY, "left").join(filed, DAY, "left")


@query
def walked_folders(spark, folder):
    """Real folders below one root, walked without knowing stations or depth."""
    root = new_folder(spark, "tree")
    derived.write_tree(_events(spark, folder), root)
    found = catalog.catalog(catalog.walk_folders(spark, root))
    return found.select(F.substring_index("path", "/", -6).alias("path"), *FILE)


@query
def record_conflicts(spark, folder):
    """Records of which some have a second version with other samples."""
    raw = _raw_records(spark, folder)
    other = raw.filter(F.col("n_samples") % 700 == 0).withColumns({
        "payload": F.encode(F.lit("other"), "UTF-8"), "src_path": F.concat("src_path", F.lit(".gz"))})
    found = R.record_conflicts(raw.unionByName(other))
    return found.withColumn("sources", F.array_join("sources", "|"))


@query
def manifest_again(spark, folder):
    """A manifest that grows by runs which overlap."""
    root = new_folder(spark, "manifest")
    chosen = select.select_near_complete(_all(spark, folder), "echo", SCALED)
    sink.write_manifest(chosen.filter(F.col("day") < F.lit(LATE_FROM).cast("date")), root, "append")
    sink.write_manifest(chosen, root, "append")
    return sink.read_manifest(spark, root).select(*FILE, "style", "year")


@query
def select_cascade_gecko(spark, folder):
    return select.select_cascade(_all(spark, folder), "gecko", SPARSE).select(*FILE, "rule")


@query
def day_plan_statuses(spark, folder):
    """A plan with days of every status: some hold ancillary files alone, some no known channel."""
    fifth = F.dayofmonth("day") % 5
    data = N.has_extension(F.col("name"), "archive")
    files = _all(spark, folder).filter(~data | (fifth != 0))
    recs = N.with_path_keys(_raw_records(spark, folder).drop("payload"), "src_path")
    recs = recs.withColumn("cha", F.when(fifth == 1, "DL1").otherwise(F.col("cha"))).drop("name", *DAY)
    params = SCALED.with_(first_type="none")
    days = archive.archive_days(files, params)
    known = classify.is_known_recorder(days)
    channels = rename.select_channels(archive.choose_records(recs, known.select(*DAY, "recorder", "keep"), params), params)
    present = days.filter(F.dayofmonth("day") == 7)
    return archive.day_plan(days, channels, present, params)


@query
def import_with_key_table(spark, folder):
    """The run, repeated, compared with a bucketed table of filed keys."""
    sds = new_folder(spark, "sds")
    table = "filed_keys_" + sds.rsplit("-", 1)[-1]
    files, recs = _all(spark, folder), _raw_records(spark, folder)
    for _ in range(2):
        archive.run_archive(spark, files, recs, sds, params=SCALED.with_(key_buckets=8), skip_present=False, key_table=table)
    return catalog.scan_sds(spark, sds).select(*_SDS_OUT)
