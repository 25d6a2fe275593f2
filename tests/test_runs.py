"""Runs that meet late files, days that fail, replaced days, stored carry, stopped copies, tables of rules."""

import os
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from archivekit import Params, schemas
from archivekit.functions import names as N
from archivekit.operators import carry, changes, classify, filters, rejects, rename
from archivekit.plans import archive
from archivekit.sinks import archive as sink, commits, runlog
from archivekit.sources import catalog
from helpers import listing, record, record_table, us_echo, sp_echo

P = Params(expected=4, threshold_missing=1, min_files=2)
DAYS = [date(2023, 11, 20) + timedelta(i) for i in range(10)]
CHANNELS = ("CHZ", "CHN", "CHE")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def day_files(spark, day, names, station="STAA"):
    return listing(spark, station, day, names)


def day_records(files, payload=b"x", **more):
    out = []
    for f in files.collect():
        start = datetime.combine(f["day"], datetime.min.time()) + timedelta(hours=int(f["name"][11:13]), minutes=int(f["name"][13:15]))
        out += [record(f"AB.{f['station_dir']}.60.{c}", start, 6000, 100.0, payload, src=f["path"]) for c in CHANNELS]
    return out


def union(frames):
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def local(day, minutes):
    return [us_echo("STAA", day, f"00{m:02}", "02") for m in minutes]


def sent(day, minutes):
    return [sp_echo("STAA", day, f"00{m:02}", "02") for m in minutes]


# --- late files and replaced days ------------------------------------------------

def test_late_local_files_replace_what_their_day_filed(spark, tmp_path):
    sds, log = str(tmp_path / "sds"), str(tmp_path / "runs")
    first = union([day_files(spark, DAYS[0], sent(DAYS[0], range(4))), day_files(spark, DAYS[1], local(DAYS[1], range(4)))])
    rows = day_records(first)
    plan = archive.run_archive(spark, first, record_table(spark, rows), sds, run_log=log, params=P)
    assert {r["day"]: r["status"] for r in plan.collect()} == {DAYS[0]: "OK", DAYS[1]: "OK"}
    # The local copies come later, with other samples: the day is theirs alone then.
    late = day_files(spark, DAYS[0], local(DAYS[0], range(4)))
    both = first.unionByName(late)
    table = record_table(spark, rows + day_records(late, b"better"))
    plan = archive.run_archive(spark, both, table, sds, run_log=log, params=P)
    assert {r["day"]: r["status"] for r in plan.collect()} == {DAYS[0]: "OK", DAYS[1]: "PRESENT"}
    filed = catalog.scan_sds(spark, sds).collect()
    assert len(filed) == 24
    assert {bytes(r["payload"]) for r in filed if r["start_ts"].date() == DAYS[0]} == {b"better"}
    # Nothing changed since: nothing is due.
    plan = archive.run_archive(spark, both, table, sds, run_log=log, params=P)
    assert {r["status"] for r in plan.collect()} == {"PRESENT"}
    assert catalog.scan_sds(spark, sds).count() == 24


def test_changes_are_told_from_the_log(spark):
    now = union([day_files(spark, d, local(d, range(n))) for d, n in zip(DAYS, (1, 2, 3, 4))])
    days = changes.day_fingerprints(now)
    seen = {r["day"]: r for r in days.collect()}
    logged = [
        (datetime(2024, 1, 1), "STAA", DAYS[0], "echo", "OK", "", 1, seen[DAYS[0]]["fingerprint"]),
        (datetime(2024, 1, 1), "STAA", DAYS[1], "echo", "OK", "", 9, seen[DAYS[0]]["fingerprint"]),
        (datetime(2024, 1, 2), "STAA", DAYS[2], "echo", "FAILED", "", 3, seen[DAYS[2]]["fingerprint"]),
        (datetime(2024, 1, 2), "STAA", DAYS[3], "echo", "OK", "", None, None),
    ]
    got = changes.days_changed(days, spark.createDataFrame(logged, schemas.STORED_RUNS)).collect()
    assert {r["day"]: (r["change"], r["n_before"], r["n_files"]) for r in got} == {
        DAYS[0]: ("same", 1, 1), DAYS[1]: ("changed", 9, 2), DAYS[2]: ("new", None, 3), DAYS[3]: ("same", None, 4)}


def test_a_write_that_breaks_before_it_is_published_leaves_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "sds")
    rows = [record("VW.STAA.00.CHZ", datetime(2023, 1, 1, 0, m), 100) for m in range(3)]
    sink.write_sds(record_table(spark, rows[:1]), root)

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(commits, "publish", broken)
    with pytest.raises(RuntimeError):
        sink.write_sds(record_table(spark, rows), root)
    monkeypatch.undo()
    assert catalog.scan_sds(spark, root).count() == 1
    sink.write_sds(record_table(spark, rows), root)
    assert catalog.scan_sds(spark, root).count() == 3


def test_records_of_older_archives_count(spark, tmp_path, monkeypatch):
    """Files written before digests and runs were kept."""
    root, rows = str(tmp_path / "sds"), [record("VW.STAA.00.CHZ", datetime(2023, 1, 1, 0, m), 100) for m in range(2)]
    old = sink.assign_sds_day(record_table(spark, rows)).drop("digest", "run")
    old.write.partitionBy("year", "net", "sta", "cha", "doy").parquet(root)
    sink.write_sds(record_table(spark, rows), root)
    assert catalog.scan_sds(spark, root).count() == 2
    monkeypatch.setattr(commits, "LISTED_RUNS", 0)
    assert catalog.scan_sds(spark, root).count() == 2


# --- two-phase removal of copies ----------------------------------------------------

def test_bitmaps_hold_every_key(spark):
    keys = spark.range(0, 3000).select((F.col("id") * 7).alias("k"))
    for most in (1, 64):
        held = filters.with_may_hold(spark.range(0, 21000).withColumnRenamed("id", "k"), filters.key_bitmaps(keys, ["k"], P.with_(bitmaps=most)), ["k"], "hit")
        counts = {r["mine"]: (r["n"], r["hits"]) for r in held.groupBy((F.col("k") % 7 == 0).alias("mine")).agg(
            F.count("k").alias("n"), F.count_if("hit").alias("hits")).collect()}
        assert counts[True] == (3000, 3000) and counts[False][0] == 18000
        assert counts[False][1] < (2000 if most == 1 else 1200)


def test_payloads_are_neither_aggregated_nor_shuffled_unless_contested(spark, tmp_path):
    t = datetime(2023, 1, 1)
    rows = [record("VW.STAA.00.CHZ", t + timedelta(minutes=i), 100) for i in range(50)] + [record("VW.STAA.00.CHZ", t, 100)] * 2
    record_table(spark, rows).write.parquet(str(tmp_path / "r"))
    table = catalog.read_records(spark, str(tmp_path / "r"))
    none = table.withColumn("digest", F.lit(0).cast("bigint")).select(*sink.FILED_KEY).limit(0)
    fresh = sink.fresh_records(table, none)
    assert fresh.count() == 50
    plan = plan_of(fresh)
    # Bitmaps are built by one; no record passes through any.
    assert all("_bitmap" in line and "payload" not in line for line in plan.splitlines() if "SortAggregate" in line)
    # Records that are not contested reach the union straight from the scan.
    clean = plan.split("Union")[1].split("Window")[0]
    assert "payload" in clean and "Exchange hashpartitioning" not in clean
    unique = sink.fresh_records(table.dropDuplicates(["start_ts"]), none)
    assert "Window" not in plan_of(unique) and unique.count() == 50


def test_filed_keys_are_compared_where_they_lie(spark, tmp_path):
    from archivekit.sinks import keys

    settings, root, t = P.with_(key_buckets=4), str(tmp_path / "sds"), datetime(2023, 1, 1)
    rows = [record("VW.STAA.00.CHZ", t + timedelta(minutes=i), 100) for i in range(40)]
    # Filed before there was a table of keys, and by a run that was never published.
    sink.write_sds(record_table(spark, rows[:10]), root)
    write = lambda some: sink.write_sds(record_table(spark, some), root, params=settings, key_table="some_keys")
    write(rows[5:20])
    assert catalog.scan_sds(spark, root).count() == 20
    real = commits.publish
    commits.publish = lambda *args: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            write(rows[15:30])
    finally:
        commits.publish = real
    write(rows)
    assert catalog.scan_sds(spark, root).count() == 40
    # Another session finds the same files under the name.
    spark.sql("DROP TABLE some_keys")
    keys.open_keys(spark, "some_keys", root, settings)
    write(rows)
    assert catalog.scan_sds(spark, root).count() == 40
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    filed = keys.filed_keys(spark, "some_keys", root, [2023])
    own = record_table(spark, rows).select(*sink.RECORD_KEY).repartition(4, *sink.RECORD_KEY)
    counted = own.groupBy(*sink.RECORD_KEY).agg(F.count(F.lit(1)).alias("n"))
    held = filed.groupBy(*sink.RECORD_KEY).agg(F.collect_set("digest").alias("held"))
    plan = plan_of(counted.join(held, sink.RECORD_KEY, "left"))
    spark.conf.unset(key)
    side = plan[plan.index("FileScan") - 2000 :] if "FileScan" in plan else plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in side
    spark.sql("DROP TABLE some_keys")


# --- the run reads its own days --------------------------------------------------------

def test_a_run_reads_its_own_days_and_compares_with_its_own_folders(spark, tmp_path, monkeypatch):
    files = union([day_files(spark, d, local(d, range(3))) for d in DAYS[:3]])
    catalog.write_records(record_table(spark, day_records(files)), str(tmp_path / "records"))
    stored = catalog.read_records(spark, str(tmp_path / "records"), partitioned=True)
    seen = {}

    def look(records, root, years, folders, stations, *args):
        seen.update(plan=plan_of(records), years=years, stations=stations)

    monkeypatch.setattr(archive, "write_sds", look)
    archive.run_archive(spark, files, stored, str(tmp_path / "sds"), params=P, start=DAYS[1], end=DAYS[1], stations=["STAA"])
    assert (seen["years"], seen["stations"]) == ([2023], ["STAA"])
    scans = [line for line in seen["plan"].splitlines() if "payload" in line and "FileScan" in line]
    assert scans
    for scan in scans:
        pushed = scan.split("PushedFilters: [")[1]
        assert re.search(r"GreaterThanOrEqual\(day", pushed) and re.search(r"LessThanOrEqual\(day", pushed)
        assert "station_dir" in scan.split("PartitionFilters: [")[1].split("]")[0]
    monkeypatch.undo()
    root = str(tmp_path / "sds")
    archive.run_archive(spark, files, stored, root, params=P)
    assert catalog.scan_sds(spark, root).count() == 27
    sink.write_sds(record_table(spark, [record("VW.STBB.00.CHZ", datetime(2023, 1, 1), 100)]), root)
    read = catalog.scan_sds(spark, root, [2023], ["STAA"]).inputFiles()
    assert read and all("sta=STAA" in f for f in read)


def test_manifest_append_reads_its_years(spark, tmp_path):
    files = union([day_files(spark, d, local(d, range(2))) for d in (DAYS[0], date(2024, 1, 2))])
    sink.write_manifest(files, str(tmp_path / "m"))
    for _ in range(2):
        sink.write_manifest(files.filter(F.year("day") == 2024), str(tmp_path / "m"), "append")
    assert sink.read_manifest(spark, str(tmp_path / "m")).count() == 4


# --- days that fail alone ------------------------------------------------------------------

def test_one_bad_day_of_ten_fails_alone(spark, tmp_path):
    files = union([day_files(spark, d, local(d, range(3))) for d in DAYS])
    rows = day_records(files)
    bad = [r[:4] + (None,) + r[5:] if r[4].date() == DAYS[4] else r for r in rows]
    sds, log, lost = (str(tmp_path / n) for n in ("sds", "runs", "rejects"))
    plan = archive.run_archive(spark, files, record_table(spark, bad), sds, run_log=log, rejects=lost, params=P)
    assert {r["day"]: r["status"] for r in plan.collect()} == {d: "FAILED" if d == DAYS[4] else "OK" for d in DAYS}
    assert catalog.scan_sds(spark, sds).count() == 9 * 9
    runs = runlog.read_run_log(spark, log).collect()
    assert len(runs) == 10 and [r["detail"] for r in runs if r["status"] == "FAILED"] == [f"9 records rejected: {rejects.NO_START}"]
    assert {(r["day"], r["reason"]) for r in spark.read.parquet(lost).collect()} == {(DAYS[4], rejects.NO_START)}
    # Mended records: only the failed day is due.
    plan = archive.run_archive(spark, files, record_table(spark, rows), sds, run_log=log, rejects=lost, params=P)
    assert {r["day"] for r in plan.collect() if r["status"] == "OK"} == {DAYS[4]}
    assert catalog.scan_sds(spark, sds).count() == 90


def test_reasons(spark):
    t = datetime(2023, 1, 1)
    good = record("AB.S.00.CHZ", t, 100)
    rows = [good, good[:5] + (None,) + good[6:], good[:5] + (t - timedelta(1),) + good[6:], good[:6] + (None,) + good[7:], ("A/B", *good[1:])]
    got = [r[0] for r in record_table(spark, rows).select(rejects.reject_reason()).collect()]
    assert got == [None, rejects.NO_END, rejects.BACKWARDS, rejects.NO_SAMPLES, rejects.NO_FOLDER]


def test_a_failure_before_filing_is_logged_and_leaves_no_tables(spark, tmp_path, monkeypatch):
    from archivekit.operators import workspace

    files = day_files(spark, DAYS[0], local(DAYS[0], range(3)))
    folder = f"{workspace.shared_folder(spark)}/archivekit"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()

    def broken(*args):
        raise RuntimeError("no channels")

    monkeypatch.setattr(archive, "select_channels", broken)
    log = str(tmp_path / "runs")
    with pytest.raises(RuntimeError):
        archive.run_archive(spark, files, record_table(spark, day_records(files)), str(tmp_path / "s"), run_log=log, params=P)
    (row,) = runlog.read_run_log(spark, log).collect()
    assert row["status"] == "FAILED" and "no channels" in row["detail"]
    assert set(os.listdir(folder)) <= before


# --- stored carry ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def long_listing(spark):
    """Two stations over five months; some months decide nothing."""
    rows = []
    for s, family in (("STAA", "dmx"), ("STBB", "ms")):
        for i in range(0, 150, 3):
            day = date(2023, 1, 1) + timedelta(i)
            ext = family if i < 40 else "ms" if i > 100 and s == "STAA" else None
            rows += [(f"/a/{s}/continuous/{day:%Y/%m/%d}/{day:%Y-%m-%d}_0000_02_{s}.{e}", 1) for e in ([ext] if ext else ["dmx", "ms"])]
    return N.with_path_keys(spark.createDataFrame(rows, "path string, length long"))


@pytest.mark.parametrize("period", ["month", "week"])
def test_stored_carry_equals_the_whole_history(spark, long_listing, tmp_path, period):
    settings = Params(min_files=100, first_type="none")
    want = {(r["station_dir"], r["day"]): r["recorder"] for r in classify.recorder_type(long_listing, settings).collect()}
    path = str(tmp_path / "carry")
    carry.write_carry(long_listing.filter("day < '2023-03-01'"), path, settings, period)
    carry.write_carry(long_listing, path, settings, period)
    summaries = carry.read_carry(spark, path)
    for start in (date(2023, 1, 1), date(2023, 2, 20), date(2023, 4, 30), date(2023, 5, 2)):
        got = carry.recorder_type_stored(long_listing, summaries, start, settings, period)
        assert {(r["station_dir"], r["day"]): r["recorder"] for r in got.collect()} == {k: v for k, v in want.items() if k[1] >= start}
    # What comes into each period is what the day before it carried.
    for r in carry.carried_into(summaries).collect():
        earlier = [k for k in want if k[0] == r["station_dir"] and k[1] < r["period"]]
        assert (r["carried"] or "none") == (want[max(earlier)] if earlier else "none")


def test_a_run_with_stored_carry_reads_its_own_months(spark, long_listing, tmp_path, monkeypatch):
    settings, path = Params(min_files=100), str(tmp_path / "carry")
    carry.write_carry(long_listing, path, settings)
    catalog.write_catalog(long_listing.withColumn("modified", F.lit(None).cast("timestamp")), str(tmp_path / "c"))
    stored = catalog.read_catalog(spark, str(tmp_path / "c"))
    days = archive._decided_days(spark, stored, date(2023, 4, 20), date(2023, 5, 3), settings, None, path)
    scan = next(line for line in plan_of(days).splitlines() if "FileScan" in line and "station_dir" in line and "modified" in line)
    assert "GreaterThanOrEqual(day,2023-04-01)" in scan
    whole = archive._decided_days(spark, stored, date(2023, 4, 20), date(2023, 5, 3), settings, None, None)
    facts = lambda df: sorted((r["station_dir"], r["day"], r["recorder"], r["keep"]) for r in df.collect())
    assert facts(days) == facts(whole) and facts(days)


# --- copies that stop ----------------------------------------------------------------------------

def test_a_stopped_copy_goes_on(spark, tmp_path, monkeypatch):
    source, target, log = (str(tmp_path / n) for n in ("a", "b", "log"))
    rows = [record("VW.STAA.00.CHZ", datetime(2023, 1, 1) + timedelta(days=d, minutes=m), 100) for d in range(5) for m in range(2)]
    sink.write_sds(record_table(spark, rows), source)
    real, calls = sink.write_sds, []

    def stops(*args, **kwargs):
        calls.append(args)
        if len(calls) == 3:
            raise RuntimeError("stopped")
        real(*args, **kwargs)

    monkeypatch.setattr(sink, "write_sds", stops)
    copy = lambda: sink.rehome_archive(spark, source, target, "VW.*.*.*:VX.-.-.-", progress=log, step_days=1)
    with pytest.raises(RuntimeError):
        copy()
    assert sorted(r["doy"] for r in sink.read_progress(spark, log).collect()) == [1, 2]
    calls.clear()
    calls.extend([()] * 3)
    copy()
    assert len(calls) == 6
    got = sink.read_progress(spark, log).collect()
    assert {(r["doy"], r["n_in"], r["n_out"]) for r in got} == {(d, 2, 2) for d in range(1, 6)}
    assert catalog.scan_sds(spark, target).filter("net = 'VX'").count() == 10
    # A source day that grew is copied again, and nothing else.
    real(record_table(spark, [record("VW.STAA.00.CHZ", datetime(2023, 1, 3, 5), 100)]), source)
    calls.clear()
    calls.extend([()] * 3)
    copy()
    assert len(calls) == 4 and catalog.scan_sds(spark, target).count() == 11


# --- rules as a table ----------------------------------------------------------------------------------

RULES = "ord int, src struct<net:string,sta:string,loc:string,cha:string>, dst struct<net:string,sta:string,loc:string,cha:string>"


def test_ten_thousand_rules_join_by_equality(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    rules = [(i, ("*", f"S{i % 3000:04}", "*", ("CHZ", "*", "CHN")[i % 3]), ("VX", "-", f"{i % 100:02}", "-")) for i in range(10_000)]
    rules += [(20_000, ("*", "*", "*", "*"), ("ZZ", "-", "-", "-"))]
    table = spark.createDataFrame(rules, RULES)
    t = datetime(2023, 1, 1)
    rows = [record(f"AB.S{i % 4000:04}.00.{c}", t + timedelta(minutes=i), 100) for i in range(300) for c in ("CHZ", "CHE")]
    rows += [(None, "S0007", None, "CHZ", t, t, 1, 1.0, b"", "p")]
    want = []
    for r in rows:
        codes = [c or "" for c in r[:4]]
        _, _, dst = next(x for x in rules if all(p in ("*", c) for p, c in zip(x[1], codes)))
        want.append(tuple(own if d == "-" else d for d, own in zip(dst, r[:4])))
    spark.conf.set(threshold, "-1")
    got = rename.rename_by_table(record_table(spark, rows), table)
    plan = plan_of(got)
    spark.conf.unset(threshold)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    found = sorted(((r["net"], r["sta"], r["loc"] or "", r["cha"]) for r in got.collect()), key=str)
    assert found == sorted(((n, s, x or "", c) for n, s, x, c in want), key=str)


def test_no_rules_change_nothing(spark):
    rows = record_table(spark, [record("AB.S.00.CHZ", datetime(2023, 1, 1), 100)])
    assert rename.rename_by_table(rows, spark.createDataFrame([], RULES)).collect() == rows.collect()


# --- walks ------------------------------------------------------------------------------------------------

def test_a_walk_from_any_root_equals_a_local_walk(spark, tmp_path):
    for folder, names in {
        "": ["readme.txt"], "ST1/continuous/2023/01/05": ["a.dmx", "b c.dmx", "_hidden"], "net/deep/er/ST2/continuous/2023/1/6": ["x.ms"],
        "ST1/continuous/2023/01": ["stray.dmx"], "empty/folder": [], "ST 3/continuous/2023/02/07": ["é.dmx"],
    }.items():
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        for n in names:
            (tmp_path / folder / n).write_bytes(b"1" * (n != "x.ms"))
    want = sorted(os.path.join(d, f) for d, _, fs in os.walk(tmp_path) for f in fs)
    got = catalog.walk_folders(spark, str(tmp_path))
    assert sorted(r["path"] for r in got.collect()) == want
    assert got.filter("length = 0").count() == 1
    found = {(r["station_dir"], r["day"]) for r in catalog.catalog(got).collect()}
    assert found == {("ST1", date(2023, 1, 5)), ("ST2", date(2023, 1, 6)), ("ST 3", date(2023, 2, 7))}
    with pytest.raises(ValueError):
        catalog.walk_folders(spark, str(tmp_path), levels=3)
