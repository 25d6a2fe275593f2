"""Real folders: listing, members, manifest, the run and its log."""

import io
import zipfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from archivekit import Params, schemas
from archivekit.plans import archive
from archivekit.sinks import archive as sink, runlog
from archivekit.sources import catalog, members

from helpers import listing, names, record, record_table

P = Params(expected=3, threshold_missing=0, min_files=2)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("archive root")
    day = root / "RDK1" / "continuous" / "2021" / "09" / "26"
    day.mkdir(parents=True)

    def packed(*entries):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in entries:
                z.writestr(name, data)
        return out.getvalue()

    (day / "2021-09-26 0004_RDK1.ms.zip").write_bytes(packed(("2021-09-26 0004_RDK1.ms", b"abc")))
    (day / "20210926_0005_RDK1.ms.zip").write_bytes(
        packed(("20210926_0005_RDK1.ms", b"defg"), ("RDK1.1.ss", b"s")))
    (day / "2021-09-26 0006 07 RDK1.ss").write_bytes(b"s")
    (day / "2021-09-26 0007 07 RDK1.ms").write_bytes(b"")
    (root / "RDK1" / "readme.txt").write_text("x")
    return root


def test_listing_reads_no_contents(spark, tree):
    files = catalog.catalog(catalog.scan_files(spark, f"file:{tree}"))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    assert names(files) == ["2021-09-26 0004_RDK1.ms.zip", "2021-09-26 0006 07 RDK1.ss", "20210926_0005_RDK1.ms.zip"]
    assert {(r["station_dir"], r["day"]) for r in files.collect()} == {("RDK1", date(2021, 9, 26))}


def test_listing_inside_tasks(spark, tree):
    files = catalog.catalog(catalog.scan_day_folders(
        spark, str(tree), ["RDK1", "NONE"], "2021-09-20", "2021-09-30"))
    # This listing sees the empty file too.
    assert names(files) == [
        "2021-09-26 0004_RDK1.ms.zip", "2021-09-26 0006 07 RDK1.ss",
        "2021-09-26 0007 07 RDK1.ms", "20210926_0005_RDK1.ms.zip"]
    sizes = {r["name"]: r["length"] for r in files.collect()}
    assert sizes["2021-09-26 0007 07 RDK1.ms"] == 0 and sizes["2021-09-26 0006 07 RDK1.ss"] == 1
    assert files.filter("modified > timestamp'2020-01-01'").count() == 4


def test_record_table_is_read_under_a_fixed_schema(spark, tmp_path):
    record_table(spark, [record("AB.STAA.60.DLZ", datetime(2023, 1, 1), 100)]).write.parquet(str(tmp_path / "r"))
    df = catalog.read_records(spark, str(tmp_path / "r"))
    assert df.schema == schemas.RECORDS and df.count() == 1


def test_members_of_chosen_files(spark, tree):
    files = catalog.catalog(catalog.scan_files(spark, f"file:{tree}"))
    chosen = archive.choose_files(files, archive.archive_days(files, P), P)
    folder = f"file:{tree}/RDK1/continuous/2021/09/26"
    got = members.expand_members(members.load_contents(spark, chosen, [folder], "gecko", P))
    rows = members.member_order(got).collect()
    assert sorted((r["member"], r["member_size"]) for r in rows) == [
        ("2021-09-26 0004_RDK1.ms", 3), ("20210926_0005_RDK1.ms", 4)]


def test_catalog_and_manifest_round_trip(spark, tree, tmp_path):
    files = catalog.catalog(catalog.scan_files(spark, f"file:{tree}"))
    catalog.write_catalog(files, str(tmp_path / "catalog"))
    again = catalog.read_catalog(spark, str(tmp_path / "catalog"))
    assert names(again) == names(files)
    assert again.schema["station_dir"].dataType.simpleString() == "string"
    sink.write_manifest(files, str(tmp_path / "manifest"))
    assert names(sink.read_manifest(spark, str(tmp_path / "manifest"))) == names(files)


def test_numeric_station_names_stay_text(spark, tmp_path):
    root = str(tmp_path / "sds")
    sink.write_sds(record_table(spark, [record("AB.0012.00.CHZ", datetime(2023, 1, 1), 100)]), root)
    row = catalog.scan_sds(spark, root).first()
    assert (row["sta"], row["loc"], row["doy"]) == ("0012", "00", 1)


def test_channel_year_folders_hold_the_same_archive(spark, tmp_path):
    root, t = str(tmp_path / "sds"), datetime(2023, 1, 1)
    recs = record_table(spark, [record("AB.STAA.00.CHZ", t + timedelta(hours=i), 100) for i in range(48)])
    for _ in range(2):
        sink.write_sds(recs, root, folders=["year", "net", "sta", "cha"])
    filed = catalog.scan_sds(spark, root, years=[2023])
    assert {r["doy"]: r["count"] for r in filed.groupBy("doy").count().collect()} == {1: 24, 2: 24}
    assert filed.schema["sta"].dataType.simpleString() == "string"


@pytest.fixture(scope="module")
def small_archive(spark):
    """Three days of one station: complete local, mixed, and nothing usable."""
    d = [date(2023, 11, 24) + timedelta(i) for i in range(3)]
    us = lambda i, m: f"{d[i]:%Y-%m-%d}_{m}_02_STAA.dmx"
    sp = lambda i, m: f"{d[i]:%Y-%m-%d} {m} 02 STAA.dmx"
    files = listing(spark, "STAA", d[0], [us(0, "0000"), us(0, "0001"), us(0, "2359"), sp(0, "0001")])
    files = files.unionByName(listing(spark, "STAA", d[1], [us(1, "0000"), sp(1, "0005")]))
    files = files.unionByName(listing(spark, "STAA", d[2], [f"{d[2]:%Y-%m-%d}_0000_02_STAA.trig.dmx"]))
    rows = []
    for f in files.collect():
        hhmm = f["name"][11:15]
        start = datetime.combine(f["day"], datetime.min.time()) + timedelta(
            hours=int(hhmm[:2]), minutes=int(hhmm[2:]), seconds=2)
        if hhmm == "2359":
            start += timedelta(seconds=61)  # this file spills into the next day
        for c in ("DLZ", "DLN", "DLE", "DNZ", "DNN", "DNE"):
            rows.append(record(f"AB.STAA.60.{c}", start, 6000, 100.0, src=f["path"]))
    return files, record_table(spark, rows)


def test_a_run_files_chosen_records_once(spark, small_archive, tmp_path):
    files, recs = small_archive
    sds, log, manifest = (str(tmp_path / n) for n in ("sds", "runs", "manifest"))
    plan = archive.run_archive(spark, files, recs, sds, run_log=log, manifest=manifest, params=P)
    assert {r["day"].day: (r["recorder"], r["n_selected"], r["n_rules"], r["status"]) for r in plan.collect()} == {
        24: ("echo", 3, 3, "OK"), 25: ("echo", 2, 3, "OK"), 26: ("echo", 0, 0, "EMPTY")}
    filed = catalog.scan_sds(spark, sds)
    assert filed.count() == 15
    assert {(r["net"], r["sta"], r["loc"], r["cha"]) for r in filed.collect()} == {
        ("VW", "STAA", "00", f"CH{c}") for c in "ZNE"}
    assert {r["doy"]: r["count"] for r in filed.groupBy("doy").count().collect()} == {328: 6, 329: 9}
    assert sink.read_manifest(spark, manifest).count() == 5

    again = archive.run_archive(spark, files, recs, sds, run_log=log, params=P)
    assert {r["day"].day: r["status"] for r in again.collect()} == {24: "PRESENT", 25: "PRESENT", 26: "EMPTY"}
    archive.run_archive(spark, files, recs, sds, params=P, skip_present=False)
    assert catalog.scan_sds(spark, sds).count() == 15
    summary = {r["status"]: r["n_days"] for r in runlog.run_summary(runlog.read_run_log(spark, log)).collect()}
    assert summary == {"OK": 2, "EMPTY": 2}


def test_a_day_with_spilled_records_is_still_processed(spark, small_archive, tmp_path):
    files, recs = small_archive
    sds, log = str(tmp_path / "sds"), str(tmp_path / "runs")
    archive.run_archive(spark, files, recs, sds, run_log=log, params=P, end="2023-11-24")
    assert catalog.scan_sds(spark, sds).filter("doy = 329").count() == 3
    archive.run_archive(spark, files, recs, sds, run_log=log, params=P)
    assert catalog.scan_sds(spark, sds).count() == 15


def test_sliced_joins_give_the_same_run(spark, small_archive, tmp_path):
    files, recs = small_archive
    sds = str(tmp_path / "sds")
    archive.run_archive(spark, files, recs, sds, params=P.with_(broadcast_rows=0))
    assert catalog.scan_sds(spark, sds).count() == 15


def test_days_without_rules_are_reported(spark, small_archive, tmp_path):
    files, recs = small_archive
    odd = recs.withColumn("cha", F.lit("DL1"))
    log, logs = str(tmp_path / "runs"), str(tmp_path / "logs")
    plan = archive.run_archive(
        spark, files, odd, str(tmp_path / "sds"), run_log=log, day_logs=logs, params=P)
    assert {r["day"].day: r["status"] for r in plan.collect()} == {24: "NO_RULES", 25: "NO_RULES", 26: "EMPTY"}
    lines = spark.read.schema(schemas.LOG_LINES).parquet(logs)
    report = runlog.crash_report(runlog.read_run_log(spark, log), lines, P.with_(tail_lines=2))
    assert sorted((r["day"].day, r["line"]) for r in report.collect()) == [
        (24, "Rename rules: 0"), (24, "Status: NO_RULES"), (25, "Rename rules: 0"), (25, "Status: NO_RULES")]


def test_rehoming_renames_and_makes_unique(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    t = datetime(2023, 1, 1)
    rows = [record("VW.STAA.00.CHZ", t + timedelta(minutes=i), 100) for i in range(3)]
    sink.write_sds(record_table(spark, rows), source)
    sink.rehome_archive(spark, source, target, "VW.*.*.*:VX.-.-.-", doy=1)
    sink.rehome_archive(spark, source, target, "VW.*.*.*:VX.-.-.-")
    got = catalog.scan_sds(spark, target)
    assert got.count() == 3 and got.filter("net = 'VX'").count() == 3


def test_failure_report_holds_the_last_lines(spark):
    day = date(2023, 1, 1)
    lines = spark.createDataFrame(
        [(s, day, i, f"line {i}") for s in ("A", "B") for i in range(40)], schemas.LOG_LINES)
    runs = spark.createDataFrame(
        [(datetime(2023, 1, 2), "A", day, "echo", "FAILED", "exit 1"),
         (datetime(2023, 1, 2), "B", day, "echo", "OK", "")], schemas.RUNS)
    report = runlog.crash_report(runs, lines).orderBy("line_no").collect()
    assert [r["line_no"] for r in report] == list(range(10, 40))
    assert {r["station"] for r in report} == {"A"}
    text = runlog.run_lines(runs.filter("station = 'A'")).first()["line"]
    assert text == "2023-01-02T00:00:00Z | 2023-01-01 | echo | Status: FAILED"
