"""Runs that repeat or fail, records with blank names or conflicting samples, odd listings."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from archivekit import schemas
from archivekit.functions import names as N
from archivekit.operators import records as R, select, workspace
from archivekit.params import Params
from archivekit.plans import archive
from archivekit.sinks import archive as sink, runlog
from archivekit.sources import catalog
from helpers import listing

DAY = date(2023, 11, 24)
FOLDER = "/data/archive/STAA/continuous/2023/11/24"
LOCAL, SENT = f"{FOLDER}/2023-11-24_0001_02_STAA.dmx", f"{FOLDER}/2023-11-24 0001 02 STAA.dmx"


def record(path, net="AB", sta="STAA", cha="DLZ", payload=b"a", minute=1):
    start = datetime(2023, 11, 24, 0, minute)
    return (net, sta, "60", cha, start, start.replace(second=50), 5000, 100.0, payload, path)


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.RECORDS)


def test_conflicting_samples_are_both_filed_and_reported(spark, tmp_path):
    rows = frame(spark, [record(SENT, payload=b"x"), record(LOCAL, payload=b"y"), record(LOCAL, minute=2), record(SENT, minute=2)])
    for _ in range(2):
        sink.write_sds(rows, str(tmp_path))
    filed = catalog.scan_sds(spark, str(tmp_path)).select("start_ts", "payload", "src_path").collect()
    assert sorted(bytes(r["payload"]) for r in filed) == [b"a", b"x", b"y"]
    # Of equal records the local copy stays.
    assert [r["src_path"] for r in filed if bytes(r["payload"]) == b"a"] == [LOCAL]
    conflict = R.record_conflicts(rows).collect()
    assert [(r["versions"], r["sources"]) for r in conflict] == [(2, sorted([LOCAL, SENT]))]


def test_blank_names_are_filed_once(spark, tmp_path):
    rows = frame(spark, [record(LOCAL, net=None), record(LOCAL, sta="", minute=2), record(LOCAL, cha=" ", minute=3)])
    for _ in range(3):
        sink.write_sds(rows, str(tmp_path))
    filed = catalog.scan_sds(spark, str(tmp_path))
    assert filed.count() == 3
    assert filed.filter(F.col("net") == schemas.BLANK).count() == 1


def test_manifest_holds_a_file_once(spark, tmp_path):
    files = select._styled(N.with_path_keys(spark.createDataFrame(
        [(LOCAL, 1, datetime(2023, 11, 24)), (SENT, 1, datetime(2023, 11, 24))], "path string, length long, modified timestamp")))
    for _ in range(2):
        sink.write_manifest(files, str(tmp_path / "m"), "append")
    assert sink.read_manifest(spark, str(tmp_path / "m")).count() == 2


def _run(spark, tmp_path, **more):
    names = [f"2023-11-24_00{m:02}_02_STAA.dmx" for m in range(3)]
    files = listing(spark, "STAA", DAY, names)
    rows = frame(spark, [record(f"{FOLDER}/{n}", minute=m) for m, n in enumerate(names)])
    table = str(tmp_path / "records")
    catalog.write_records(rows, table, "overwrite")
    stored = catalog.read_records(spark, table, partitioned=True)
    settings = Params(expected=3, threshold_missing=1, min_files=1)
    return archive.run_archive(
        spark, files, stored, str(tmp_path / "sds"), run_log=str(tmp_path / "runs"), day_logs=str(tmp_path / "days"),
        params=settings, start=DAY, end=DAY, **more)


def test_failed_filing_is_logged_and_raised(spark, tmp_path, monkeypatch):
    def broken(*args, **kwargs):
        raise RuntimeError("disk full")

    monkeypatch.setattr(archive, "write_sds", broken)
    for _ in range(2):
        with pytest.raises(RuntimeError):
            _run(spark, tmp_path)
    monkeypatch.undo()
    _run(spark, tmp_path)
    runs = runlog.read_run_log(spark, str(tmp_path / "runs"))
    assert sorted(r["status"] for r in runs.collect()) == ["FAILED", "FAILED", "OK"]
    lines = spark.read.parquet(str(tmp_path / "days"))
    report = runlog.crash_report(runs, lines).collect()
    # Each failure has the five lines of its own run.
    assert len(report) == 10 and all("disk full" in r["error"] for r in report)


def test_a_run_reads_its_own_folders(spark, tmp_path, monkeypatch):
    seen = {}

    def look(records, *args, **kwargs):
        seen["plan"] = records._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(archive, "write_sds", look)
    _run(spark, tmp_path, stations=["STAA"])
    scans = [line for line in seen["plan"].splitlines() if "payload" in line and "FileScan" in line]
    assert scans and all("PartitionFilters: [" in s and "year" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_folders_of_one_digit_are_listed(spark, tmp_path):
    for day in ("2023/2/3", "2023/02/04", "2023/3/1", "2023/x/1"):
        folder = tmp_path / "S" / "continuous" / day
        folder.mkdir(parents=True)
        (folder / "a.dmx").write_bytes(b"1")
    found = catalog.scan_day_folders(spark, str(tmp_path), ["S", "T"], "2023-02-01", "2023-02-28")
    assert sorted(r["path"][-14:] for r in found.collect()) == sorted(["/2023/2/3/a.dmx"[-14:], "2023/02/04/a.dmx"[-14:]])


def test_crowded_gecko_day_keeps_its_local_files(spark):
    names = [f"20231124_{m // 60:02}{m % 60:02}_STAA.ms.zip" for m in range(8)] + ["2023-11-24 0010 STAA.ms.zip"]
    kept = select.select_cascade(listing(spark, "STAA", DAY, names), "gecko", Params(expected=4, threshold_missing=1))
    assert kept.count() == 9 and {r["rule"] for r in kept.collect()} == {"patched"}


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    assert workspace.shared_folder(spark)

    class Elsewhere:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master, applicationId = "spark://host:7077", "x"

    with pytest.raises(ValueError):
        workspace.shared_folder(Elsewhere)
