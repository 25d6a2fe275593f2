"""What a run notices about the days it files."""

from datetime import date, datetime, timedelta

from archivekit import Params
from archivekit.operators import checks
from archivekit.plans import archive
from helpers import keyed_records, listing, record, record_table, us_echo

P = Params(expected=4, threshold_missing=1, min_files=2)
DAY, NEXT = date(2023, 11, 24), date(2023, 11, 25)


def day_of(spark, day, stray=()):
    """Files of a day in the folder of STAA, those of the minutes `stray` named STBB, and their records."""
    names = [us_echo("STBB" if m in stray else "STAA", day, f"00{m:02}", "02") for m in range(4)]
    files = listing(spark, "STAA", day, names)
    rows = []
    for f in files.collect():
        minute = int(f["name"][13:15])
        start = datetime.combine(day, datetime.min.time()) + timedelta(minutes=minute)
        sta = "STBB" if minute in stray else "STAA"
        rows += [record(f"AB.{sta}.60.{c}", start, 6000, 100.0, src=f["path"]) for c in ("CHZ", "CHN", "CHE")]
    return files, rows


def test_a_run_reports_errant_names_and_records_of_the_days_it_files(spark, tmp_path):
    files, rows = day_of(spark, DAY, stray=(2,))
    more, others = day_of(spark, NEXT)
    found, log = str(tmp_path / "checks"), str(tmp_path / "runs")
    for _ in range(2):  # days filed already are not reported again
        archive.run_archive(
            spark, files.unionByName(more), record_table(spark, rows + others), str(tmp_path / "sds"),
            run_log=log, params=P, checks=found)
    got = spark.read.parquet(found).collect()
    assert len({r["run_ts"] for r in got}) == 1 and {(r["station_dir"], r["day"]) for r in got} == {("STAA", DAY)}
    by = {(r["finding"], r["item"]): r["n"] for r in got}
    assert by[(checks.ERRANT_NAME, "STBB")] == 1 and by[(checks.ERRANT_RECORD, "STBB")] == 3


def test_days_with_more_than_three_streams(spark):
    files, rows = day_of(spark, DAY)
    four = rows + [record("AB.STAA.60.CNZ", datetime(2023, 11, 24), 100, 100.0, src=rows[0][-1])]
    clean, many = (checks.day_checks(files, keyed_records(spark, r), keyed_records(spark, r), P) for r in (rows, four))
    assert clean.isEmpty()
    assert [(r["finding"], r["item"], r["n"]) for r in many.collect()] == [(checks.MANY_STREAMS, "", 4)]
    empty = keyed_records(spark, rows).limit(0)
    assert checks.day_checks(files.limit(0), empty, empty, P).isEmpty()
