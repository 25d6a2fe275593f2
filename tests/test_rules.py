"""Rules that are easy to get wrong, one test each."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from archivekit import Params
from archivekit.functions import names as N
from archivekit.operators import classify, records as R, rename, select, stamps
from archivekit.sources import catalog

from helpers import (
    DAY0, keyed_records, listing, minutes, names, record, record_table, sp_echo, us_echo,
)


def test_the_minute_is_not_the_year(spark):
    two = [us_echo("STAA", DAY0, "2057", "02"), sp_echo("STAA", DAY0, "2058", "02")]
    assert names(select.select_per_minute(listing(spark, "STAA", DAY0, two))) == sorted(two)


def test_parent_folders_do_not_decide(spark):
    rows = [(f"/my data/trig_set_x/STAA/continuous/2023/11/24/{sp_echo('STAA', DAY0, '0001', '02')}", 1)]
    files = N.with_path_keys(spark.createDataFrame(rows, "path string, length bigint"))
    kept = select.select_near_complete(files, "echo").first()
    assert kept["style"] == "spaced" and kept["station_dir"] == "STAA"


def test_mseed_is_ignored_zipped_or_not(spark):
    files = listing(spark, "STAA", DAY0, ["2023-11-24 0001 02 STAA.mseed.ms", "2023-11-24 0001 02 STAA.ms"])
    assert names(select.valid_files(files, "gecko")) == ["2023-11-24 0001 02 STAA.ms"]


def test_station_names_with_ss_are_not_ancillary(spark):
    files = listing(spark, "MOSS", DAY0, ["2023-11-24 0001 02 MOSS.ms.zip", "2023-11-24 0001 02 MOSS.ss"])
    hist = stamps.stamp_histogram(files, "spaced_gecko").collect()
    assert [(r["stamp"], r["n"]) for r in hist] == [("02", 1)]


def test_empty_reports_count_nothing(spark):
    files = listing(spark, "STAA", DAY0, ["2023-11-24 0001 02 STAA.dmx"])
    assert stamps.stamp_histogram(files, "underscored_gecko").count() == 0
    assert stamps.total_considered(files, "underscored_gecko").first()["n_considered"] == 0


def test_per_channel_names_give_their_station(spark):
    token = lambda n: spark.range(1).select(
        N.station_token(F.lit(n), "gecko").alias("t")).first()["t"]
    assert token("2017-10-05 0000 58 DDNE_CHE.mseed") == "DDNE"
    assert token("20231029_0001_ABM1Y.ms.zip") == "ABM1Y"


def test_unclear_names_stay_only_on_mixed_incomplete_days(spark):
    odd = "2023-11-24-0003_STAA.ms"
    us, sp = "20231124_0001_STAA.ms", "2023-11-24 0002 00 STAA.ms"
    kept = lambda some: names(select.select_near_complete(
        listing(spark, "STAA", DAY0, some), "gecko"))
    assert kept([odd, us, sp]) == sorted([odd, us, sp])
    assert kept([odd, us]) == [us]
    assert kept([odd, sp]) == [sp]
    assert kept([odd]) == []


@pytest.mark.parametrize("n_local, kept", [(1380, 1380), (1379, 1389)])
def test_near_complete_boundary(spark, n_local, kept):
    some = [us_echo("STAA", DAY0, m, "02") for m in minutes(n_local)]
    some += [sp_echo("STAA", DAY0, m, "02") for m in minutes(10)]
    files = listing(spark, "STAA", DAY0, some)
    assert select.select_near_complete(files, "echo").count() == kept
    assert select.select_near_complete_v0(files).count() == kept


def test_dmx_does_not_hide_an_ms_minute(spark):
    two = [us_echo("STAA", DAY0, "0001", "02"), "2023-11-24 0001 00 STAA.ms.zip"]
    assert names(select.select_per_minute(listing(spark, "STAA", DAY0, two))) == sorted(two)


def test_grid_drops_triggered_and_impossible_minutes(spark):
    some = ["2023-11-24_0001_02_STAA.trig.dmx", "2023-11-24 0001 02 STAA.dmx", "2023-11-24 2575 02 STAA.dmx"]
    files = listing(spark, "STAA", DAY0, some)
    assert names(select.select_per_minute(files, grid=True)) == ["2023-11-24 0001 02 STAA.dmx"]
    assert names(select.select_per_minute(files)) == ["2023-11-24_0001_02_STAA.trig.dmx"]


def test_ties_go_to_the_largest(spark):
    some = [us_echo("STAA", DAY0, m, s) for m, s in zip(minutes(4), ("07", "31", "07", "31"))]
    files = listing(spark, "STAA", DAY0, some)
    assert stamps.stamp_mode(files).first()["stamp"] == "31"
    some = [us_echo(s, DAY0, "0001", "02") for s in ("AAAA", "BBBB")]
    assert classify.majority_station(listing(spark, "X", DAY0, some)).first()["station"] == "BBBB"


def test_folder_name_that_is_no_station(spark):
    files = listing(spark, "upload-3", DAY0, [us_echo("AAAA", DAY0, "0001", "02")])
    assert classify.resolve_station(files).first()["station"] == "AAAA"
    files = listing(spark, "upload-3", DAY0, ["readme.txt"])
    assert classify.resolve_station(files).first()["station"] == "UNKNOWN"
    files = listing(spark, "CCCC", DAY0, [us_echo("AAAA", DAY0, "0001", "02")])
    assert classify.resolve_station(files).first()["station"] == "CCCC"
    assert classify.errant_station(N.parse_name(files)).count() == 1


def test_exactly_full_local_days_are_taken_whole(spark):
    some = [us_echo("STAA", DAY0, m, "02") for m in minutes(1439)] + ["a_b_cc_d.dmx"]
    files = listing(spark, "STAA", DAY0, some)
    assert select.select_by_stamp(files).count() == 1440
    assert select.select_by_stamp(listing(spark, "STAA", DAY0, some[1:])).count() == 1438


@pytest.mark.parametrize("us, sp, rule, kept", [
    (1400, 1440, "local", 1400),
    (100, 1440, "telemetered", 1440),
    (700, 1000, "patched", 1000),
])
def test_cascade_rules(spark, us, sp, rule, kept):
    some = [us_echo("STAA", DAY0, m, "02") for m in minutes(us)]
    some += [sp_echo("STAA", DAY0, m, "02") for m in minutes(sp)]
    files = listing(spark, "STAA", DAY0, some)
    assert select.cascade_plan(files).first()["rule"] == rule
    assert select.select_cascade(files).count() == kept


def test_cascade_sums_common_stamps_and_patches(spark):
    some = [us_echo("STAA", DAY0, m, "02") for m in minutes(720)]
    some += [us_echo("STAA", DAY0, m, "31") for m in minutes(720, 720)]
    some += [us_echo("STAA", DAY0, m, f"{s:02d}") for s in range(40, 50) for m in minutes(9)]
    files = listing(spark, "STAA", DAY0, some)
    assert select.cascade_plan(files).first()["rule"] == "stamps"
    assert select.select_cascade(files).count() == 1440
    scattered = [us_echo("STAA", DAY0, m, "02") for m in minutes(1000)]
    scattered += [f"2023-11-24_{m}_{s:02d}_STA{s}.dmx" for s in range(60) for m in minutes(9, 1000)]
    scattered += [sp_echo("STAA", DAY0, m, "02") for m in minutes(1100)]
    files = listing(spark, "STAA", DAY0, scattered)
    rows = select.select_cascade(files)
    assert rows.first()["rule"] == "stamps_patched"
    # 1000 at stamp 02 and the nine more that share it, then 91 telemetered minutes.
    assert rows.filter(F.col("style") == "underscored").count() == 1009
    assert rows.filter(F.col("style") == "spaced").count() == 91


@pytest.mark.parametrize("mode, want", [
    ("content", {"d": "DAY", "m": "MONTH", "y": "YEAR"}),
    ("name", {"d": "DAY", "m": "MONTH", "y": "YEAR"}),
    ("count", {"d": "DAY", "m": "YEAR", "y": "YEAR"}),
])
def test_archive_level(spark, mode, want):
    files = listing(spark, "STAA", DAY0, [us_echo("STAA", DAY0, "0001", "02")])
    got = {r["folder"]: r["level"] for r in classify.archive_level(files, mode).collect()}
    root = "/data/archive/STAA/continuous/2023"
    below = {f: level for f, level in got.items() if f.startswith(root)}
    assert below == {f"{root}/11/24": want["d"], f"{root}/11": want["m"], root: want["y"]}
    # The station and all above it have rows too.
    assert {"/data", "/data/archive", "/data/archive/STAA", "/data/archive/STAA/continuous"} <= set(got)


def test_full_month_by_count_and_folder_without_data(spark):
    days = [date(2023, 11, 1) + timedelta(d) for d in range(28)]
    rows = [(f"/r/STAA/continuous/{d:%Y/%m/%d}/x.dmx", 1) for d in days] + [("/r/docs/readme.txt", 1)]
    files = N.with_path_keys(spark.createDataFrame(rows, "path string, length bigint"))
    got = {r["folder"]: r["level"] for r in classify.archive_level(files, "count").collect()}
    assert got["/r/STAA/continuous/2023/11"] == "MONTH"
    assert got["/r/docs"] == "UNKNOWN"


def test_missing_minutes(spark):
    files = listing(spark, "STAA", DAY0, [us_echo("STAA", DAY0, m, "02") for m in minutes(1438, 1)])
    assert sorted(r["minute"] for r in select.missing_minutes(files).collect()) == [0, 1439]
    assert select.missing_minute_counts(files).first()["n_missing"] == 2
    nothing = listing(spark, "STAA", DAY0, ["readme.txt"])
    assert select.missing_minutes(nothing).count() == 1440
    assert select.missing_minute_counts(nothing).first()["n_missing"] == 1440


def test_three_streams_keep_their_accelerometers(spark):
    t = datetime(2023, 11, 24, 1, 0)
    recs = keyed_records(spark, [record(f"AB.STAA.60.DN{c}", t, 100) for c in "ZNE"])
    assert rename.channel_spec(rename.select_channels(recs)).first()["spec"] == "DN?"


def test_streams_of_another_base_are_not_filed(spark):
    t = datetime(2023, 11, 24, 1, 0)
    recs = keyed_records(spark, [record(f"AB.STAA.60.{c}", t, 100) for c in ("DLZ", "DLE", "EHZ")])
    got = rename.apply_rename(recs, rename.select_channels(recs)).collect()
    assert sorted(r["cha"] for r in got) == ["CHE", "CHZ"]


def test_short_codes_count_as_vertical(spark):
    t = datetime(2023, 11, 24, 1, 0)
    recs = keyed_records(spark, [record("AB.STAA.60.DZ", t, 100)])
    assert rename.build_rename_rules(rename.select_channels(recs)).first()["dst"] == "VW.STAA.00.CHZ"


def test_dedup_prefers_the_smallest_source_and_can_compare_samples(spark):
    t = datetime(2023, 11, 24, 1, 0)
    rows = [record("AB.STAA.60.DLZ", t, 100, payload=p, src=s)
            for p, s in ((b"a", "/b"), (b"a", "/a"), (b"c", "/c"))]
    recs = record_table(spark, rows)
    assert [r["src_path"] for r in R.dedup_records(recs).collect()] == ["/a"]
    assert sorted(r["src_path"] for r in R.dedup_records(recs, compare_payload=True).collect()) == ["/a", "/c"]


def test_date_ranges(spark):
    files = listing(spark, "STAA", DAY0, ["a.dmx"]).unionByName(listing(spark, "STAA", date(2023, 12, 1), ["b.dmx"]))
    assert names(catalog.between_days(files, "2023-12-01")) == ["b.dmx"]
    assert names(catalog.between_days(files, None, "2023-11-30")) == ["a.dmx"]
    assert catalog.day_folders(files).count() == 2


def test_paths_outside_day_folders_have_no_keys(spark):
    paths = ["/x/STAA/continuous/2023/11/notes.txt", "/x/STAA/continuous/2023/xx/01/a.dmx", "/x/STAA/continuous/2023/02/31/a.dmx",
             "/x/STAA/continuous/2023/2/3/a.dmx"]
    df = N.with_path_keys(spark.createDataFrame([(p,) for p in paths], "path string"))
    assert [r["day"] for r in df.collect()] == [None, None, None, date(2023, 2, 3)]
    assert [r["name"] for r in df.collect()] == ["notes.txt", "a.dmx", "a.dmx", "a.dmx"]


def test_params_are_overridable():
    p = Params().with_(threshold_missing=5, net="VX")
    assert (p.near_complete, p.net, Params().net) == (1435, "VX", "VW")
