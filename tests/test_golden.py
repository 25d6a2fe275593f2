"""Cases with known results, worked from documented examples."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from archivekit import Params
from archivekit.functions import names as N
from archivekit.functions import streams as S
from archivekit.operators import classify, records as R, rename, select, stamps
from archivekit.sinks import archive as sink
from archivekit.sources import members

from helpers import (
    DAY0, listing, keyed_records, minutes, names, record, record_table, sp_echo, us_echo,
)


def test_restart_changes_the_stamp_and_all_files_stay(spark):
    day = date(2018, 10, 1)
    stamp = lambda i: "49" if i < 1129 else "24"
    all_names = [us_echo("NARR", day, m, stamp(i)) for i, m in enumerate(minutes(1440))]
    files = listing(spark, "NARR", day, all_names)
    got = [(r["stamp"], r["n"], r["rank"]) for r in stamps.stamp_histogram(files).orderBy("rank").collect()]
    assert got == [("49", 1129, 1), ("24", 311, 2)]
    assert select.select_by_stamp(files).count() == 1440


def test_telemetered_day_keeps_its_set(spark):
    day = date(2023, 12, 1)
    files = listing(spark, "ABM2Y", day, [sp_echo("ABM2Y", day, m, "34") for m in minutes(1439)])
    hist = stamps.stamp_histogram(files, "spaced_echo").collect()
    assert [(r["stamp"], r["n"]) for r in hist] == [("34", 1439)]
    assert stamps.total_considered(files, "spaced_echo").first()["n_considered"] == 1439
    assert select.select_near_complete(files, "echo").count() == 1439


@pytest.fixture(scope="module")
def triggered_day(spark):
    """A full local day plus forty unmarked triggered files at scattered seconds."""
    usual = [us_echo("ABM5Y", DAY0, m, "02") for m in minutes(1440)]
    odd = [us_echo("ABM5Y", DAY0, m, f"{3 + i:02d}") for i, m in enumerate(minutes(40, 300))]
    return listing(spark, "ABM5Y", DAY0, usual + odd)


def test_scattered_stamps_are_told_from_the_common_one(spark, triggered_day):
    mode = stamps.stamp_mode(triggered_day).first()
    assert (mode["stamp"], mode["n"]) == ("02", 1440)
    diff = stamps.stamp_diff(triggered_day).first()
    assert (diff["total"], diff["matching"], diff["not_matching"]) == (1480, 1440, 40)
    assert select.select_by_stamp(triggered_day).count() == 1440
    assert stamps.rare_stamp_files(triggered_day).count() == 40


def test_cascade_takes_the_full_stamp_of_a_crowded_day(spark, triggered_day):
    # 1480 is still about a full day; with a tighter threshold it is too many.
    tight = Params(threshold_missing=20)
    assert select.cascade_plan(triggered_day).first()["rule"] == "local"
    assert select.cascade_plan(triggered_day, params=tight).first()["rule"] == "one_stamp"
    assert select.select_cascade(triggered_day, params=tight).count() == 1440


OVERLAP = [
    ("2023-11-24 2057 02 ABM5Y.dmx", 31207),
    ("2023-11-24_2057_02_ABM5Y.dmx", 91915),
    ("2023-11-24_2057_48_ABM5Y.dmx", 93546),
]


def test_overlapping_minute_keeps_both_local_files(spark):
    files = listing(spark, "ABM5Y", DAY0, *zip(*OVERLAP))
    assert names(select.select_per_minute(files)) == sorted(n for n, _ in OVERLAP[1:])


def test_a_one_component_file_costs_no_channel(spark):
    start = datetime(2023, 11, 24, 20, 57, 2)
    local = [record(f"AB.ABM5Y.60.{c}", start, 6000, 100.0) for c in ("DLE", "DLN", "DLZ")]
    trig = [record(f"AB.ABM5Y.60.{c}", start.replace(second=48), 6000, 100.0) for c in ("DNE", "DNN", "DNZ")]
    single = [record("AB.ABM5Y.60.DLZ", start, 6000, 100.0, src="/z/telemetered")]
    unique = R.dedup_records(record_table(spark, single + local + trig))
    assert unique.count() == 6
    channels = sorted(r["cha"] for r in unique.select("cha").distinct().collect())
    assert channels == ["DLE", "DLN", "DLZ", "DNE", "DNN", "DNZ"]


def test_stream_end_follows_from_samples(spark):
    start = datetime(2016, 12, 1, 0, 0, 35)
    df = record_table(spark, [record("AB.OUTU.60.ELE", start, 84000)])
    end = df.select(S.end_from_samples(F.col("start_ts"), F.col("n_samples"), F.col("rate")).alias("e"))
    assert end.first()["e"] == datetime(2016, 12, 1, 0, 7, 35)


def test_inventory_and_summary(spark):
    streams = [
        ("HHE", datetime(2021, 9, 26, 0, 4, 1, 835000), datetime(2021, 9, 26, 0, 5, 6, 225000), 12878),
        ("HHN", datetime(2021, 9, 26, 0, 4, 10, 845000), datetime(2021, 9, 26, 0, 5, 16, 355000), 13102),
        ("HHZ", datetime(2021, 9, 26, 0, 4, 3, 800000), datetime(2021, 9, 26, 0, 5, 9, 710000), 13182),
        ("HNE", datetime(2021, 9, 26, 0, 4, 8, 225000), datetime(2021, 9, 26, 0, 5, 13, 855000), 13126),
    ]
    rows = []
    for cha, start, end, samples in streams:
        step = (end - start) / 32
        for i in range(32):
            n = samples // 32 + (samples % 32 if i == 31 else 0)
            rows.append(("AU", "RDK1", "00", cha, start + i * step,
                         end if i == 31 else start + (i + 1) * step, n, 200.0, b"", "/x"))
    df = record_table(spark, rows)
    inventory = {r["stream_id"]: r for r in R.stream_inventory(df).collect()}
    assert inventory["AU.RDK1.00.HHE"]["samples"] == 12878
    assert inventory["AU.RDK1.00.HHE"]["records"] == 32
    assert inventory["AU.RDK1.00.HHE"]["end_ts"] == streams[0][2]
    total = R.inventory_summary(df).first()
    assert (total["networks"], total["stations"], total["streams"]) == (1, 1, 4)
    assert (total["records"], total["samples"]) == (128, 52288)
    assert total["start_ts"] == streams[0][1] and total["end_ts"] == streams[1][2]


def test_two_kinds_of_telemetered_name(spark):
    files = listing(spark, "FORG", date(2021, 11, 3),
                    ["2021-11-03 0001 00 FORG.ms.zip", "2021-11-03 0001 FORG.ms.zip"])
    parsed = {r["name"]: r for r in N.parse_name(files).collect()}
    assert all(r["style"] == "spaced" and r["station"] == "FORG" for r in parsed.values())
    assert parsed["2021-11-03 0001 00 FORG.ms.zip"]["ss"] == "00"
    assert parsed["2021-11-03 0001 FORG.ms.zip"]["ss"] is None


def test_uniform_station_names(spark):
    day = date(2023, 12, 31)
    files = listing(spark, "FRTM", day, [us_echo("FRTM", day, m, "52") for m in minutes(1440)])
    row = classify.station_census(files).first()
    assert (row["station"], row["n_station"], row["n_files"]) == ("FRTM", 1440, 1440)
    assert row["confidence"] == 1.0 and row["count_ok"]


SIX = ("DLZ", "DLE", "DLN", "DNZ", "DNE", "DNN")


@pytest.mark.parametrize("station", ["ABM5Y", "NARR"])
def test_rules_and_spec_of_a_six_channel_day(spark, station):
    recs = keyed_records(spark, [
        record(f"AB.{station}.60.{c}", datetime(2023, 11, 24, 1, 0), 6000, 100.0) for c in SIX
    ])
    row = rename.rename_strings(rename.select_channels(recs)).first()
    assert row["spec"] == "DL?"
    assert row["rename"] == ",".join(
        f"AB.{station}.60.DL{c}:VW.{station}.00.CH{c}" for c in "ENZ"
    )
    renamed = rename.apply_rename(recs, rename.select_channels(recs)).collect()
    assert sorted((r["net"], r["loc"], r["cha"]) for r in renamed) == [
        ("VW", "00", "CHE"), ("VW", "00", "CHN"), ("VW", "00", "CHZ")]
    assert R.too_many_streams(recs).first()["n_streams"] == 6


def test_earlier_channel_rule_drops_any_n(spark):
    recs = keyed_records(spark, [
        record(f"AB.NARR.60.{c}", datetime(2023, 11, 24, 1, 0), 6000, 100.0) for c in SIX
    ])
    assert rename.select_channels(recs, legacy=True).count() == 0


def test_records_past_midnight_go_to_the_next_day(spark):
    rows = [
        record("VW.ABM1Y.00.CHZ", datetime(2023, 10, 24, 23, 59), 6000, 100.0),
        record("VW.ABM1Y.00.CHZ", datetime(2023, 10, 25, 0, 0, 5), 6000, 100.0,
               src="/a/ABM1Y/continuous/2023/10/24/20231024_2359_ABM1Y.ms.zip"),
    ]
    got = {r["doy"]: r["sds_path"] for r in sink.with_sds_path(keyed_records(spark, rows)).collect()}
    assert got == {
        297: "2023/VW/ABM1Y/CHZ.D/VW.ABM1Y.00.CHZ.D.2023.297",
        298: "2023/VW/ABM1Y/CHZ.D/VW.ABM1Y.00.CHZ.D.2023.298",
    }


def test_single_replaced_minute_survives(spark):
    day = date(2023, 12, 12)
    three = ["2023-12-12 2009 27 ABM2Y.dmx", "2023-12-12_2010_27_ABM2Y.dmx", "2023-12-12 2011 27 ABM2Y.dmx"]
    assert names(select.select_per_minute(listing(spark, "ABM2Y", day, three))) == sorted(three)


def test_style_and_size_rules_differ(spark):
    day = date(2016, 12, 1)
    pair = ["2016-12-01 0003 35 OUTU.dmx", "2016-12-01_0003_35_OUTU.dmx"]
    files = listing(spark, "OUTU", day, pair, [144_000, 73_000])
    assert names(select.select_per_minute(files)) == [pair[1]]
    assert names(select.select_larger(files)) == [pair[0]]


@pytest.mark.parametrize("dmx, ms, want", [
    (5, 0, "echo"), (0, 5, "gecko"), (60, 40, "echo"), (50, 50, "gecko"), (40, 30, None),
])
def test_recorder_type_of_one_day(spark, dmx, ms, want):
    every = [us_echo("STAA", DAY0, m, "01") for m in minutes(dmx)]
    every += [f"2023-11-24 {m} 00 STAA.ms.zip" for m in minutes(ms)]
    row = classify.recorder_type(listing(spark, "STAA", DAY0, every)).first()
    assert row["decided"] == want
    assert row["recorder"] == (want or "echo")


def test_recorder_type_is_carried_over_undecided_days(spark):
    gecko = lambda d, n: [f"{d:%Y-%m-%d} {m} 00 STAA.ms.zip" for m in minutes(n)]
    days = [date(2023, 10, 30), date(2023, 10, 31), date(2023, 11, 1), date(2023, 11, 2)]
    files = listing(spark, "STAA", days[0], gecko(days[0], 5) + [us_echo("STAA", days[0], "0001", "02")])
    files = files.unionByName(listing(spark, "STAA", days[1], gecko(days[1], 5)))
    for d in days[2:]:
        files = files.unionByName(
            listing(spark, "STAA", d, gecko(d, 5) + [us_echo("STAA", d, "0001", "02")]))
    kinds = lambda reset: [
        r["recorder"] for r in classify.recorder_type(files, reset=reset).orderBy("day").collect()]
    assert kinds(None) == ["echo", "gecko", "gecko", "gecko"]
    assert kinds("month") == ["echo", "gecko", "echo", "echo"]
    assert kinds("day") == ["echo", "gecko", "echo", "echo"]


def test_junk_names_are_rejected(spark):
    junk = ["2023-11-01 1009 59 BRTH.trig.dmx", "2018-10-25 2000 00 BRTH.ss",
            "2018-10-25 1542 03 BRTH_CHZ.mseed.zip", "2018-10-25 1542 03 BRTH_CHZ.mseed"]
    files = listing(spark, "BRTH", DAY0, junk)
    assert select.valid_files(files, "echo").count() == 0
    assert select.valid_files(files, "gecko").count() == 0


def test_name_grammar_of_the_third_family(spark):
    files = listing(spark, "RDK1", date(2021, 9, 26),
                    ["2021-09-26 0004 05 RDK1_HNN.mseed.zip", "2021-09-26 0004_RDK1.ms.zip"])
    got = {r["ext"]: (r["station"], r["cha"], r["ss"]) for r in N.parse_name(files).collect()}
    assert got == {".mseed.zip": ("RDK1", "HNN", "05"), ".ms.zip": ("RDK1", None, None)}
    assert select.with_extensions(files, "per_channel").count() == 1


def test_wildcard_rename(spark):
    recs = record_table(spark, [
        record("VW.AAA.00.CHZ", datetime(2023, 1, 1), 100), record("AB.AAA.60.DLZ", datetime(2023, 1, 1), 100)])
    ids = lambda rules: sorted(
        ".".join(r) for r in rename.apply_wildcard_rename(recs, rules).select(*R.IDENTITY).collect())
    assert ids("VW.*.*.*:VX.-.-.-") == ["AB.AAA.60.DLZ", "VX.AAA.00.CHZ"]
    assert ids("VW.-.00.-") == ["VW.AAA.00.CHZ", "VW.AAA.00.DLZ"]
    assert ids("AB.*.*.DL?:VW.-.-.CHZ") == ["VW.AAA.00.CHZ", "VW.AAA.60.CHZ"]
    assert ids("(AB|XX).*.*.*:QQ.-.-.-,*.*.*.*:RR.-.-.-") == ["QQ.AAA.60.DLZ", "RR.AAA.00.CHZ"]
    assert ids("") == ["AB.AAA.60.DLZ", "VW.AAA.00.CHZ"]
    with pytest.raises(ValueError):
        rename.parse_rules("VW.*:VX.-.-.-")


@pytest.mark.parametrize("rate, corner, code", [
    (250, 1, "D"), (999, 60, "C"), (100, 1, "E"), (100, 10, "H"), (20, 1, "S"), (10, 60, "B"),
    (5, 1, None), (1000, 1, "E"),
])
def test_band_codes(spark, rate, corner, code):
    df = spark.range(1).select(S.band_code(F.lit(float(rate)), F.lit(float(corner))).alias("c"))
    assert df.first()["c"] == code


def test_members_keep_their_archive(spark):
    import gzip
    import io
    import zipfile

    def packed(entries):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in entries:
                z.writestr(name, data)
        return bytearray(out.getvalue())

    rows = [
        ("/d/2023-10-29 0001 00 ABM1Y.ms.zip", packed([("2023-10-29 0001 00 ABM1Y.ms", b"one")])),
        ("/d/20231029_0001_ABM1Y.ms.zip", packed([
            ("20231029_0001_ABM1Y.ms", b"three"), ("ABM1Y.02000236.ss", b"s"), ("ABM1Y.02000236.station.xml", b"x")])),
        ("/d/2021-09-26 0005 06 RDK1_HHE.mseed.zip", packed([("2021-09-26 0005_RDK1.ms", b"E")])),
        ("/d/2021-09-26 0005 06 RDK1_HHN.mseed.zip", packed([("2021-09-26 0005_RDK1.ms", b"N")])),
        ("/d/2024-01-01 0000 52 FRTM.dmx.gz", bytearray(gzip.compress(b"suds"))),
        ("/d/2020-11-08 0001 DDSW.ms", bytearray(b"plain")),
    ]
    got = members.expand_members(spark.createDataFrame(rows, "path string, content binary"), chunk_bytes=4)
    assert sorted((r["member"], bytes(r["content"])) for r in got.collect()) == sorted([
        ("2023-10-29 0001 00 ABM1Y.ms", b"one"), ("20231029_0001_ABM1Y.ms", b"three"),
        ("2021-09-26 0005_RDK1.ms", b"E"), ("2021-09-26 0005_RDK1.ms", b"N"),
        ("2024-01-01 0000 52 FRTM.dmx", b"suds"), ("2020-11-08 0001 DDSW.ms", b"plain")])


def test_many_tiny_members_leave_in_small_batches():
    import pandas as pd

    files = pd.DataFrame({"path": [f"/d/{k}.ms" for k in range(10_000)], "content": [b"x"] * 10_000})
    members_of = members._expander((".ms",), 64 << 20, 4096)
    sizes = [len(out) for out in members_of(iter([files[k : k + 2500] for k in range(0, 10_000, 2500)]))]
    assert sum(sizes) == 10_000 and max(sizes) <= 4096
