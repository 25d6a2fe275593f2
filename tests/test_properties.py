"""Properties that hold for any archive: order, subsets, sums, repeats."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from archivekit import Params
from archivekit.operators import records as R, select, stamps
from archivekit.sinks import archive as sink

from helpers import DAY0, listing, names, record, record_table

SMALL = Params(expected=4, threshold_missing=1, stamp_min=2)

a_name = st.builds(
    lambda style, m, s, ext: {
        "us": f"2023-11-24_{m:04d}_{s:02d}_STAA.{ext}",
        "sp": f"2023-11-24 {m:04d} {s:02d} STAA.{ext}",
        "gk": f"20231124_{m:04d}_STAA.{ext}",
        "odd": f"2023-11-24-{m:04d}_STAA.{ext}",
    }[style],
    st.sampled_from(["us", "sp", "gk", "odd"]), st.integers(0, 5), st.integers(0, 2),
    st.sampled_from(["dmx", "ms.zip", "trig.dmx", "ss"]),
)
some_names = st.lists(a_name, min_size=1, max_size=12, unique=True)
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(some=some_names)
def test_per_minute_is_idempotent_and_blind_to_order(spark, some):
    once = select.select_per_minute(listing(spark, "STAA", DAY0, some))
    kept = names(once)
    assert kept == names(select.select_per_minute(listing(spark, "STAA", DAY0, some[::-1])))
    assert kept == names(select.select_per_minute(listing(spark, "STAA", DAY0, kept or ["x"])))
    # Brute force: a file stays if it is local or its minute and kind hold no local one.
    local = lambda n: n.count("_") >= 2 and " " not in n
    minute = lambda n: n.replace("-", "").replace("_", " ").split(" ")[1]
    kind = lambda n: "dmx" if n.endswith("dmx") else "ms"
    usable = [n for n in some if (".ms" in n or n.endswith(".dmx")) and "24-" not in n]
    want = [n for n in usable if local(n) or not any(
        local(o) and minute(o) == minute(n) and kind(o) == kind(n) for o in usable)]
    assert kept == sorted(want)


@few
@given(some=some_names)
def test_selections_are_subsets_of_their_input(spark, some):
    files = listing(spark, "STAA", DAY0, some)
    for chosen in (
        select.select_near_complete(files, "echo", SMALL),
        select.select_cascade(files, "echo", SMALL),
        select.select_by_stamp(files, SMALL),
        select.select_larger(files, SMALL),
    ):
        kept = names(chosen)
        assert len(kept) == len(set(kept)) and set(kept) <= set(some)


@few
@given(some=some_names)
def test_histograms_add_up_to_the_files_considered(spark, some):
    files = listing(spark, "STAA", DAY0, some)
    for source in ("underscored", "spaced_echo", "spaced_gecko", "underscored_gecko"):
        total = stamps.total_considered(files, source).first()["n_considered"]
        assert (stamps.stamp_histogram(files, source).agg(F.sum("n")).first()[0] or 0) == total


@pytest.fixture(scope="module")
def many_records(spark):
    start = datetime(2023, 12, 30, 23, 50)
    rows = [record(f"AB.STAA.60.DL{c}", start + timedelta(minutes=i), 6000, 100.0)
            for i in range(30) for c in "ZNE"]
    return record_table(spark, rows + rows[:20])


def test_filing_twice_writes_nothing_more(spark, many_records, tmp_path):
    from archivekit.sources import catalog

    root = str(tmp_path / "sds")
    sink.write_sds(many_records, root)
    assert catalog.scan_sds(spark, root).count() == 90
    sink.write_sds(many_records, root)
    assert catalog.scan_sds(spark, root).count() == 90
    doy = catalog.scan_sds(spark, root).select(
        (F.col("doy") == F.dayofyear("start_ts")).alias("ok")).distinct().collect()
    assert [r["ok"] for r in doy] == [True]
    assert catalog.scan_sds(spark, root, years=[2024]).count() == 0
    assert catalog.scan_sds(spark, root, years=[2023], stations=["STAA"]).count() == 90


def test_positions_number_each_stream_without_gaps(spark, many_records):
    unique = R.dedup_records(many_records)
    got = R.record_positions(unique).groupBy("cha", F.col("start_ts").cast("date")).agg(
        F.sort_array(F.collect_list("position")).alias("p")).collect()
    assert sorted(r["p"] for r in got) == [list(range(1, 11))] * 3 + [list(range(1, 21))] * 3
    ordered = [r["end_ts"] for r in R.sort_records(unique).filter("cha = 'DLZ'").collect()]
    assert ordered == sorted(ordered)


@pytest.mark.parametrize("slices", [1, 4, 64])
def test_slicing_never_changes_a_result(spark, slices):
    some = [f"2023-11-24_{m:04d}_{s:02d}_STAA.dmx" for m in range(5) for s in range(3)]
    some += [f"2023-11-24 {m:04d} 02 STAA.dmx" for m in range(9)]
    files = listing(spark, "STAA", DAY0, some)
    params = SMALL.with_(slices=slices)
    assert select.select_per_minute(files, params).count() == 19
    assert select.select_by_stamp(files, params).count() == 15
    assert select.select_near_complete(files, "echo", params).count() == 15
