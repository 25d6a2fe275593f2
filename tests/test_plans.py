"""Shapes of the physical plans that matter at scale."""

import re

import pytest

from archivekit import Params
from archivekit.operators import records as R, select
from archivekit.plans.queries import QUERIES, _all
from archivekit.sinks import archive as sink, runlog
from archivekit.sources import catalog, derived

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield
    spark.conf.unset(key)


# Those that write tables first are left out.
WRITING = (
    "import_archive", "import_one_day", "run_summary", "refiled_days", "rehome_resumed", "failed_days", "walked_folders",
    "filed_payloads", "manifest_again", "recorder_type_stored", "days_changed", "import_with_key_table",
)
READ_ONLY = sorted(q for q in QUERIES if "roundtrip" not in q and q not in WRITING)


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_query_crosses_or_loops(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_day_facts_are_joined_in_slices(spark, no_broadcast):
    plan = plan_of(QUERIES["select_near_complete"](spark, FOLDER))
    assert re.search(r"hashpartitioning\(station_dir#\d+, day#\d+, _slice#\d+", plan)
    assert "Window" not in plan


def test_ranks_are_cut_before_the_shuffle(spark):
    for df in (
        runlog.last_lines(derived.log_lines(derived.load_events(spark, FOLDER))),
        QUERIES["select_larger"](spark, FOLDER),
    ):
        plan = plan_of(df)
        assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")


def test_filing_shuffles_records_once_before_comparing(spark, no_broadcast, tmp_path):
    path = str(tmp_path / "records")
    derived.records(derived.load_events(spark, FOLDER)).write.parquet(path)
    recs = catalog.read_records(spark, path)
    filed = recs.limit(0).select(*R.RECORD_KEY)
    filed.write.parquet(str(tmp_path / "filed"))
    filed = spark.read.schema(filed.schema).parquet(str(tmp_path / "filed"))
    plan = plan_of(sink.new_records(R.dedup_records(recs), filed))
    # One exchange for the records (with copies merged ahead of it), one for the keys.
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_min" in plan


def test_streams_are_listed_without_payloads(spark, tmp_path):
    path = str(tmp_path / "records")
    derived.records(derived.load_events(spark, FOLDER)).write.parquet(path)
    plan = plan_of(R.stream_inventory(catalog.read_records(spark, path)))
    assert "payload" not in plan and "src_path" not in plan


def test_day_filters_prune_catalog_folders(spark, tmp_path):
    path = str(tmp_path / "catalog")
    catalog.write_catalog(_all(spark, FOLDER), path)
    days = catalog.between_days(catalog.read_catalog(spark, path), "2024-01-10", "2024-01-12")
    plan = plan_of(select.valid_files(days, "echo", Params()))
    assert re.search(r"PartitionFilters: \[[^\]]*year", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(day", plan)
