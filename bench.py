"""Time the headline operators: prints one JSON line.

Set BENCH_SF_DIR for the data folder and BENCH_CPUS for the number of cores. The
listing and the records are derived from the events once and stored, as an archive's
catalog and record table are; operators then run on the stored tables.
"""

from __future__ import annotations

import json
import os
import re
import time

from archivekit.operators import classify, records as R, rename, select, stamps
from archivekit.operators.workspace import new_folder
from archivekit.plans import archive
from archivekit.plans.queries import ONE_DAY, SCALED, _all, _raw_records
from archivekit.functions.names import with_path_keys
from archivekit.session import get_session
from archivekit.sinks import archive as sink
from archivekit.sources import catalog


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", **{
        "spark.master": f"local[{cpus}]",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        # A small archive still has hundreds of day folders: share the writing.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return round(time.perf_counter() - start, 3)

    def measure(name: str, build) -> None:
        run = lambda: build().write.format("noop").mode("overwrite").save()
        run()  # the first run compiles
        seconds[name] = min(timed(run), timed(run))

    listing, table = new_folder(spark, "bench-catalog"), new_folder(spark, "bench-records")
    seconds["catalog_build"] = timed(
        lambda: catalog.write_catalog(_all(spark, folder), listing))
    # The record table is an input; storing it is not part of the work.
    _raw_records(spark, folder).repartition(int(cpus)).write.parquet(table)
    by_day = new_folder(spark, "bench-records-by-day")
    catalog.write_records(_raw_records(spark, folder), by_day)

    files = catalog.read_catalog(spark, listing)
    records = catalog.read_records(spark, table)
    keyed = with_path_keys(records, "src_path")

    measure("recorder_type", lambda: classify.recorder_type(files, SCALED))
    measure("station_census", lambda: classify.station_census(files, SCALED))
    measure("stamp_histogram", lambda: stamps.stamp_histogram(files))
    measure("day_completeness", lambda: select.day_completeness(
        select.valid_files(files, "echo", SCALED), SCALED))
    measure("missing_minutes", lambda: select.missing_minutes(files))
    measure("select_near_complete", lambda: select.select_near_complete(files, "echo", SCALED))
    measure("select_per_minute", lambda: select.select_per_minute(files, SCALED))
    measure("select_by_stamp", lambda: select.select_by_stamp(files, SCALED))
    measure("select_cascade", lambda: select.select_cascade(files, "echo", SCALED))
    measure("select_larger", lambda: select.select_larger(files, SCALED))
    measure("dedup_records", lambda: R.dedup_records(records))
    measure("sort_records", lambda: R.sort_records(R.dedup_records(records)))
    measure("stream_inventory", lambda: R.stream_inventory(records))
    measure("rename_strings", lambda: rename.rename_strings(rename.select_channels(keyed)))
    measure("renamed_records", lambda: rename.apply_rename(keyed, rename.select_channels(keyed)))
    measure("sds_day_counts", lambda: sink.sds_day_counts(records))

    sds = new_folder(spark, "bench-sds")
    whole = lambda: archive.run_archive(
        spark, files, records, sds, params=SCALED, skip_present=False)
    seconds["import_first"] = timed(whole)
    seconds["import_again"] = timed(whole)
    stored = catalog.read_records(spark, by_day, partitioned=True)
    seconds["import_one_day"] = timed(lambda: archive.run_archive(
        spark, files, stored, new_folder(spark, "bench-day"), params=SCALED, start=ONE_DAY, end=ONE_DAY))

    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
