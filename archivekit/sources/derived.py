"""The archive's input tables, derived from a table of timed events.

Lets every operator run on an `events` table (event_id, ts, user_id,
event_type, value, props): one minute file and one or two records per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROOT = "/archive"


def load_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def _named(events: DataFrame) -> DataFrame:
    """Parts of each event's file name."""
    ts, eid, uid = F.col("ts"), F.col("event_id"), F.col("user_id")
    station = uid % 4
    is_error = F.col("event_type") == "error"
    dmx = station.isin(0, 1) != (eid % 17 == 0)
    return events.withColumns({
        "station_dir": F.concat(F.lit("ST"), station.cast("string")),
        # A few files carry the name of another station.
        "token": F.concat(
            F.lit("ST"),
            F.when(eid % 97 == 0, (uid + 1) % 4).otherwise(station).cast("string"),
        ),
        "day": ts.cast("date"),
        "hhmm": F.concat(_two(F.hour(ts)), _two(F.minute(ts))),
        "ss": F.when(is_error, _two(F.second(ts).cast("int")))
        .when((station == 1) & (F.hour(ts) >= 12), "24")
        .otherwise("02"),
        "ext": F.when(dmx, "dmx").otherwise("ms.zip"),
        "trig": F.when(is_error & (eid % 5 == 0), ".trig").otherwise(""),
        "spaced": F.col("event_type").isin("click", "view"),
    })


def _file_name() -> Column:
    tail = F.concat(F.col("token"), F.col("trig"), F.lit("."), F.col("ext"))
    iso = F.col("day").cast("string")
    return (
        F.when(F.col("spaced"), F.concat_ws(" ", iso, "hhmm", "ss", tail))
        .when(F.col("ext") == "dmx", F.concat_ws("_", iso, "hhmm", "ss", tail))
        .otherwise(F.concat_ws("_", F.replace(iso, F.lit("-"), F.lit("")), "hhmm", tail))
    )


def _folder() -> Column:
    iso = F.col("day").cast("string")
    return F.concat(
        F.lit(f"{ROOT}/"), F.col("station_dir"), F.lit("/continuous/"),
        F.replace(iso, F.lit("-"), F.lit("/")), F.lit("/"),
    )


def _listed(file_name: Column, length: Column) -> Column:
    return F.struct(
        F.concat(_folder(), file_name).alias("path"),
        length.cast("bigint").alias("length"),
        F.col("ts").cast("timestamp").alias("modified"),
    )


def files(events: DataFrame, ancillary: bool = False) -> DataFrame:
    """File listing: path, length, modified. With `ancillary`, also junk names.

    Rows come out of a generator, so later steps see plain columns instead of
    working the names out again for every predicate.
    """
    minute_file = _listed(_file_name(), F.round(F.col("value") * 100) + 1)
    listed = F.array(minute_file)
    if ancillary:
        kind = F.col("event_id") % 3
        suffix = (
            F.when(kind == 0, ".ss").when(kind == 1, ".station.xml").otherwise("_CHZ.mseed.zip")
        )
        junk = F.concat_ws(
            " ", F.col("day").cast("string"), "hhmm", "ss", F.concat("token", suffix)
        )
        both = F.array(minute_file, _listed(junk, F.lit(100)))
        listed = F.when(F.col("event_id") % 50 == 0, both).otherwise(listed)
    return _named(events).select(F.explode(listed).alias("file")).select("file.*")


def records(events: DataFrame) -> DataFrame:
    """Decoded records; every seventh event's record occurs twice."""
    three = F.array(*[F.lit(c) for c in ("CHZ", "CHN", "CHE")])
    six = F.array(*[F.lit(c) for c in ("DLZ", "DLN", "DLE", "DNZ", "DNN", "DNE")])
    eid = F.col("event_id")
    n_samples = (F.lit(100) * (1 + eid % 120)).cast("bigint")
    record = F.struct(
        F.lit("AB").alias("net"),
        F.col("station_dir").alias("sta"),
        F.lit("60").alias("loc"),
        F.when(F.col("station_dir") == "ST3", F.get(three, (eid % 3).cast("int")))
        .otherwise(F.get(six, (eid % 6).cast("int")))
        .alias("cha"),
        F.col("ts").alias("start_ts"),
        F.timestamp_add(
            "SECOND", F.floor(n_samples / 100).cast("int"), F.col("ts")
        ).alias("end_ts"),
        n_samples.alias("n_samples"),
        F.lit(100.0).alias("rate"),
        F.encode("props", "UTF-8").alias("payload"),
        F.concat(_folder(), _file_name()).alias("src_path"),
    )
    copies = F.when(eid % 7 == 0, 2).otherwise(1)
    return (
        _named(events)
        .select(F.explode(F.array_repeat(record, copies)).alias("record"))
        .select("record.*")
    )


def log_lines(events: DataFrame) -> DataFrame:
    """One log line per event, numbered within its station and day by event id."""
    named = _named(events)
    return named.select(
        F.col("station_dir").alias("station"),
        "day",
        F.col("event_id").alias("line_no"),
        F.concat_ws(" ", "hhmm", "event_type", "props").alias("line"),
    )


def packed_files(events: DataFrame) -> DataFrame:
    """Compressed minute files: gzip for dmx, zip for the others.

    Local zips hold three members (`.ms`, `.ss`, `.station.xml`), telemetered
    ones a single `.ms`; members hold the event's properties.
    """
    named = _named(events).select(
        F.concat(
            _folder(), _file_name(), F.when(F.col("ext") == "dmx", ".gz").otherwise("")
        ).alias("path"),
        "props",
    )

    def pack(batches):
        import gzip
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            packed = []
            for path, props in zip(batch["path"], batch["props"]):
                data, name = props.encode(), path.rsplit("/", 1)[-1]
                if name.endswith(".gz"):
                    packed.append(gzip.compress(data, mtime=0))
                    continue
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(name[: -len(".zip")], data)
                    if " " not in name:
                        archive.writestr("side.ss", b"s")
                        archive.writestr("side.station.xml", b"<x/>")
                packed.append(out.getvalue())
            yield pd.DataFrame({"path": batch["path"], "content": packed})

    return named.mapInPandas(pack, "path string, content binary")


def write_tree(events: DataFrame, root: str) -> None:
    """Real day folders below `root`: a file for each station-day and extension.

    It has the first name of its group and ten bytes for each file of it; a copy of each
    lies outside the day folders, in one named after the day.
    """
    groups = _named(events).groupBy("station_dir", "day", "ext").agg(
        F.min(_file_name()).alias("name"), F.count(F.lit(1)).alias("n"))

    def write(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for row in batch.itertuples():
                for folder in (f"{row.station_dir}/continuous/{row.day:%Y/%m/%d}", f"{row.station_dir}/other/{row.day:%d}"):
                    store.create_dir(f"{base}/{folder}")
                    with store.open_output_stream(f"{base}/{folder}/{row.name}") as out:
                        out.write(b"0123456789" * row.n)
            yield batch[["n"]]

    groups.mapInPandas(write, "n bigint").write.format("noop").mode("overwrite").save()
