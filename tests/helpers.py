from datetime import date, datetime, timedelta

from pyspark.sql import types as T

from archivekit import schemas
from archivekit.functions import names as N

LISTING = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
])


def path(station, day, name):
    return f"/data/archive/{station}/continuous/{day:%Y/%m/%d}/{name}"


def listing(spark, station, day, names, sizes=None):
    """A day folder with these names, as the catalog returns it."""
    sizes = sizes or [1000] * len(names)
    rows = [(path(station, day, n), s) for n, s in zip(names, sizes)]
    return N.with_path_keys(spark.createDataFrame(rows, LISTING))


def minutes(n, start=0):
    for i in range(start, start + n):
        yield f"{i // 60:02d}{i % 60:02d}"


def us_echo(station, day, hhmm, ss):
    return f"{day:%Y-%m-%d}_{hhmm}_{ss}_{station}.dmx"


def sp_echo(station, day, hhmm, ss):
    return f"{day:%Y-%m-%d} {hhmm} {ss} {station}.dmx"


def record(sid, start, n_samples, rate=200.0, payload=b"x", src=None, seconds=None):
    net, sta, loc, cha = sid.split(".")
    seconds = n_samples / rate if seconds is None else seconds
    src = src or path(sta, start, f"{start:%Y-%m-%d}_{start:%H%M}_{start:%S}_{sta}.dmx")
    return (net, sta, loc, cha, start, start + timedelta(seconds=seconds), n_samples, rate, payload, src)


def record_table(spark, rows):
    return spark.createDataFrame(rows, schemas.RECORDS)


def keyed_records(spark, rows):
    return N.with_path_keys(record_table(spark, rows), "src_path")


def names(df):
    return sorted(r["name"] for r in df.select("name").collect())


DAY0 = date(2023, 11, 24)
NOON = datetime(2023, 11, 24, 12, 0, 0)
