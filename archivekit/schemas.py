"""Explicit schemas of the stored relations."""

from pyspark.sql import types as T

FILES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("name", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("station_dir", T.StringType()),
    T.StructField("year", T.IntegerType()),
])

RECORDS = T.StructType([
    T.StructField("net", T.StringType()),
    T.StructField("sta", T.StringType()),
    T.StructField("loc", T.StringType()),
    T.StructField("cha", T.StringType()),
    T.StructField("start_ts", T.TimestampNTZType()),
    T.StructField("end_ts", T.TimestampNTZType()),
    T.StructField("n_samples", T.LongType()),
    T.StructField("rate", T.DoubleType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("src_path", T.StringType()),
])

# A record table stored by station folder and year, in order of days.
STORED_RECORDS = T.StructType([
    *RECORDS.fields,
    T.StructField("day", T.DateType()),
    T.StructField("station_dir", T.StringType()),
    T.StructField("year", T.IntegerType()),
])

# Stands for a blank network, station or channel: a blank folder name would come back as NULL.
BLANK = "_"

# Partition columns come last, as the parquet reader returns them.
SDS_PARTITIONS = ["year", "net", "sta", "cha", "doy"]
SDS = T.StructType([
    T.StructField("loc", T.StringType()),
    T.StructField("start_ts", T.TimestampNTZType()),
    T.StructField("end_ts", T.TimestampNTZType()),
    T.StructField("n_samples", T.LongType()),
    T.StructField("rate", T.DoubleType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("src_path", T.StringType()),
    T.StructField("digest", T.LongType()),
    T.StructField("run", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("net", T.StringType()),
    T.StructField("sta", T.StringType()),
    T.StructField("cha", T.StringType()),
    T.StructField("doy", T.IntegerType()),
])

RUNS = T.StructType([
    T.StructField("run_ts", T.TimestampType()),
    T.StructField("station", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("recorder", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("detail", T.StringType()),
])

# The run log as stored: what each day's files were when it was filed.
STORED_RUNS = T.StructType([
    *RUNS.fields,
    T.StructField("n_files", T.LongType()),
    T.StructField("fingerprint", T.DecimalType(38, 0)),
])

# Days of an archive that were copied into another one.
PROGRESS = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("doy", T.IntegerType()),
    T.StructField("n_in", T.LongType()),
    T.StructField("n_out", T.LongType()),
    T.StructField("copied_at", T.TimestampType()),
])

LOG_LINES = T.StructType([
    T.StructField("station", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("line", T.StringType()),
])

# Day logs as stored: lines name the run they belong to.
STORED_LINES = T.StructType([*LOG_LINES.fields, T.StructField("run_ts", T.TimestampType())])
