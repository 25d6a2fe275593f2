"""A bucketed table of the keys that are filed.

New records are compared with it bucket by bucket: the filed side, which grows with the
archive, is read where it lies and never shuffled. The table lives below the archive's
root and is known to the session's catalog by a name; every write adds its keys before
it is published, under its run, so keys of broken runs don't count either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from archivekit import schemas
from archivekit.operators.records import RECORD_KEY
from archivekit.operators.workspace import exists
from archivekit.params import Params
from archivekit.sinks import commits

COLUMNS = [*RECORD_KEY, "digest", "src_path", "run", "year"]


def _stored(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.SDS).option("basePath", root).parquet(root)


def _insert(rows: DataFrame, table: str, params: Params) -> None:
    dealt = rows.select(*COLUMNS).repartition(params.key_buckets, *RECORD_KEY).sortWithinPartitions(*RECORD_KEY)
    dealt.write.insertInto(table)


def open_keys(spark: SparkSession, table: str, root: str, params: Params = Params()) -> None:
    """Make `table` known to the session; an archive filed without it is indexed first.

    The number of buckets is `params.key_buckets` for as long as the table lives.
    """
    if spark.catalog.tableExists(table):
        return
    place = f"{root}/_keys"
    old = exists(spark, f"{root}/year=*") and not exists(spark, f"{place}/*.parquet")
    types = {f.name: f.dataType.simpleString() for f in schemas.SDS.fields}
    columns = ", ".join(f"{c} {types[c]}" for c in COLUMNS)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({', '.join(RECORD_KEY)}) "
        f"SORTED BY ({', '.join(RECORD_KEY)}) INTO {params.key_buckets} BUCKETS LOCATION '{place}'"
    )
    if old:
        rows = _stored(spark, root)
        _insert(rows.withColumn("digest", F.coalesce("digest", F.xxhash64("payload"))), table, params)


def add_keys(spark: SparkSession, table: str, root: str, run: str, params: Params = Params()) -> None:
    """Add the keys of what `run` has written."""
    _insert(_stored(spark, root).filter(F.col("run") == run), table, params)


def filed_keys(spark: SparkSession, table: str, root: str, years: Sequence[int]) -> DataFrame:
    """Keys, source path and run of the records filed in these years that count."""
    return commits.counting(spark.table(table).filter(F.col("year").isin(*years)), spark, root)
