"""Open zip and gzip files of a chosen set and return their data members."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from archivekit.functions import names as N
from archivekit.params import Params

MEMBER_SCHEMA = "path string, member string, member_size bigint, content binary"

# What counts as a data member.
DATA_MEMBERS = (".ms", ".mseed", ".dmx")


def load_contents(
    spark: SparkSession, chosen: DataFrame, folders: Sequence[str], family: str,
    params: Params = Params(),
) -> DataFrame:
    """Bytes of the `chosen` paths, all of one recorder family.

    A semi-join cannot prune files, so only the given day `folders` are opened;
    names the family ignores are dropped before their bytes are read, by a
    predicate on the file name alone.
    """
    name = F.col("_metadata.file_name")  # spaces are percent-encoded here
    files = (
        spark.read.format("binaryFile").load(list(folders))
        .filter(N.has_extension(name, family) & ~F.rlike(name, F.lit(params.ignore(family))))
        .select("path", "content")
    )
    return files.join(chosen.select("path").distinct(), "path", "left_semi")


def expand_members(
    files: DataFrame, suffixes: Sequence[str] = DATA_MEMBERS, chunk_bytes: int = 64 << 20, chunk_rows: int = 4096
) -> DataFrame:
    """One row per data member of each (path, content) row.

    Members are keyed by (path, member): equal member names of different files
    stay apart. Output batches are cut by size and by rows, as tiny members weigh
    little beside their rows: a task holds a batch of archives and at most
    `chunk_bytes` of members, or `chunk_rows` of them.
    """
    expand = _expander(tuple(suffixes), chunk_bytes, chunk_rows)
    return files.select("path", "content").mapInPandas(expand, MEMBER_SCHEMA)


def _expander(wanted: tuple[str, ...], chunk_bytes: int, chunk_rows: int):
    def expand(batches: Iterator) -> Iterator:
        import gzip
        import io
        import zipfile

        import pandas as pd

        columns = ["path", "member", "member_size", "content"]

        def members(path: str, content: bytes):
            base = path.rsplit("/", 1)[-1]
            if base.endswith(".zip"):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for info in archive.infolist():
                        if not info.is_dir() and info.filename.endswith(wanted):
                            yield info.filename, archive.read(info)
            elif base.endswith(".gz"):
                if base[:-3].endswith(wanted):
                    yield base[:-3], gzip.decompress(content)
            elif base.endswith(wanted):
                yield base, content

        rows, held = [], 0
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for member, data in members(path, bytes(content)):
                    rows.append((path, member, len(data), data))
                    held += len(data)
                    if held >= chunk_bytes or len(rows) >= chunk_rows:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    return expand


def member_order(members: DataFrame) -> DataFrame:
    """Members in name order within each partition, instead of one joined file."""
    return members.withColumn("name", N.base_name(F.col("path"))).sortWithinPartitions(
        "name", "member"
    )
