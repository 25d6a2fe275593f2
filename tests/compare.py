"""Compare a Spark query with its SQL counterpart run by DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def rows_of(table) -> tuple[list[str], Counter]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, Counter(zip(*columns)) if columns else Counter()


def difference(df, sql: str, con) -> str | None:
    """None when both give the same columns and the same rows."""
    got_names, got = rows_of(df.toArrow())
    want_names, want = rows_of(con.execute(sql).to_arrow_table())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got != want:
        extra, lacking = got - want, want - got
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; "
            f"only Spark {sum(extra.values())}: {list(extra)[:2]}; "
            f"only SQL {sum(lacking.values())}: {list(lacking)[:2]}"
        )
    return None
