"""Join facts about a group (a station-day, a minute) back to the group's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from archivekit.params import Params

_SLICE = "_slice"


def attach(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    params: Params,
    how: str = "inner",
) -> DataFrame:
    """Equi-join `rows` with `facts` (one row per key) without hot tasks.

    A single group may hold a large share of all rows, so each group is cut
    into `params.slices` parts by a hash of the `spread` columns, and the far
    smaller facts are repeated once per part. The hash depends on row values
    only, so a recomputed task sends every row to the same place again. No side
    is hinted: Spark broadcasts the facts only where their size, estimated or
    measured at run time, is below its threshold.
    """
    keys = list(keys)
    n = params.slices
    if n <= 1:
        return rows.join(facts, keys, how)
    sliced = rows.withColumn(_SLICE, F.pmod(F.xxhash64(*spread), F.lit(n)).cast("int"))
    repeated = facts.withColumn(_SLICE, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return sliced.join(repeated, [*keys, _SLICE], how).drop(_SLICE)


def attach_small(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    params: Params,
    how: str = "inner",
) -> DataFrame:
    """As `attach`, but broadcast `facts` if a count proves them small.

    For facts that are already stored as a table: counting stops one row above
    the limit. Wide rows then stay where they are instead of being shuffled.
    """
    limit = params.broadcast_rows
    if facts.limit(limit + 1).count() <= limit:
        return rows.join(F.broadcast(facts), list(keys), how)
    return attach(rows, facts, keys, spread, params, how)
