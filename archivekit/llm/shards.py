"""Shards of near equal bytes by Karmarkar-Karp differencing.

The indivisible items are groups of equal texts. A partial partition holds, for every
shard, the bytes and the groups put there so far; an item alone is one with a single
filled shard. Differencing takes the two partial partitions with the largest spread
and joins them oppositely ordered, the fullest shard of one with the emptiest of the
other, until one is left. Tasks do this over blocks of groups, which gives one partial
partition a block; those are differenced in the same way, level by level, so no task
ever sees more than `block` of them.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivekit.operators.workspace import stage

#: Partial partitions that are differenced in one task.
BLOCK = 8192
#: Rows that are numbered in one task.
SLOTS = 20_000


def difference(parts: list[tuple[list[int], int]], shards: int) -> tuple[list[int], dict[int, list[int]]]:
    """Join partial partitions (sums by shard, key) by Karmarkar-Karp.

    Gives the joined sums in ascending order and, for each key, which of them each of
    its shards went to. Ties go by key, so a repeated task repeats its answer.
    """
    # A joined partition is a tree: per child, where each of its shards went.
    children: dict[int, list[tuple[int, list[int]]]] = {}
    heap = []
    for n, (sums, key) in enumerate(sorted(parts, key=lambda p: p[1])):
        order = sorted(range(shards), key=lambda s: (sums[s], s))
        to = [0] * shards
        for place, s in enumerate(order):
            to[s] = place
        ranked = [sums[s] for s in order]
        children[n] = [(~key, to)]
        heap.append((ranked[0] - ranked[-1], n, ranked))
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        _, a, one = heapq.heappop(heap)
        _, b, two = heapq.heappop(heap)
        total = [one[s] + two[shards - 1 - s] for s in range(shards)]
        order = sorted(range(shards), key=lambda s: (total[s], s))
        to = [0] * shards
        for place, s in enumerate(order):
            to[s] = place
        ranked = [total[s] for s in order]
        children[number] = [(a, to), (b, to[::-1])]
        heapq.heappush(heap, (ranked[0] - ranked[-1], number, ranked))
        number += 1
    if not heap:
        return [0] * shards, {}
    _, root, sums = heap[0]
    out: dict[int, list[int]] = {}
    todo = [(root, list(range(shards)))]
    while todo:
        n, places = todo.pop()
        for child, to in children[n]:
            ends = [places[p] for p in to]
            if child < 0:
                out[~child] = ends
            else:
                todo.append((child, ends))
    return sums, out


def _first(shards: int, heavy: list[int], light: int):
    """Difference the groups of a block, and with them its share of the heavy groups' sums.

    With heavy groups, places are numbered as the shards of `heavy`, so that every
    block fills up what those left uneven.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bytes", "key"], ignore_index=True)
        parts = [([0] * (shards - 1) + [int(size)], n) for n, size in enumerate(group["bytes"])]
        if any(heavy):
            part = int(group["bytes"].sum())
            _, to = difference([*parts, ([h * part // light for h in heavy], len(parts))], shards)
            label = {place: s for s, place in enumerate(to[len(parts)])}
            places, sums = [label[to[n][-1]] for n in range(len(group))], [0] * shards
        else:
            sums, to = difference(parts, shards)
            places = [to[n][-1] for n in range(len(group))]
        head = pd.DataFrame({"block": group["block"].iloc[:1], "key": [None], "place": [None], "sums": [sums]})
        rows = pd.DataFrame({"block": group["block"], "key": group["key"], "place": places, "sums": None})
        return pd.concat([rows, head], ignore_index=True)

    return run


def _next(shards: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("below", ignore_index=True)
        sums, to = difference([(list(map(int, s)), n) for n, s in enumerate(group["sums"])], shards)
        head = pd.DataFrame({"block": group["block"].iloc[:1], "below": [None], "places": [None], "sums": [sums]})
        rows = pd.DataFrame({"block": group["block"], "below": group["below"], "places": [to[n] for n in range(len(group))], "sums": None})
        return pd.concat([rows, head], ignore_index=True)

    return run


def assign_groups(groups: DataFrame, shards: int, block: int = BLOCK) -> DataFrame:
    """(key binary, bytes long), a row per indivisible group, to (key, shard).

    Groups above a 64th of a fair share are heavy; there are at most 64 times `shards`
    of them. They are differenced first, on the driver, and each block of the others
    then evens out its share of what they left. Without heavy groups the blocks'
    partial partitions are differenced level by level.
    """
    n, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    is_heavy = F.col("bytes") * (64 * shards) > F.lit(total)
    big = sorted(groups.filter(is_heavy).collect()) if n > 64 * shards else []
    heavy, to = difference([([0] * (shards - 1) + [r["bytes"]], k) for k, r in enumerate(big)], shards)
    placed = groups.sparkSession.createDataFrame(
        [(bytes(r["key"]), to[k][-1]) for k, r in enumerate(big)], "key binary, shard int")
    light = groups.filter(~is_heavy) if big else groups

    blocks = max(1, -(-n // block))
    dealt = light.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    done = stage(dealt.groupBy("block").applyInPandas(
        _first(shards, heavy, total - sum(heavy)), "block long, key binary, place int, sums array<long>"), "kk0")
    rows = done.filter("key IS NOT NULL").select("key", "block", "place")
    parts = done.filter("key IS NULL").select(F.col("block").alias("below"), "sums")
    while blocks > 1 and not big:
        blocks = -(-blocks // (block // 4))
        dealt = parts.withColumn("block", F.pmod(F.xxhash64("below"), F.lit(blocks)))
        done = stage(dealt.groupBy("block").applyInPandas(
            _next(shards), "block long, below long, places array<int>, sums array<long>"), "kk")
        moved = done.filter("below IS NOT NULL").select(F.col("below").alias("block"), F.col("block").alias("up"), "places")
        rows = rows.join(moved, "block").select("key", F.col("up").alias("block"), F.get("places", "place").alias("place"))
        parts = done.filter("below IS NULL").select(F.col("block").alias("below"), "sums")
    return rows.select("key", F.col("place").alias("shard")).union(placed)


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of a text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def shard_documents(docs: DataFrame, shards: int = 24, block: int = BLOCK) -> DataFrame:
    """Put documents (doc_id, text) into `shards` of near equal bytes; equal texts stay together.

    Gives doc_id, size, text_crc32, law (`bytes`), shard, slot and grown_shard (null).
    Null texts are one group of their own, apart from empty ones; repeated rows each
    take a slot. A group larger than a fair share makes its shard as large as it must be.
    """
    text = F.col("text").cast("string")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_size("text").alias("size"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("key"))
    narrow = stage(narrow, "texts")
    groups = stage(narrow.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    placed = narrow.join(assign_groups(groups, shards, block), "key")

    # Slots: number each piece of a shard, then add what stands before the piece. A
    # piece is a hash of row values, so no piece is larger for a hot text.
    pieces = max(8, -(-narrow.count() // (shards * SLOTS)))
    piece = F.pmod(F.xxhash64("doc_id", "key", "size"), F.lit(pieces))
    placed = stage(placed.withColumn("piece", piece), "placed")
    counts = placed.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("rows"))
    counts = counts.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("piece", "rows"))).alias("all"))
    offsets = counts.select("shard", F.explode("all").alias("p"), "all").select(
        "shard", F.col("p.piece").alias("piece"),
        F.aggregate(F.filter("all", lambda x: x["piece"] < F.col("p.piece")), F.lit(0).cast("long"), lambda s, x: s + x["rows"]).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("doc_id", "key")) - 1
    out = placed.withColumn("inside", inside).join(offsets, ["shard", "piece"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("offset") + F.col("inside")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
