"""Near-duplicate documents by chosen paths over minwise tokens.

Every document is a set of word shingles, known by `POSITIONS` minwise tokens. A tree
starts with all documents in one node. At a node, a hash of its path chooses one or
two positions; documents that hold the same token there go to the same child. A node
of at most `limit` documents is compared exhaustively, larger ones branch again; an
edge found anywhere is confirmed on the full sets. Two documents of similarity s stay
together over one position with probability s, so independent trees are repeated to
reach a target recall.

Large nodes of close copies would hardly shrink. So each large node first compares
its members with its smallest one, and once components are known, nodes that hold a
single component are left: no link in them could join anything new. A node whose
members outside its main component are few compares those with everyone, which is
linear in its size, and is done. What is still large at the deepest level is compared
on full sets, members outside the main component with everyone, in tiles that give no
more links than connect their members. Nothing is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from archivekit.llm import text as T
from archivekit.llm.graph import components
from archivekit.operators.workspace import stage

#: Minwise tokens of a set; 16 of them, at four bits each, fill one long.
POSITIONS = 64
LONGS = POSITIONS // 16
#: Members on one side of a tile of a large node, and tokens compared at once there.
TILE, _COLUMNS = 256, 4096
_KEYS = np.random.default_rng(8).integers(1, 1 << 63, POSITIONS, dtype=np.uint64) | np.uint64(1)

SKETCH = "struct<n: bigint, f1: bigint, f2: bigint, tokens: array<int>>"


def trees_for(similarity: float, recall: float) -> int:
    """Trees that find a pair of this similarity with probability `recall`.

    At the threshold a pair survives one level with probability of at least
    s/2 + (1 - (1 - s)^2)/2, as one or two positions are chosen alike; two levels are
    assumed, as deeper ones hold only what the components have not settled.
    """
    level = similarity / 2 + (1 - (1 - similarity) ** 2) / 2
    return math.ceil(math.log(1 - recall) / math.log(1 - level**2))


def sketch_udf(size: int) -> Column:
    """Size, 128-bit fingerprint and minwise tokens of a text's shingle set."""

    @F.arrow_udf(SKETCH)
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        T.kept("neardup", bool)  # lets go of another operator's tables
        for batch in batches:
            parts = [_sketch(part, size) for part in T.slices(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct(_FIELDS))

    return sketch


_FIELDS = [("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("tokens", pa.list_(pa.int32()))]


def _sketch(column: pa.Array, size: int) -> pa.Array:
    data, offsets = T.raw(column)
    hashes, starts, _ = T.words(data, offsets)
    sets = T.shingles(hashes, T.per_row(starts, offsets), size)
    counts = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(counts)
    tokens = np.zeros((len(sets), POSITIONS), np.int32)
    prints = np.zeros((2, len(sets)), np.uint64)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        at = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        for k, key in enumerate(_KEYS):
            low = np.minimum.reduceat(flat * key, at)
            tokens[full, k] = (low >> np.uint64(16)).astype(np.uint32).view(np.int32)
        prints[0, full] = np.add.reduceat(T.mix(flat + np.uint64(1)), at)
        prints[1, full] = np.add.reduceat(T.mix(flat ^ _KEYS[0]), at)
    held = np.arange(0, (len(full) + 1) * POSITIONS, POSITIONS)
    ends = np.zeros(len(sets) + 1, np.int32)
    ends[1:] = np.cumsum(np.where(counts > 0, POSITIONS, 0))
    assert ends[-1] == held[-1]
    return pa.StructArray.from_arrays(
        [
            pa.array(counts), pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens[full].ravel())),
        ],
        names=[name for name, _ in _FIELDS],
    )


def sets_udf(size: int) -> Column:
    """The full shingle set of a text as sorted distinct 64-bit hashes."""

    @F.arrow_udf("array<bigint>")
    def full(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        T.kept("neardup", bool)
        for batch in batches:
            out = [pa.array([], pa.list_(pa.int64()))]
            for part in T.slices(batch):
                data, offsets = T.raw(part)
                hashes, starts, _ = T.words(data, offsets)
                found = T.shingles(hashes, T.per_row(starts, offsets), size)
                out.append(T.lists([s.view(np.int64) for s in found], pa.int64()))
            yield pa.concat_arrays(out)

    return full


def _agreeing(a: Column, b: Column) -> Column:
    """Positions at which two sketches agree in their four kept bits."""
    total = F.lit(0)
    for k in range(LONGS):
        x = a[f"b{k}"].bitwiseXOR(b[f"b{k}"])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x1111111111111111))
        total = total + (16 - F.bit_count(x))
    return total


def _least_agreeing(similarity: float) -> int:
    """A pair at the threshold agrees at fewer positions once in 30,000 times."""
    p = similarity + (1 - similarity) / 16
    return math.floor(POSITIONS * p - 4 * math.sqrt(POSITIONS * p * (1 - p)))


def _member() -> Column:
    """A document's id with four bits of each of its tokens."""
    longs = [
        F.aggregate(
            F.slice("tokens", 16 * k + 1, 16), F.lit(0).cast("long"),
            lambda acc, x: F.shiftleft(acc, 4).bitwiseOR(x.bitwiseAND(F.lit(15)).cast("long")),
        ).alias(f"b{k}")
        for k in range(LONGS)
    ]
    return F.struct(F.col("id"), *longs).alias("m")


def _branch(rows: DataFrame) -> DataFrame:
    """(node, id, tokens) to (node, id) of the children."""
    first = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(POSITIONS)).cast("int")
    second = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(POSITIONS)).cast("int")
    both = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(2)) == 0
    places = F.when(both & (first != second), F.array(first, second)).otherwise(F.array(first))
    children = F.transform(places, lambda p: F.xxhash64("node", p, F.get("tokens", p)))
    return rows.select("id", F.explode(children).alias("node"))


def _pairs_within(groups: DataFrame, least: int) -> DataFrame:
    """(a, b) with a < b out of small arrays `ms` sorted by id."""
    one = groups.select(F.posexplode("ms").alias("i", "x"), "ms")
    two = one.select("x", F.explode(F.expr("slice(ms, i + 2, size(ms))")).alias("y"))
    return two.filter((F.col("x.id") < F.col("y.id")) & (_agreeing(F.col("x"), F.col("y")) >= least)).select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _few_with_all(held: DataFrame, cores: DataFrame, least: int) -> DataFrame:
    """Pairs of the few members outside a node's main component with all its members."""
    rows = held.join(cores, "node")
    few = rows.filter(F.col("root") != F.col("core")).groupBy("node").agg(F.collect_list("m").alias("few"))
    near = F.filter("few", lambda x: (x["id"] != F.col("m.id")) & (_agreeing(x, F.col("m")) >= least))
    met = held.join(few, "node").select("m", F.explode(near).alias("x"))
    return met.select(F.least("m.id", "x.id").alias("a"), F.greatest("m.id", "x.id").alias("b"))


def _same_sets(size: int, percent: int):
    """Exact comparison of a tile: the roots that links between its two sides join.

    Enough of them are given to connect what the tile connects, so the answer never
    outgrows the tile.
    """

    def run(tile):
        import pandas as pd  # only where tiles are compared: sketching does without

        n = tile["set"].map(len).to_numpy()
        flat = np.concatenate([np.asarray(x, np.int64) for x in tile["set"]])
        tokens, back, times = np.unique(flat, return_inverse=True, return_counts=True)
        place = np.cumsum(times > 1) - 1  # a token of one set is in no intersection
        row = np.repeat(np.arange(len(tile)), n)
        held = times[back] > 1
        row, column = row[held], place[back[held]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        shared = np.zeros((len(tile), len(tile)), np.float32)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
            i, j = np.searchsorted(column, [low, low + _COLUMNS])
            part = np.zeros((len(tile), _COLUMNS), np.float32)
            part[row[i:j], column[i:j] - low] = 1
            shared += part @ part.T
        union = n[:, None] + n[None, :] - shared
        roots, root = np.unique(tile["root"].to_numpy(), return_inverse=True)
        linked = (100 * shared >= percent * union) & (root[:, None] < root[None, :])
        pairs = np.unique(np.stack([root[k] for k in np.nonzero(linked)], 1), axis=0)
        parent, out = list(range(len(roots))), []
        for x, y in pairs.tolist():
            ends = []
            for v in (x, y):
                while parent[v] != v:
                    parent[v] = parent[parent[v]]
                    v = parent[v]
                ends.append(v)
            if ends[0] != ends[1]:
                parent[max(ends)] = min(ends)
                out.append((roots[x], roots[y]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _promising(least: int):
    """Members of a tile whose sketch is like that of a member of another component.

    A tile meets in sketches of 40 bytes a member first: full sets, which may be as long
    as texts, travel only to tiles in which they may be linked, by the test that
    candidates pass in small nodes too.
    """

    def run(tile):
        total = np.zeros((len(tile), len(tile)), np.int16)
        for k in range(LONGS):
            bits = tile[f"b{k}"].to_numpy(np.int64).view(np.uint64)
            x = bits[:, None] ^ bits[None, :]
            x |= x >> np.uint64(2)
            x |= x >> np.uint64(1)
            total += np.int16(16) - np.bitwise_count(x & np.uint64(0x1111111111111111))
        root = tile["root"].to_numpy()
        found = ((total >= least) & (root[:, None] != root[None, :])).any(axis=1)
        return tile.loc[found, ["node", "s", "t", "id", "root"]].drop_duplicates()

    return run


def _tiled(docs: DataFrame, big: DataFrame, size: int, percent: int, least: int, broadcast_ids: int) -> DataFrame:
    """Links between components within large nodes, by full sets in tiles of bounded size.

    Two members of a node's main component have nothing to join. So only the members
    outside it, in tiles, meet each other and the tiles of the main component: of that,
    a member's sketch is copied for each tile of the others, and its full set for those
    tiles where it may have a link. Nodes that hold one component by now are left out.
    """
    counts = big.groupBy("node", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("node").agg(
        F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all")).filter("all > top.n")
    tiles = lambda n: F.ceil(n / TILE).cast("int")
    parts = stage(counts.select(
        "node", F.col("top.root").alias("core"), tiles(F.col("all") - F.col("top.n")).alias("k"), tiles(F.col("top.n")).alias("cores")), "mixed")
    main = F.col("root") == F.col("core")
    own = F.pmod(F.xxhash64("id", F.lit(5)), F.when(main, F.col("cores")).otherwise(F.col("k"))).cast("int")
    bits = [F.col(f"m.b{j}").alias(f"b{j}") for j in range(LONGS)]
    rows = big.join(parts, "node").select("node", "id", "root", *bits, "k", "cores", main.alias("main"), own.alias("own"))
    # Tiles are numbered: first those of the others, then those of the main component.
    k, own = F.col("k"), F.col("own")
    cell = lambda s, t: F.struct(s.cast("int").alias("s"), t.cast("int").alias("t"))
    others = F.sequence(F.lit(0), k - 1)
    met = F.when(F.col("main"), F.transform(others, lambda i: cell(i, k + own))).otherwise(F.concat(
        F.transform(others, lambda i: cell(F.least(i, own), F.greatest(i, own))),
        F.transform(F.sequence(F.lit(0), F.col("cores") - 1), lambda i: cell(own, k + i)),
    ))
    bits = [f"b{j}" for j in range(LONGS)]
    dealt = rows.select("node", "id", "root", *bits, F.explode(met).alias("x")).select("node", "id", "root", *bits, "x.s", "x.t")
    dealt = dealt.groupBy("node", "s", "t").applyInPandas(_promising(least), "node long, s int, t int, id long, root long")
    dealt = stage(dealt, "promising")
    sets = _sets(docs, dealt.select(F.col("id").alias("doc_id")).distinct(), size, broadcast_ids)
    return dealt.join(sets, "id").groupBy("node", "s", "t").applyInPandas(_same_sets(size, percent), "a long, b long")


def _sets(docs: DataFrame, ids: DataFrame, size: int, broadcast_ids: int) -> DataFrame:
    """(id, set) of the documents with these distinct ids (doc_id) that have words, from a staged table."""
    ids = stage(ids, "ids")
    ids = F.broadcast(ids) if ids.count() <= broadcast_ids else ids
    some = docs.join(ids, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), sets_udf(size)("text").alias("set"))
    # A filter on what is written: on `some` itself it would run the UDF once more, in Python
    # workers of its own.
    return stage(some, "sets").filter(F.size("set") > 0)


def _confirmed(docs: DataFrame, pairs: DataFrame, size: int, percent: int, broadcast_ids: int) -> DataFrame:
    """Of staged candidate pairs, those whose full sets reach the threshold."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    some = _sets(docs, ids, size, broadcast_ids)
    left = pairs.join(some.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    both = left.join(some.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    union = F.size("set_a") + F.size("set_b") - F.col("shared")
    return both.withColumn("shared", shared).filter((union > 0) & (100 * F.col("shared") >= percent * union)).select("a", "b")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, recall: float = 0.995, limit: int = 16,
    few: int = 48, levels: int | None = None, broadcast_ids: int = 2_000_000,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Texts without words, and null texts, have no shingles and link with nothing. Rows
    that share a doc_id are one document: any of them links it. Rows without doc_id
    have no component and are kept. Ties and repeated rows get the same component.
    """
    spark: SparkSession = docs.sparkSession
    T.bound_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    least, trees = _least_agreeing(percent / 100), trees_for(percent / 100, recall)

    sketches = docs.select("doc_id", sketch_udf(size)("text").alias("s")).select("doc_id", "s.*")
    sketches = stage(sketches, "sketches")
    named = sketches.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = stage(named.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("id")), "classes")
    # One row per class; equal sets have equal tokens.
    reps = named.join(classes.withColumnRenamed("id", "doc_id"), ["f1", "f2", "n", "doc_id"], "left_semi")
    reps = reps.select(F.col("doc_id").alias("id"), "tokens").dropDuplicates(["id", "tokens"])
    reps = stage(reps.select("id", "tokens", _member()), "reps")

    # Copies of one document under several sets hold together by its id.
    same = named.join(classes, ["f1", "f2", "n"]).filter(F.col("doc_id") != F.col("id")).select(
        F.col("id").alias("a"), F.col("doc_id").alias("b"))
    shared_ids = named.groupBy("doc_id").agg(
        F.min("f1").alias("lo"), F.max("f1").alias("hi"), F.min("f2").alias("lo2"), F.max("f2").alias("hi2"))
    several = shared_ids.filter((F.col("lo") != F.col("hi")) | (F.col("lo2") != F.col("hi2"))).select(
        F.col("doc_id").alias("b"))
    forced = stage(same.join(several, "b", "left_semi").select("a", "b"), "forced")

    # Two levels sort out documents that share frequent shingles by chance, unless there
    # are very many; what is large below them is dense.
    levels = levels or max(2, math.ceil(math.log(max(2, reps.count()) / few) / math.log(500)))
    known = rows = None
    for level in range(1, levels + 1):
        if level == 1:
            roots = F.array(*[F.xxhash64(F.lit(8), F.lit(t)) for t in range(trees)])
            rows = _branch(reps.select("id", "tokens", F.explode(roots).alias("node")))
        else:
            rows = _branch(rows.join(reps, "id").select("node", "id", "tokens"))
        rows = rows.distinct() if level > 1 else rows
        rows = stage(rows, f"level{level}")
        nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        held = rows.join(nodes, "node").join(reps.select("id", "m"), "id")
        if known is not None:
            held = held.join(known.withColumnRenamed("v", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        held = stage(held, f"held{level}")
        most = limit if level == 1 else few
        small = held.filter(F.col("size") <= most).groupBy("node").agg(F.sort_array(F.collect_list("m")).alias("ms"))
        pairs = _pairs_within(small, least)
        big = held.filter(F.col("size") > most)
        if known is not None:
            parts = big.groupBy("node", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("node").agg(
                F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all")).filter("all > top.n")
            parts = stage(parts.select("node", F.col("top.root").alias("core"), (F.col("all") - F.col("top.n")).alias("others")), "parts")
            pairs = pairs.union(_few_with_all(big, parts.filter(F.col("others") <= few).select("node", "core"), least))
            big = big.join(parts.filter(F.col("others") > few).select("node"), "node", "left_semi")
        if level < levels:
            hub = big.groupBy("node").agg(F.min("m").alias("x"))
            met = big.select("node", F.col("m").alias("y")).join(hub, "node").filter(F.col("x.id") < F.col("y.id"))
            met = met.filter(_agreeing(F.col("x"), F.col("y")) >= least).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
            pairs = pairs.union(met)
        if known is not None:
            pairs = _across(pairs, known).join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs.distinct(), f"pairs{level}")
        tested = pairs if level == 1 else tested.union(pairs)
        known = _settle(docs, pairs, forced if level == 1 else None, known, size, percent, broadcast_ids)
        rows = big.select("node", "id")
        if rows.isEmpty():
            break
        if level == levels:
            dense = big.drop("root").join(known.withColumnRenamed("v", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
            more = stage(_tiled(docs, dense, size, percent, least, broadcast_ids).distinct(), "dense")
            known = _joined(known, more)

    out = sketches.join(classes, ["f1", "f2", "n"], "left")
    out = out.join(known.withColumnRenamed("v", "id"), "id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "id", "doc_id")).alias("component_id")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _across(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    for end in ("a", "b"):
        pairs = pairs.join(known.select(F.col("v").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    return pairs.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _settle(docs, pairs, forced, known, size, percent, broadcast_ids) -> DataFrame:
    """Confirm candidates and extend the components.

    At the first level, one pair for each larger end, to its smallest partner: that
    settles most groups. Then every pair that still lies between two components.
    """
    if known is None:
        star = stage(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "star")
        known = components(_confirmed(docs, star, size, percent, broadcast_ids).union(forced))
        pairs = stage(_across(pairs.join(star, ["a", "b"], "left_anti"), known), "rest")
    if pairs.isEmpty():
        return known
    new = stage(_confirmed(docs, pairs, size, percent, broadcast_ids), "edges")
    return _joined(known, new)


def _joined(known: DataFrame, edges: DataFrame) -> DataFrame:
    """Components extended by staged edges."""
    if edges.isEmpty():
        return known
    return components(edges.union(known.select(F.col("v").alias("a"), F.col("root").alias("b"))))
