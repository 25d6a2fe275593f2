"""Near-duplicate vectors by sorted projection passes.

In each pass, every vector gets a key: the signs of its products with random directions,
one after the other. Sorted by label and key, vectors of small angle tend to stand near
each other, and each is compared with its next `window` neighbours. The passes needed
for a target recall follow from the number of vectors: the more there are, the more
signs two vectors must share to stand within a window. Where more vectors than a window
holds share so many signs, all of them are compared, in tiles of bounded size that give
only what connects them: so the recall holds in dense labels too. Verified pairs of all
passes are united into components.

A window is bounded, but the links of a component are not: once components are known,
the vectors of each are compared with all of it, in tiles of bounded size, so links
between members of a large group that never stood in one window are counted too. Equal
vectors are one class throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivekit.llm.graph import components
from archivekit.operators.workspace import stage

#: Signs in a key.
BITS = 60
#: Rows compared in one task, and the side of a tile.
BLOCK, TILE = 4096, 1024


def signs_for(vectors: int, window: int) -> float:
    """Signs that leave about `window` of so many vectors together, if they are spread evenly."""
    return max(1.0, math.log2(max(2.0, vectors / window)))


def passes_for(vectors: int, window: int, cosine: float, recall: float) -> int:
    """Passes of which one gives two vectors at the threshold equal `signs_for` with probability `recall`."""
    share = 1 - math.acos(cosine) / math.pi
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - share ** signs_for(vectors, window))))


def _matrix(column) -> np.ndarray:
    """Unit vectors in double precision, one a row."""
    x = np.stack([np.asarray(v, np.float64) for v in column])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def keys_udf(passes: int, seed: int = 5):
    """For each pass, the signs of a vector's projections as one long."""

    @F.arrow_udf("array<bigint>")
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            out: list = [None] * len(batch)
            rows = batch.to_pylist()
            for n in {len(r) for r in rows}:
                if n not in planes:
                    planes[n] = np.random.default_rng([seed, n]).normal(size=(n, passes * BITS))
                at = [i for i, r in enumerate(rows) if len(r) == n]
                signs = (np.array([rows[i] for i in at], np.float64) @ planes[n] > 0).reshape(len(at), passes, BITS)
                values = signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                for i, v in zip(at, values.tolist()):
                    out[i] = v
            yield pa.array(out, pa.list_(pa.int64()))

    return keys


def _neighbours(window: int, cosine: float):
    """Verified pairs of a block of rows that stand in order."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank", ignore_index=True)
        found = []
        sizes = block["v"].map(len)
        for n in sizes.unique():
            rows = block[sizes == n]
            x, ids, run_of = _matrix(rows["v"]), rows["id"].to_numpy(), rows["label"].to_numpy()
            ranks, passes = rows["rank"].to_numpy(), rows["p"].to_numpy()
            for o in range(1, min(window, len(rows) - 1) + 1):
                near = np.flatnonzero(
                    (np.einsum("ij,ij->i", x[o:], x[:-o]) >= cosine) & (run_of[o:] == run_of[:-o])
                    & (passes[o:] == passes[:-o]) & (ranks[o:] - ranks[:-o] <= window))
                found.append(np.stack([ids[near], ids[near + o]], 1))
        pairs = np.unique(np.sort(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=1), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _forest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """As few of the near pairs of two sides as connect what all of them connect."""
    turned, rows, columns, links = near.T.copy(), near.any(1), np.ones(len(right), bool), []
    for i in np.flatnonzero(rows):
        if not rows[i]:
            continue
        rows[i], todo = False, [i]
        while todo:
            r = todo.pop()
            for c in np.flatnonzero(near[r] & columns):
                columns[c] = False
                links.append((left[r], right[c]))
                more = np.flatnonzero(turned[c] & rows)
                rows[more] = False
                links += [(left[m], right[c]) for m in more]
                todo += more.tolist()
    return links


def _connected(cosine: float):
    """Verified pairs that connect the vectors of each tile of a run of equal signs."""

    def run(tiles: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, rows in tiles.groupby(["tile", tiles["v"].map(len)], sort=False):
            left, right = rows[rows["here"] == rows["s"]], rows[rows["here"] == rows["t"]]
            if not len(left) or not len(right):
                continue
            near = _matrix(left["v"]) @ _matrix(right["v"]).T >= cosine
            if rows["s"].iloc[0] == rows["t"].iloc[0]:
                np.fill_diagonal(near, False)
            links += _forest(near, left["id"].to_numpy(), right["id"].to_numpy())
        pairs = np.unique(np.sort(np.array(links, np.int64).reshape(-1, 2), axis=1), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _dense_pairs(keyed: DataFrame, vectors: int, window: int, cosine: float) -> DataFrame:
    """Pairs within runs of equal label and first signs that are longer than a window, in every pass."""
    run = ["p", "label", "prefix"]
    keyed = keyed.withColumn("prefix", F.shiftright("key", BITS - int(signs_for(vectors, window))))
    # A run may hold a great part of all rows: its size goes to them in slices.
    slices = 16
    long_runs = keyed.groupBy(run).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > window + 1)
    long_runs = long_runs.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    rows = keyed.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int")).join(long_runs, [*run, "slice"])
    rows = rows.withColumn("k", F.ceil(F.col("size") / TILE).cast("int"))
    rows = rows.withColumn("here", F.pmod(F.xxhash64("id", "p"), F.col("k")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.withColumn("s", F.least("here", "other")).withColumn("t", F.greatest("here", "other"))
    rows = rows.withColumn("tile", F.xxhash64(*run, "s", "t"))
    crowd = max(1, -(-vectors // (4 * TILE))) * 4
    bucket = F.when(F.col("k") > 1, F.col("tile")).otherwise(F.pmod("tile", F.lit(crowd)))
    return rows.select(bucket.alias("bucket"), "tile", "here", "s", "t", "id", "v").groupBy("bucket").applyInPandas(
        _connected(cosine), "a long, b long")


def _tile(cosine: float):
    """Links of each vector within a tile: the rows of one side against the other."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, n), rows in tile.groupby(["root", tile["v"].map(len)], sort=False):
            left, right = rows[rows["here"] == rows["s"]], rows[rows["here"] == rows["t"]]
            if not len(left) or not len(right):
                continue
            near = _matrix(left["v"]) @ _matrix(right["v"]).T >= cosine
            same = int(rows["s"].iloc[0]) == int(rows["t"].iloc[0])
            if same:
                np.fill_diagonal(near, False)
            out.append(pd.DataFrame({"id": left["id"], "n": near @ right["copies"].to_numpy()}))
            if not same:
                out.append(pd.DataFrame({"id": right["id"], "n": near.T @ left["copies"].to_numpy()}))
        return pd.concat(out) if out else pd.DataFrame({"id": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64")})

    return run


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows in order of pass, label and key with their place, counted over all partitions."""
    order = ["p", "label", "key", "id"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("at", F.monotonically_increasing_id()), "sorted")
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # One row per partition.
    before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "before")
    return placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn(
        "rank", F.col("before") + inside).drop("at", "part", "before")


def _numbers(vectors: DataFrame) -> Column:
    """The components as they are, single or double; other kinds of numbers become double."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    return F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")


def near_vectors(
    vectors: DataFrame, cosine: float = 0.98, window: int = 32, recall: float = 0.999,
) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors are linked when their labels are equal and not null and their cosine, in
    double precision, reaches the threshold. Null, empty and zero vectors, and those with
    null or non-finite components, link with nothing, as do vectors of different length.
    Rows that repeat a vector under one vec_id are one vector and get equal rows; a
    vec_id with several vectors has each of them in its component. Rows without vec_id
    link with nothing, have no component and are kept.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), _numbers(vectors).alias("v"),
        F.col("label").cast("long").alias("label"))
    sound = F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0),
        F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # A class by its exact bytes; -0.0 and 0.0 are told apart, which only makes more classes.
    shape = F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.transform("v", lambda x: x.cast("string"))), 256)
    rows = stage(rows.withColumn("class", F.when(sound, F.unhex(shape))), "vectors")
    usable = rows.filter(F.col("class").isNotNull())
    members = usable.select("class", "vec_id").distinct()
    classes = members.groupBy("class").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    shapes = usable.groupBy("class").agg(F.first("v").alias("v"), F.first("label").alias("label"))
    # A class number of its own: a vec_id may have several vectors.
    classes = classes.join(shapes, "class").withColumn("id", F.xxhash64("class"))
    classes = stage(classes, "classes")

    n = classes.count()
    passes = passes_for(n, window, cosine, recall)
    keyed = classes.select("id", "label", "v", F.posexplode(keys_udf(passes)("v")).alias("p", "key"))
    ranked = _ranked(keyed)
    # Each block also holds the first rows of the next one, so no window is cut.
    block, rest = F.floor(F.col("rank") / BLOCK), F.col("rank") % BLOCK
    both = F.when((rest < window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    pairs = ranked.withColumn("block", F.explode(both)).groupBy("block").applyInPandas(
        _neighbours(window, cosine), "a long, b long")
    pairs = stage(pairs.union(_dense_pairs(keyed, n, window, cosine)).distinct(), "pairs")

    # Components over classes, and over classes that share a vec_id.
    numbered = members.join(classes.select("class", "id"), "class")
    several = numbered.groupBy("vec_id").agg(F.min("id").alias("a"), F.collect_set("id").alias("all")).filter(F.size("all") > 1)
    joined = several.select("a", F.explode("all").alias("b"))
    root = components(pairs.union(joined))
    root = root.union(root.select("root", "root").distinct()).toDF("id", "root")
    rooted = stage(root.join(classes, "id").select("id", "root", "least", "copies", "v", "label"), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("size"))

    # All links inside a component, tile by tile.
    sized = rooted.join(least, "root").withColumn("k", F.ceil(F.col("size") / TILE).cast("int"))
    here = F.pmod(F.xxhash64("id", F.lit(1)), F.col("k")).cast("int")
    tiles = sized.withColumn("here", here).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    tiles = tiles.withColumn("s", F.least("here", "other")).withColumn("t", F.greatest("here", "other"))
    # Components of one tile share tasks.
    crowd = max(1, -(-n // (4 * TILE)))
    bucket = F.when(F.col("k") > 1, F.xxhash64("root", "s", "t")).otherwise(F.pmod(F.xxhash64("root"), F.lit(crowd)))
    tiles = tiles.withColumn("bucket", bucket).withColumn("root", F.xxhash64("root", "s", "t", "label"))
    links = tiles.select("bucket", "root", "here", "s", "t", "id", "copies", "v").groupBy("bucket").applyInPandas(
        _tile(cosine), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))

    out = classes.select("class", "id", "least", "copies").join(links, "id", "left")
    out = out.join(rooted.select("id", "root"), "id", "left").join(least.select("root", "component"), "root", "left")
    out = out.select(
        "class", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "least").alias("component_id"))
    got = rows.select("vec_id", "class").join(out, "class", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
    return got.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
