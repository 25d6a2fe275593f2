"""Context-tree weighting over binary-decomposed bytes.

A text is its bytes in lower case and a closing symbol. Each byte is eight binary
decisions; each decision, under each context of the last 0 to `depth` bytes, is a node
with counts of zeros and ones over the training texts. A node's Krichevsky-Trofimov
estimate is mixed with the product of its deeper nodes' weighted probabilities by
halves, from the deepest level up; the mixing weights then give, from the top down, one
probability for each node. A text's probability is the product over its decisions, each
taken from the deepest node that the model holds.

Counting, weighting and both passes over the tree are DataFrame jobs over all texts, and
so are the costs of all codes (symbols in context) that occur in them; no node is left
out. Tasks hold the costs of the `most_codes` commonest codes only to save work: the
other codes of a text get theirs by a join with the whole table.

Beside it stands a unigram base: add-one estimates over lower-case words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivekit.llm import text as T
from archivekit.operators.workspace import discard, stage

DEPTH = 5
#: The closing symbol, a byte that no UTF-8 text holds.
END = 0xFF
#: Codes whose costs a scoring task holds, and words whose counts it holds; the others are joined.
MOST_CODES, MOST_WORDS = 1 << 21, 1 << 19
#: Nodes of a `bounded_model`, which `score_documents` does not use.
MOST_NODES = 2_000_000
#: Slots in which a worker remembers the cost of a byte in its context.
SLOTS = 1 << 21
_SLICE = 1 << 20
#: Codes and words of training texts, and codes of the others.
CODES, WORDS, OTHERS = 0, 1, 2


def training() -> Column:
    """Rows that are learned from; rows without doc_id are not."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2, F.lit(False))


def codes(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol with the `depth` bytes before it, as one number, and the symbols' offsets.

    The symbol is the lowest byte, the newest byte of the context the next one; what
    stands before a text counts as zeros.
    """
    rows = len(offsets) - 1
    padded = np.zeros(len(data) + rows * (depth + 1), np.uint8)
    ends = offsets[1:] + (depth + 1) * np.arange(1, rows + 1)  # one past each closing symbol
    kept = np.ones(len(padded), bool)
    begins = np.concatenate([[0], ends[:-1]])
    for k in range(depth):
        kept[begins + k] = False
    padded[ends - 1] = END
    inner = kept.copy()
    inner[ends - 1] = False
    padded[inner] = T.LOWER[data]
    out = np.zeros(len(padded), np.uint64)
    for k in range(depth + 1):
        out[k:] |= padded[: len(padded) - k].astype(np.uint64) << np.uint64(8 * k)
    return out[kept], offsets + np.arange(rows + 1)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys)
    keys, n = keys[order], np.concatenate([n for _, n in parts])[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def _counts(depth: int):
    """Counts of symbols in context, by whether the text (first column) is a training one (second), and of words of training texts."""
    kind = pa.schema([("kind", pa.int32()), ("code", pa.int64()), ("n", pa.int64())])

    def emit(k: int, parts: list) -> Iterator[pa.RecordBatch]:
        if parts:
            keys, n = _merged(parts)
            yield pa.record_batch([pa.array(np.full(len(keys), k, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {CODES: [], WORDS: [], OTHERS: []}
        for batch in batches:
            texts, taught = batch.column(0), batch.column(1)
            for part, kind in [(x, k) for k, mask in ((CODES, taught), (OTHERS, pc.invert(taught))) for x in T.slices(texts.filter(mask), _SLICE)]:
                data, offsets = T.raw(part)
                held[kind].append(np.unique(codes(data, offsets, depth)[0], return_counts=True))
                if kind == CODES:
                    hashes, _, _ = T.words(data, offsets)
                    held[WORDS].append(np.unique(hashes, return_counts=True))
                for k, parts in held.items():
                    if not parts:
                        continue
                    if len(parts) > 1 and sum(len(x) for x, _ in parts[1:]) > len(parts[0][0]) // 2 + 300_000:
                        held[k] = parts = [_merged(parts)]
                    if len(parts[0][0]) > 2_000_000:
                        yield from emit(k, parts)
                        held[k] = []
        for k, parts in held.items():
            yield from emit(k, [p for p in parts if len(p[0])])

    return run


def _ln_gamma(x: Column) -> Column:
    """Stirling's series, eight steps further on."""
    y, steps = x + 8, x
    for k in range(1, 8):
        steps = steps * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def _kt(zeros: Column, ones: Column) -> Column:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    some = _ln_gamma(zeros + 0.5) + _ln_gamma(ones + 0.5) - _ln_gamma(zeros + ones + 1.0) - math.log(math.pi)
    return F.when(zeros + ones == 0, 0.0).otherwise(some)


def weighted_tree(counts: DataFrame, depth: int = DEPTH, deepest: bool = False) -> list[DataFrame]:
    """(code, n) of symbols in context to the nodes of each depth: ctx, node, n, p.

    `node` is 1 followed by the bits of the symbol decided before; `p` is the
    probability that the next bit is 1 where this is the deepest node. Codes with n = 0
    are asked for without having been seen: they change no other node, and theirs have
    the `p` of the deepest node above that was seen. `deepest` keeps the last depth alone.
    """
    spark, weights, paths = counts.sparkSession, [], []
    bits = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k")
    symbol = F.col("code").bitwiseAND(F.lit(255))
    rows = counts.select(F.shiftright("code", 8).alias("ctx"), symbol.alias("s"), "n", bits)
    bit = F.expr("shiftright(s, 7 - k) & 1")
    rows = rows.select("ctx", F.expr("shiftleft(1L, k) | shiftright(s, 8 - k)").alias("node"),
                       F.when(bit == 0, F.col("n")).otherwise(0).alias("zeros"), F.when(bit == 1, F.col("n")).otherwise(0).alias("ones"))
    level = rows.groupBy("ctx", "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    level = level.withColumn("own", _kt(F.col("zeros"), F.col("ones")))
    level = level.withColumn("weighted", F.col("own")).withColumn("w", F.lit(1.0))
    levels = [stage(level, f"ctw{depth}", weights)]
    for d in range(depth - 1, -1, -1):
        up = levels[-1].withColumn("ctx", F.col("ctx").bitwiseAND(F.lit((1 << 8 * d) - 1)))
        up = up.groupBy("ctx", "node").agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("deeper"))
        up = up.withColumn("own", _kt(F.col("zeros"), F.col("ones")))
        gap = F.col("own") - F.col("deeper")
        larger = F.greatest("own", "deeper")
        up = up.withColumn("weighted", larger + F.log1p(F.exp(-F.abs(gap))) - math.log(2))
        up = up.withColumn("w", 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -gap))))).drop("deeper")
        levels.append(stage(up, f"ctw{d}", weights))
    levels.reverse()
    out, above = [], None
    kt = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    for d, level in enumerate(levels):
        level = level.withColumn("kt", kt)
        if above is None:
            level = level.withColumn("said", F.lit(0.0)).withColumn("rest", F.lit(1.0)).withColumn("up", F.lit(0.5))
        else:
            parent = F.col("ctx").bitwiseAND(F.lit((1 << 8 * (d - 1)) - 1))
            level = level.withColumn("parent", parent).join(above, ["parent", "node"])
        p = F.when(F.col("zeros") + F.col("ones") > 0, F.col("said") + F.col("rest") * F.col("kt")).otherwise(F.col("up"))
        level = level.select("ctx", "node", (F.col("zeros") + F.col("ones")).alias("n"), "kt", "w", "said", "rest", p.alias("p"))
        level = stage(level, f"path{d}", path := [])
        if deepest:
            discard(spark, paths)
            out.clear()
        paths = path
        above = level.select(
            F.col("ctx").alias("parent"), "node", (F.col("said") + F.col("rest") * F.col("w") * F.col("kt")).alias("said"),
            (F.col("rest") * (1 - F.col("w"))).alias("rest"), F.col("p").alias("up"))
        out.append(level.select("ctx", "node", "n", "p"))
    discard(spark, weights)
    return out


def _size() -> Column:
    return F.floor(F.log2("n")).cast("int").alias("b")


def _least(sizes: dict[int, int], most: int) -> int:
    """The least power of two that at most `most` counts reach; sizes: how many by power."""
    least, total = 0, sum(sizes.values())
    while total > most:
        total -= sizes.get(least, 0)
        least += 1
    return least


def _code_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs of codes from nodes (p of 0 and more) and codes (p of -1) that come in order of their contexts."""

    def costs(key: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
        node, wanted = p >= 0, key[p < 0]
        order = np.argsort(key[node])
        keys, values = key[node][order], p[node][order]
        ctx, symbol, total = wanted >> 8 << 8, wanted & 255, np.zeros(len(wanted))
        for k in range(8):
            at = np.searchsorted(keys, ctx | 1 << k | symbol >> 8 - k)
            one = (symbol >> 7 - k & 1).astype(bool)
            total += np.log10(np.clip(np.where(one, values[at], 1 - values[at]), 1e-9, 1.0))
        return pa.record_batch([pa.array(wanted), pa.array(total)], ["code", "cost"])

    key, p = np.zeros(0, np.int64), np.zeros(0)
    for batch in batches:
        key, p = np.concatenate([key, batch.column(0).to_numpy()]), np.concatenate([p, batch.column(1).to_numpy()])
        if len(key):
            done = int(np.searchsorted(key >> 8, key[-1] >> 8))  # the last context may go on
            yield costs(key[:done], p[:done])
            key, p = key[done:], p[done:]
    yield costs(key, p)


def code_costs(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(code, n) to (code, cost): log10 probability of each symbol in its context, by the whole tree.

    Nodes and codes of a context, at most 511, meet in one task.
    """
    level = weighted_tree(counts, depth, deepest=True)[-1]
    nodes = level.select(F.shiftleft("ctx", 8).bitwiseOR(F.col("node")).alias("key"), F.col("p"))
    both = nodes.union(counts.select("code", F.lit(-1.0)))
    return both.repartition(F.shiftright("key", 8)).sortWithinPartitions("key").mapInArrow(_code_costs, "code long, cost double")


def bounded_model(levels: list[DataFrame], most_nodes: int = MOST_NODES) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and probabilities of each depth, at most about `most_nodes` together.

    If there are more, nodes of the deeper levels below a count stay behind; the count
    is the least power of two that meets the bound.
    """
    sizes: dict[int, int] = {}
    for level in levels[2:]:
        for row in level.groupBy(_size()).count().collect():
            sizes[row["b"]] = sizes.get(row["b"], 0) + row["count"]
    least = _least(sizes, most_nodes)
    out = []
    for d, level in enumerate(levels):
        kept = level.filter(F.col("n") >= (1 << least)) if d >= 2 else level
        table = kept.select(F.shiftleft("ctx", 8).bitwiseOR(F.col("node")).alias("key"), F.col("p").cast("float").alias("p")).toArrow()
        keys = table["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        out.append((keys[order], table["p"].to_numpy()[order].astype(np.float32)))
    return out


class Scorer:
    """Costs of symbols in context under a bounded model, in log10."""

    def __init__(self, model: list[tuple[np.ndarray, np.ndarray]]):
        self.model, self.depth = model, len(model) - 1
        self._seen, self._cost = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.float32)

    def symbols(self, wanted: np.ndarray) -> np.ndarray:
        """log10 probability of each code, by its eight decisions."""
        total, ctx, symbol = np.zeros(len(wanted)), wanted >> np.uint64(8), wanted & np.uint64(255)
        for k in range(8):
            node = np.uint64(1 << k) | symbol >> np.uint64(8 - k)
            one = (symbol >> np.uint64(7 - k) & np.uint64(1)).astype(bool)
            p, open_ = np.full(len(wanted), 0.5), np.arange(len(wanted))
            for d in range(self.depth, -1, -1):
                keys, values = self.model[d]
                if not len(keys):
                    continue
                key = (ctx[open_] & np.uint64((1 << 8 * d) - 1)) << np.uint64(8) | node[open_]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                p[open_[hit]] = values[at[hit]]
                open_ = open_[~hit]
                if not open_.size:
                    break
            total += np.log10(np.clip(np.where(one, p, 1 - p), 1e-9, 1.0))
        return total

    def costs(self, wanted: np.ndarray) -> np.ndarray:
        """`symbols` with memory: a code has one slot of its two, or none."""
        out = np.zeros(len(wanted), np.float32)
        left, code = np.arange(len(wanted)), wanted + np.uint64(1)
        for shift in (40, 17):
            slot = (T.mix(code[left]) >> np.uint64(shift) & np.uint64(SLOTS - 1)).astype(np.int64)
            hit = self._seen[slot] == code[left]
            out[left[hit]] = self._cost[slot[hit]]
            left = left[~hit]
        if left.size:
            few, back = np.unique(wanted[left], return_inverse=True)
            cost = self.symbols(few)
            out[left] = cost[back]
            for shift in (40, 17):
                slot = (T.mix(few + np.uint64(1)) >> np.uint64(shift) & np.uint64(SLOTS - 1)).astype(np.int64)
                free = self._seen[slot] == 0 if shift == 40 else np.ones(len(slot), bool)
                self._seen[slot[free]], self._cost[slot[free]] = few[free] + np.uint64(1), cost[free]
                # Of several codes for one slot the last was written: costs go by what the slot holds.
                few, cost = few[~free], cost[~free]
        return out


_SCORED = [("n_tokens", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.int64())), ("cold", pa.list_(pa.int64()))]


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted number would be among sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def score_udf(held, depth: int):
    """Of each text: its tokens, those among the frequent ones and their log counts, the score of its common codes, the other words and codes."""

    @F.arrow_udf("struct<n_tokens: bigint, known: bigint, logs: double, score: double, rare: array<bigint>, cold: array<bigint>>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        common, cost, frequent, counts, end = held.value
        logs = np.log10(counts + 1.0)
        for batch in batches:
            out = [pa.array([], pa.struct(_SCORED))]
            for part in T.slices(batch, _SLICE):
                data, offsets = T.raw(part)
                wanted, ends = codes(data, offsets, depth)
                few, back = np.unique(wanted, return_inverse=True)
                at, hit = _found(common, few)
                held_cost = (np.where(hit, cost[at], 0.0) if len(common) else np.zeros(len(few)))[back]
                costs = np.concatenate([[0.0], np.cumsum(held_cost)])
                cold = ~hit[back]
                colds = np.concatenate([[0], np.cumsum(cold)])[ends]
                hashes, starts, _ = T.words(data, offsets)
                first = T.per_row(starts, offsets)
                at, hit = _found(frequent, hashes)
                sums = np.concatenate([[0.0], np.cumsum(np.where(hit, logs[at], 0.0))]) if len(frequent) else np.zeros(len(hashes) + 1)
                known = np.concatenate([[0], np.cumsum(hit)])
                others = np.concatenate([[0], np.cumsum(~hit)])[first]
                out.append(pa.StructArray.from_arrays([
                    pa.array(np.diff(first) + 1, pa.int64()), pa.array(known[first[1:]] - known[first[:-1]] + (end > 0), pa.int64()),
                    pa.array(sums[first[1:]] - sums[first[:-1]] + math.log10(end + 1)), pa.array(costs[ends[1:]] - costs[ends[:-1]]),
                    pa.ListArray.from_arrays(pa.array(others, pa.int32()), pa.array(hashes[~hit].view(np.int64), pa.int64())),
                    pa.ListArray.from_arrays(pa.array(colds, pa.int32()), pa.array(wanted[cold].view(np.int64), pa.int64())),
                ], names=[name for name, _ in _SCORED]))
            yield pa.concat_arrays(out)

    return score


def score_documents(docs: DataFrame, depth: int = DEPTH, most_codes: int = MOST_CODES, most_words: int = MOST_WORDS) -> DataFrame:
    """One row per row of `docs` (doc_id, text).

    Gives doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10
    probability of the text and its end) and bits_per_byte. Null texts count as empty;
    an empty text is its end alone. Repeated rows each teach and each get a row. Without
    training rows every decision has probability one half and every count is 0.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    taught = docs.filter(training())
    seen = docs.select("text", training().alias("taught")).mapInArrow(_counts(depth), "kind int, code long, n long")
    seen = stage(seen.groupBy("kind", "code").agg(F.sum("n").alias("n")), "counts")
    words = seen.filter(F.col("kind") == WORDS).select(F.col("code").alias("word"), "n")
    in_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    texts = taught.count()
    tokens, kinds = in_words + texts, distinct + (texts > 0)

    sizes = {r["b"]: r["count"] for r in words.groupBy(_size()).count().collect()}
    top = words.filter(F.col("n") >= 1 << _least(sizes, most_words)).toArrow()  # at most most_words pairs of numbers
    frequent = top["word"].to_numpy().view(np.uint64)
    order = np.argsort(frequent)
    asked = seen.filter(F.col("kind") != WORDS).groupBy("code").agg(
        F.sum(F.when(F.col("kind") == CODES, F.col("n")).otherwise(0)).alias("taught"), F.sum("n").alias("n"))
    asked = stage(asked, "codes")
    cost = stage(code_costs(asked.select("code", F.col("taught").alias("n")), depth), "costs")
    # Common over all texts, not over training ones: no code that is left to the join is a hot key.
    sizes = {r["b"]: r["count"] for r in asked.groupBy(_size()).count().collect()}
    common = asked.filter(F.col("n") >= 1 << _least(sizes, most_codes)).select("code").join(cost, "code").toArrow()  # at most most_codes pairs
    code, by = common["code"].to_numpy().view(np.uint64), np.argsort(common["code"].to_numpy().view(np.uint64))
    held = spark.sparkContext.broadcast((code[by], common["cost"].to_numpy()[by], frequent[order], top["n"].to_numpy()[order], texts))

    scored = docs.select("doc_id", (~training()).alias("held_out"), F.octet_length("text").alias("bytes"), score_udf(held, depth)("text").alias("s"))
    scored = scored.select("doc_id", "held_out", "bytes", "s.*", F.monotonically_increasing_id().alias("at"))
    scored = stage(scored, "scored")
    # Words outside the frequent ones: their counts come by a join; unseen ones add log10(1).
    rare = scored.select("at", F.explode("rare").alias("word")).groupBy("at", "word").agg(F.count(F.lit(1)).alias("times"))
    more = rare.join(words, "word").groupBy("at").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"))
    # So do the costs of codes outside the common ones.
    cold = scored.select("at", F.explode("cold").alias("code")).groupBy("at", "code").agg(F.count(F.lit(1)).alias("times"))
    rest = cold.join(cost, "code").groupBy("at").agg(F.sum(F.col("times") * F.col("cost")).alias("more_score"))
    out = scored.drop("rare", "cold").join(more, "at", "left").join(rest, "at", "left")
    out = out.withColumn("score", F.col("score") + F.coalesce("more_score", F.lit(0.0)))
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * math.log10(tokens + kinds + 1)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
        (-F.col("score") * math.log2(10) / (F.col("bytes") + 1)).alias("bits_per_byte"))
