"""Benchmark passages in documents by CGK embedding and bit-sampling LSH.

Texts are sequences of normalised words (letters and digits, lower case), and edits are
of words. The CGK embedding walks along a sequence: each step writes the word it stands
on and moves on or stays, as a random bit of the step and the word decides. Two
sequences of small edit distance get walks that agree at most steps, so the Hamming
distance of walks stands for the edit distance, and hashing a random sample of steps
finds near sequences: `TABLES` samples over each of several independent walks.

A window of a document is as long as the item it is compared with. Items are embedded
from each of their words on, documents from every `stride`-th; a document's probe that
meets an item's anchor fixes the window's place, up to the edits allowed. Every window
met is confirmed by the exact edit distance to its item.

The items are the query set. They are taken in blocks of bounded size; a block's anchors
are broadcast, and each block is one pass over the documents.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivekit.llm import text as T
from archivekit.operators.workspace import stage

#: Steps of a walk, steps sampled for a hash, and hashes for each of the walks. The
#: first walks are shorter, for short items and items with many edits.
WALKS = (12, 12, 18, 18, 26)
SAMPLES, TABLES = 6, 4
#: Words from one probe of a document to the next.
STRIDE = 3
#: Words after a meeting that are looked at first.
AHEAD = 12
#: Items whose anchors are broadcast together.
BLOCK = 4096
#: Words of a document that are walked at once.
SPAN = 1 << 17
#: Bits of the filter for each hash of an anchor.
_FILTER_BITS = 16


def _sampled() -> list[list[list[int]]]:
    """For each walk and table, the sampled steps."""
    rng = np.random.default_rng(2)
    return [[sorted(rng.choice(steps, SAMPLES, replace=False).tolist()) for _ in range(TABLES)] for steps in WALKS]


_STEPS = _sampled()
_MOVES = np.random.default_rng(22).integers(1, 1 << 63, (len(WALKS), max(WALKS)), dtype=np.uint64) | np.uint64(1)
_SALTS = np.random.default_rng(23).integers(1, 1 << 63, (len(WALKS), TABLES), dtype=np.uint64) | np.uint64(1)


def embed(words: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(table, hash of the sampled steps) of the walks that begin at `starts`.

    `words` must end with a closing value that stands for all that follows its end.
    """
    last = np.int64(len(words) - 1)
    for w, steps in enumerate(WALKS):
        at = starts.astype(np.int64)
        keys = [np.full(len(starts), _SALTS[w, t]) for t in range(TABLES)]
        for j in range(steps):
            here = words[at]
            for t in range(TABLES):
                if j in _STEPS[w][t]:
                    keys[t] = (keys[t] ^ here) * _SALTS[w, t]
            at += ((here * _MOVES[w, j]) >> np.uint64(63)).astype(np.int64)
            np.minimum(at, last, out=at)
        for t in range(TABLES):
            yield w * TABLES + t, keys[t] ^ (keys[t] >> np.uint64(29))


def found_probability(words: int, edits: int, trials: int = 400, seed: int = 5) -> float:
    """Share of random sequences with that many word edits whose window is found."""
    rng, hits = np.random.default_rng(seed), 0
    for _ in range(trials):
        item = rng.integers(0, 1 << 62, words).astype(np.uint64)
        seq = item.tolist()
        for _ in range(edits):
            kind, i = rng.integers(3), int(rng.integers(len(seq)))
            new = [] if kind == 0 else [int(rng.integers(1 << 62))]
            seq[i : i + (kind != 1)] = new
        before = rng.integers(0, 1 << 62, int(rng.integers(8, 30))).astype(np.uint64)
        after = rng.integers(0, 1 << 62, 30).astype(np.uint64)
        doc = np.concatenate([before, np.array(seq, np.uint64), after, [np.uint64(0)]])
        block = Block({0: item})
        hits += any(block.candidates(doc, np.array([0, len(doc) - 1])))
    return hits / trials


class Block:
    """The anchors of a block of items: item id to word hashes."""

    def __init__(self, items: dict[int, np.ndarray]):
        self.items = items
        self.counts = {k: dict(zip(*np.unique(v, return_counts=True))) for k, v in items.items()}
        owner, offset, place, at, keys = [], [], [], 0, [[] for _ in range(len(WALKS) * TABLES)]
        for k, words in items.items():
            # A walk that would leave the item tells nothing of the window.
            starts = np.arange(max(1, len(words) - 3))
            owner.append(np.full(len(starts), k))
            offset.append(starts)
            place.append(at + starts)
            at += len(words) + 1
            for t, h in embed(np.append(words, np.uint64(0)), starts):
                keys[t].append(h)
        self.owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        self.offset = np.concatenate(offset) if offset else np.zeros(0, np.int64)
        self.place = np.concatenate(place) if place else np.zeros(0, np.int64)
        #: All items' words, each item closed by a 0, and what the last walks look at.
        self.flat = np.concatenate([np.append(v, np.uint64(0)) for v in items.values()] + [np.zeros(AHEAD, np.uint64)])
        self.tables = []
        # One filter for the hashes of all tables, a bit each, as large as their number asks.
        wanted = max(1, _FILTER_BITS * len(self.owner) * len(keys))
        self.shift = np.uint64(64 - max(16, (wanted - 1).bit_length()))
        self.filter = np.zeros(1 << (61 - int(self.shift)), np.uint8)
        for part in keys:
            flat = np.concatenate(part) if part else np.zeros(0, np.uint64)
            order = np.argsort(flat, kind="stable")
            self.tables.append((flat[order], order))
            bit = flat >> self.shift
            np.bitwise_or.at(self.filter, (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))

    def _may_hold(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes >> self.shift
        return (self.filter[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & np.uint8(1)

    def candidates(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, item, word at which the window begins, counted in `words`)."""
        n = len(words) - 1
        seen: set[tuple[int, int, int]] = set()
        for low in range(0, n, SPAN):
            starts = np.arange(low, min(n, low + SPAN), STRIDE)
            for t, h in embed(words, starts):
                hit = np.flatnonzero(self._may_hold(h))
                if not hit.size:
                    continue
                keys, order = self.tables[t]
                a, b = np.searchsorted(keys, h[hit], "left"), np.searchsorted(keys, h[hit], "right")
                probe = np.repeat(starts[hit], b - a)
                anchor = order[np.arange(len(probe)) + np.repeat(a - np.cumsum(b - a) + (b - a), b - a)]
                near = self._alike(words, probe, anchor)
                for i, x in zip(probe[near].tolist(), anchor[near].tolist()):
                    row = int(np.searchsorted(first, i, "right")) - 1
                    # Probes of one window differ by its edits: one place in four is enough.
                    key = row, int(self.owner[x]), (i - int(self.offset[x])) // 4 * 4
                    if key not in seen:
                        seen.add(key)
                        yield key

    def _alike(self, words: np.ndarray, probe: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Whether half of the item's next words stand near their places in the document.

        Walks also meet over words that are frequent everywhere; this sorts such meetings
        out by whole columns before any window is looked at.
        """
        total, count = np.zeros(len(probe), np.int64), np.zeros(len(probe), np.int64)
        open_ = np.ones(len(probe), bool)
        for o in range(AHEAD):
            here = self.flat[self.place[anchor] + o]
            open_ &= here != 0
            found = np.zeros(len(probe), bool)
            for shift in range(-2, 3):
                found |= words[np.clip(probe + o + shift, 0, len(words) - 1)] == here
            total += found & open_
            count += open_
        return 2 * total >= count

    def matches(self, words: np.ndarray, first: np.ndarray, percent: int) -> dict[tuple[int, int], tuple[int, int]]:
        """(row, item) to (edits, first word) of its best confirmed window."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for row, item, at in self.candidates(words, first):
            target = self.items[item]
            most = len(target) * (100 - percent) // 100
            if best.get((row, item), (1,))[0] == 0:
                continue
            low = max(int(first[row]), at - most)
            window = words[low : min(int(first[row + 1]), at + 4 + len(target) + most)]
            counts = self.counts[item]
            if sum(min(c, counts.get(w, 0)) for w, c in zip(*np.unique(window, return_counts=True))) < len(target) - most:
                continue
            edits, begin = within(target, window)
            if edits <= most:
                best[row, item] = min(best.get((row, item), (len(target), 0)), (edits, low + begin - int(first[row])))
        return best


def within(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Least word edits from the whole item to any stretch of the window, and where it begins."""
    cost = [(0, j) for j in range(len(window) + 1)]
    for i, w in enumerate(item.tolist()):
        row = [(i + 1, 0)]
        for j, v in enumerate(window.tolist()):
            row.append(min((cost[j][0] + (w != v), cost[j][1]), (cost[j + 1][0] + 1, cost[j + 1][1]), (row[j][0] + 1, row[j][1])))
        cost = row
    return min(cost)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = T.raw(column)
    hashes, starts, _ = T.words(data, offsets, T.NOT_ALNUM)
    return np.append(hashes, np.uint64(0)), T.per_row(starts, offsets)


MATCHES = "array<struct<item_id: bigint, edits: int, first_word: bigint, item_words: int>>"


def match_udf(block, percent: int) -> Column:
    """Confirmed items of each text, one entry per item."""
    fields = [("item_id", pa.int64()), ("edits", pa.int32()), ("first_word", pa.int64()), ("item_words", pa.int32())]
    kind = pa.list_(pa.struct(fields))

    @F.arrow_udf(MATCHES)
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        anchors = _loaded(block)
        for batch in batches:
            out = []
            for part in T.slices(batch, 1 << 20):
                words, first = _words(part)
                rows: list[list[dict]] = [[] for _ in range(len(part))]
                for (row, item), (edits, at) in sorted(anchors.matches(words, first, percent).items()):
                    rows[row].append(dict(zip(("item_id", "edits", "first_word", "item_words"), (item, edits, at, len(anchors.items[item])))))
                out += rows
            yield pa.array(out, kind)

    return match


def _loaded(block) -> Block:
    ids, words, ends = block.value
    key = hashlib.md5(words.tobytes() + ids.tobytes()).hexdigest()
    return T.kept(key, lambda: Block({int(k): words[ends[i] : ends[i + 1]] for i, k in enumerate(ids)}))


def blocks_of(benchmark: DataFrame, size: int = BLOCK) -> Iterator:
    """Broadcasts of at most `size` items: ids, word hashes and where each item's begin.

    Items without words can't be found and are left out; of items that share an id,
    each distinct text stays a target, under that id.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    count = max(1, math.ceil(items.count() / size))
    dealt = stage(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count))), "items")
    for k in range(count):
        rows = sorted(dealt.filter(F.col("block") == k).select("item_id", "text").collect())
        words, first = _words(pa.array([r["text"] for r in rows], pa.string()))
        keep = [i for i in range(len(rows)) if first[i + 1] > first[i]]
        if keep:
            ends = np.cumsum([0, *(first[i + 1] - first[i] for i in keep)])
            flat = np.concatenate([words[first[i] : first[i + 1]] for i in keep])
            yield spark.sparkContext.broadcast((np.array([rows[i]["item_id"] for i in keep]), flat, ends))


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """One row per document and item whose words it holds with at most 20 % edits.

    Gives doc_id, item_id, edits, item_words, first_word (of the window, in words of the
    document) and similarity (1 - edits / item_words). Null and empty texts hold nothing;
    repeated rows give repeated results.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for anchors in blocks_of(benchmark, block):
        found = texts.select("doc_id", F.explode(match_udf(anchors, percent)("text")).alias("m")).select("doc_id", "m.*")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = texts.select("doc_id", F.explode(F.array().cast(MATCHES)).alias("m")).select("doc_id", "m.*")
    return out.withColumn("similarity", 1 - F.col("edits") / F.col("item_words"))


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """The rows of `docs` that hold no item, with their columns as they are."""
    names = docs.columns
    for anchors in blocks_of(benchmark, block):
        mark = match_udf(anchors, percent)(F.col("text").cast("string"))
        docs = docs.withColumn("__found", F.size(mark)).filter("__found = 0").select(*names)
    return docs
