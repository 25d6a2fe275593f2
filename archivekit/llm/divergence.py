"""How far the vocabulary of each source stands from the other sources of its language.

Terms are counted by a 64-bit digest of fixed width; strings stay where they are. Only
digests that are frequent enough to be kept get their strings, as the least and the
greatest one of all their occurrences. Where these differ, several terms share a digest:
such digests are counted again, split by string. Text comes back for the terms a report
shows, and for ties of their values.

Shares are whole numbers, p = 1 + floor(10^9 (count + 5) / (N + 5 V)), over the V kept
terms of a language with N occurrences in the group; nothing is rounded elsewhere. The
distance of two sources is the sum of |p - q| over all kept terms: each task adds up one
matrix of its terms over all pairs of sources, so no pair is ever a row before it is a
sum.

Null text, lang and source count as empty. A document without terms still makes its
group occur. Repeated rows are documents of their own. Long texts are taken whole. An
empty table gives no rows. Ties of value go by the item's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from archivekit.llm import text as T
from archivekit.operators.lookup import attach, attach_small
from archivekit.operators.workspace import stage
from archivekit.params import Params

#: Documents of its language a term must occur in, and terms a report shows.
MIN_DOCUMENTS, SHOWN = 30, 50
#: Scale and smoothing of a share.
SCALE, PRIOR = 1_000_000_000, 5
#: Kept digests sent to every task at most (there, some 300 bytes each with their strings);
#: more are joined by a shuffle, with the same result.
BROADCAST_DIGESTS = 500_000
#: Rows of counts that a task holds and adds up before it sends them on, rows sent at
#: once, digests whose strings it remembers if all are wanted, sources of a matrix's rows.
HELD, SENT, REMEMBERED, TILE = 1 << 19, 1 << 16, 100_000, 1024
#: Numbers held in matrices by a task before they are sent on.
MATRIX_NUMBERS = 8_000_000

#: Everything in ASCII but letters; what lies above it belongs to terms.
GAPS = np.array([c < 128 and not chr(c).isalpha() for c in range(256)])

_COUNTS = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("digest", pa.int64()), ("n", pa.int64()), ("docs", pa.int64()),
])
_STRINGS = pa.schema([("digest", pa.int64()), ("low", pa.string()), ("high", pa.string())])
_SPLIT = pa.schema([*_COUNTS, ("term", pa.string())])


def _digests(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, digest, begin, end and row of each term."""
    data, offsets = T.raw(column)
    hashes, starts, ends = T.words(data, offsets, GAPS)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return data, (hashes >> np.uint64(64 - bits)).view(np.int64), starts, ends, rows


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    at = 0
    for part in T.slices(batch.column(2)):
        yield batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part)), part
        at += len(part)


def _added(group: np.ndarray, digest: np.ndarray, n: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row for each (group, digest), with the sums of the others."""
    order = np.lexsort((digest, group))
    g, d = group[order], digest[order]
    new = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
    return g[new], d[new], np.add.reduceat(n[order], new), np.add.reduceat(docs[order], new)


def _counted(bits: int):
    """Counts of a slice at a time, added up over slices as far as `HELD` rows allow."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[tuple[str, str], int] = {}
        held: list[tuple[np.ndarray, ...]] = []

        def add_up() -> None:
            held[:] = [_added(*map(np.concatenate, zip(*held)))]

        def send() -> Iterator[pa.RecordBatch]:
            names = [pa.array(x, pa.string()) for x in zip(*number)]
            for g, d, n, docs in held:
                for a in range(0, len(g), SENT):
                    b = a + SENT
                    named = [pa.DictionaryArray.from_arrays(g[a:b], x).cast(pa.string()) for x in names]
                    yield pa.RecordBatch.from_arrays([*named, *map(pa.array, (d[a:b], n[a:b], docs[a:b]))], schema=_COUNTS)
            held.clear()
            number.clear()

        for batch in batches:
            for lang, source, texts in _slices(batch):
                _, digest, _, _, rows = _digests(texts, bits)
                if not len(digest):
                    continue
                of_row = [number.setdefault(p, len(number)) for p in zip(lang.to_pylist(), source.to_pylist())]
                group = np.array(of_row, np.int32)[rows]
                # Equal keys stay in the order of their rows, so a change of row is a document.
                order = np.lexsort((digest, group))
                g, d, r = group[order], digest[order], rows[order]
                first = np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])]
                new = np.flatnonzero(first)
                fresh = first | np.r_[True, r[1:] != r[:-1]]
                held.append((g[new], d[new], np.diff(np.r_[new, len(d)]), np.add.reduceat(fresh.astype(np.int64), new)))
                if sum(len(x[0]) for x in held) > HELD or len(number) > HELD:
                    add_up()
                    if len(held[0][0]) > HELD // 2 or len(number) > HELD // 2:
                        yield from send()
        if held:
            add_up()
            yield from send()

    return count


def _strings_of(data: np.ndarray, digest: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[int, tuple[bytes, bytes]]:
    """Least and greatest string of each digest; whole columns are compared with a digest's first."""
    order = np.argsort(digest, kind="stable")
    d, s, n = digest[order], starts[order], (ends - starts)[order]
    if not len(d):
        return {}
    new = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
    which = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(d)]))
    odd = n != n[new][which]
    like = np.flatnonzero(~odd)
    low = T.LOWER[data]
    step = np.arange(int(n[like].sum())) - np.repeat(np.cumsum(n[like]) - n[like], n[like])
    differ = low[np.repeat(s[like], n[like]) + step] != low[np.repeat(s[new][which[like]], n[like]) + step]
    odd[np.repeat(like, n[like])[differ]] = True
    raw = low.tobytes()
    found = {int(d[i]): (raw[s[i] : s[i] + n[i]],) * 2 for i in new}
    for i in np.flatnonzero(odd):
        word, (a, b) = raw[s[i] : s[i] + n[i]], found[int(d[i])]
        found[int(d[i])] = min(a, word), max(b, word)
    return found


def _described(bits: int, wanted: Broadcast | None):
    """(digest, low, high): once for each digest of a task, again where its range widens."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = None if wanted is None else wanted.value
        known: dict[int, tuple[bytes, bytes]] = {}
        for batch in batches:
            for texts in T.slices(batch.column(0)):
                data, digest, starts, ends, _ = _digests(texts, bits)
                if keep is not None and len(digest):
                    at = np.minimum(np.searchsorted(keep, digest), max(0, len(keep) - 1))
                    has = keep[at] == digest if len(keep) else np.zeros(len(digest), bool)
                    digest, starts, ends = digest[has], starts[has], ends[has]
                elif len(known) > REMEMBERED:
                    known.clear()
                out = []
                for k, (a, b) in _strings_of(data, digest, starts, ends).items():
                    c, e = known.get(k, (a, b))
                    if k not in known or a < c or b > e:
                        known[k] = min(a, c), max(b, e)
                        out.append((k, *known[k]))
                if out:
                    ids, low, high = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), *(pa.array([x.decode() for x in y], pa.string()) for y in (low, high))], schema=_STRINGS)

    return describe


def _split(bits: int, wanted: Broadcast):
    """Counts by string of the digests that several terms share."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = set(wanted.value.tolist())
        for batch in batches:
            for lang, source, texts in _slices(batch):
                data, digest, starts, ends, rows = _digests(texts, bits)
                raw, lang, source = T.LOWER[data].tobytes(), lang.to_pylist(), source.to_pylist()
                found: dict[tuple, list] = {}
                for i in np.flatnonzero(np.isin(digest, wanted.value)):
                    row = int(rows[i])
                    key = lang[row], source[row], int(digest[i]), raw[starts[i] : ends[i]]
                    n = found.setdefault(key, [0, 0, -1])
                    n[0] += 1
                    n[1] += n[2] != row
                    n[2] = row
                if found:
                    out = [(*k[:3], n[0], n[1], k[3].decode()) for k, n in found.items() if k[2] in keep]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SPLIT)], schema=_SPLIT)

    return split


def _numbers(df: DataFrame, column: str) -> np.ndarray:
    return np.sort(np.array([r[0] for r in df.select(column).collect()], np.int64))


KEY = ["digest", "term"]


def kept_terms(docs: DataFrame, min_documents: int, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Counts (lang, source, digest, term, n) of kept terms, and the string of each (digest, term).

    `term` is empty but where a digest had to be split; digests are told apart by it.
    """
    spark = docs.sparkSession
    counts = docs.mapInArrow(_counted(bits), "lang string, source string, digest bigint, n bigint, docs bigint")
    counts = stage(counts.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")

    def frequent(rows: DataFrame, *key: str) -> DataFrame:
        return rows.groupBy("lang", *key).agg(F.sum("docs").alias("_docs")).filter(F.col("_docs") >= min_documents).select("lang", *key)

    kept = stage(frequent(counts, "digest"), "kept")
    digests = stage(kept.select("digest").distinct(), "digests")
    texts = docs.select("text")
    if digests.count() <= BROADCAST_DIGESTS:
        strings = texts.mapInArrow(_described(bits, spark.sparkContext.broadcast(_numbers(digests, "digest"))), "digest bigint, low string, high string")
    else:
        strings = texts.mapInArrow(_described(bits, None), "digest bigint, low string, high string").join(digests, "digest", "left_semi")
    strings = stage(strings.groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high")), "strings")
    shared = stage(strings.filter("low <> high").select("digest"), "shared")

    whole = counts.join(kept, ["lang", "digest"], "left_semi").select("lang", "source", "digest", F.lit("").alias("term"), "n")
    names = strings.select("digest", F.lit("").alias("term"), F.col("low").alias("item"))
    if shared.isEmpty():
        return whole, names
    split = []
    # Almost always a single, tiny part; each is a pass over the texts.
    parts = 1 + shared.count() // BROADCAST_DIGESTS
    for k in range(parts):
        ids = _numbers(shared.filter(F.pmod(F.xxhash64("digest"), F.lit(parts)) == k), "digest")
        split.append(docs.mapInArrow(_split(bits, spark.sparkContext.broadcast(ids)), "lang string, source string, digest bigint, n bigint, docs bigint, term string"))
    again = split[0]
    for more in split[1:]:
        again = again.union(more)
    again = stage(again.groupBy("lang", "source", *KEY).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "split")
    again = again.join(frequent(again, *KEY), ["lang", *KEY], "left_semi").select("lang", "source", *KEY, "n")
    whole = whole.join(shared, "digest", "left_anti").select("lang", "source", *KEY, "n").union(again)
    names = names.join(shared, "digest", "left_anti").select(*KEY, "item").union(again.select(*KEY, F.col("term").alias("item")).distinct())
    return whole, names


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (N + 5 V)), in whole numbers of up to 38 digits."""
    top = (count + PRIOR).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(terms > 0, 1 + F.call_function("div", top, (total + PRIOR * terms).cast("decimal(20,0)")))


_SUMS = pa.schema([("lang", pa.string()), ("i", pa.int64()), ("j", pa.int64()), ("value", pa.int64())])


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of |p - q| over the terms of a task, for the pairs i < j of a language's sources."""
    sums: dict[tuple[str, int], np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, tile), total in sums.items():
            i, j = np.nonzero(np.triu(np.ones(total.shape, bool), 1 + tile * TILE))
            for a in range(0, len(i), 1 << 18):
                x, y = i[a : a + (1 << 18)], j[a : a + (1 << 18)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(x), pa.string()), pa.array(x + tile * TILE), pa.array(y), pa.array(total[x, y])], schema=_SUMS)
        sums.clear()

    for batch in batches:
        for row in range(batch.num_rows):
            lang, tile = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            base = batch.column(4)[row].values.to_numpy(zero_copy_only=False).astype(np.int64)
            p = base.copy()
            p[batch.column(2)[row].values.to_numpy(zero_copy_only=False)] = batch.column(3)[row].values.to_numpy(zero_copy_only=False)
            rows = p[tile * TILE : (tile + 1) * TILE]
            total = sums.get((lang, tile))
            if total is None:
                if sum(x.size for x in sums.values()) > MATRIX_NUMBERS:
                    yield from flush()
                total = sums[lang, tile] = np.zeros((len(rows), len(p)), np.int64)
            total += np.abs(rows[:, None] - p[None, :])
    yield from flush()


def audit(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, shown: int = SHOWN, bits: int = 64, params: Params = Params()
) -> DataFrame:
    """lang, source, part, item, value and rank of every group (lang, source) of `docs`.

    Part `pair` has each other source of the language with the distance to it; part
    `term` the `shown` kept terms whose share exceeds the language's most. `bits` of the
    digest are used; fewer only make more digests shared, never a wrong count.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(plain("lang"), plain("source"), plain("text"))
    counts, names = kept_terms(docs, min_documents, bits)
    counts = stage(counts, "kept-counts")
    of_lang = counts.groupBy("lang", *KEY).agg(F.sum("n").alias("all"))
    of_lang = stage(of_lang, "lang-counts")
    langs = of_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("terms", "lang_total", "total")])
    # Sources of a language: the report itself has a row for each pair of them.
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stage(groups.withColumns({"k": number, "p0": share(F.lit(0), F.col("total"), F.col("terms"))}), "groups")

    with_group = attach_small(counts, groups, ["lang", "source"], KEY, params)
    shares = with_group.select("lang", "source", *KEY, "n", "k", "lang_total", "terms", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    shares = stage(shares, "shares")
    pairs = _pairs(shares, groups, params)
    return pairs.union(_terms(shares, of_lang, names, shown, params))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def _pairs(shares: DataFrame, groups: DataFrame, params: Params) -> DataFrame:
    vectors = groups.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "p0"))), lambda x: x["p0"]).alias("base"))
    vectors = stage(vectors, "vectors")
    terms = shares.groupBy("lang", *KEY).agg(F.collect_list(F.struct("k", "p")).alias("held"))
    terms = attach_small(terms, vectors, ["lang"], ["digest"], params)
    tiles = F.explode(F.sequence(F.lit(0), F.floor((F.size("base") - 1) / TILE).cast("int")))
    sums = terms.select("lang", tiles.alias("tile"), F.col("held.k").alias("ks"), F.col("held.p").alias("ps"), "base").mapInArrow(
        _distances, "lang string, i bigint, j bigint, value bigint")
    sums = sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    sums = stage(sums.select("lang", F.explode(F.array(F.struct("i", "j", "value"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "value"))).alias("x")).select("lang", "x.*"), "distances")
    one = groups.select("lang", "source", F.col("k").alias("i"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("k").alias("j"))
    both = one.join(other, "lang").filter("i <> j").join(sums, ["lang", "i", "j"], "left")
    found = _ranked(both.select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("bigint")).alias("value")))
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")


def _terms(shares: DataFrame, of_lang: DataFrame, names: DataFrame, shown: int, params: Params) -> DataFrame:
    # A term of nearly every source is a hot row of neither side: at most one per source.
    rows = shares.join(of_lang, ["lang", *KEY])
    q = share(F.col("all"), F.col("lang_total"), F.col("terms"))
    rows = rows.select("lang", "source", *KEY, (F.col("p") - q).alias("value")).filter("value > 0")
    # Ties at the last place stay until their strings decide.
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    rows = rows.withColumn("_place", F.rank().over(best)).filter(F.col("_place") <= shown).drop("_place")
    named = attach(rows, names, KEY, ["lang", "source"], params)
    found = _ranked(named.select("lang", "source", "item", "value")).filter(F.col("rank") <= shown)
    return found.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
