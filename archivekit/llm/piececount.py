"""Token counts of a piece vocabulary by a compiled finite-state transducer.

The count of tokens of a prefix follows from the last tokens of shorter prefixes (see
merges.py). What the future needs of a prefix is: for each suffix that may still grow
to a token, where it stands in the trie of tokens, the last token before it, and how
many tokens fewer stand before it. That is a state; each character leads to one next
state and adds a number of tokens, which annotates the transition. States are compiled
when first met.

Tokens never cross from a word to the blank after it, so every such border leads to
the same state. A chunk of a text is then a map: its head, up to the first border,
waits for the state before it; the rest has a count; its tail is the state at its end.
Maps compose, pairwise in any grouping, and long texts are counted in parallel chunks.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivekit.llm import text as T
from archivekit.llm.merges import Merges
from archivekit.operators.workspace import stage

BLANK = "▁"
_SEGMENT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
#: Bounds of what a worker keeps; beyond them it starts anew.
STATES, REMEMBERED, REMEMBERED_CHARS = 150_000, 600_000, 64

Map = tuple[str, int, str, bool]  # head, tokens between, tail, whether a border lies within


class Transducer:
    """Deterministic transducer that counts the tokens of a segment."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        ids.sort(key=lambda i: (-model.get_score(i), i))
        pieces = [model.id_to_piece(i) for i in ids]
        if any(BLANK in p[1:] and p.strip(BLANK) for p in pieces):
            raise ValueError("a piece reaches across a word's end")
        scores = {p: model.get_score(i) for p, i in zip(pieces, ids)}
        plain = [scores[p] for p in pieces if len(p) > 1 and p.strip(BLANK)]
        if len(set(plain)) < len(plain):
            raise ValueError("pieces share a rank")
        #: Runs of blanks may share a rank, in which case the leftmost pair goes first.
        self.scores = scores
        self.merges = Merges(pieces)
        self.trie: list[dict[str, int]] = [{}]
        self.token: list[int] = [-1]
        for token, piece in enumerate(pieces):
            if self.merges.usable[token] and (BLANK not in piece[1:]):
                at = 0
                for c in piece:
                    if c not in self.trie[at]:
                        self.trie[at][c] = len(self.trie)
                        self.trie.append({})
                        self.token.append(-1)
                    at = self.trie[at][c]
                self.token[at] = token
        self._fits: dict[tuple[int, int], bool] = {}
        self._counts: dict[str, int] = {}
        self._restart()

    def _restart(self) -> None:
        start = ((0, -1, 0),)
        self._ids, self._states, self._next = {start: 0}, [start], [{}]

    def _apart(self, u: int, t: int) -> bool:
        if u < 0:  # the start, or a character spelled in bytes: it merges with nothing
            return True
        if (u, t) not in self._fits:
            self._fits[u, t] = self.merges.fits(u, t)
        return self._fits[u, t]

    def _step(self, state: int, c: str) -> tuple[int, int]:
        """Compile one transition: the next state and the tokens it adds."""
        grown, last, added = [], -1, None
        for node, before, fewer in self._states[state]:
            child = self.trie[node].get(c)
            if child is None:
                continue
            token = self.token[child]
            if added is None and token >= 0 and self._apart(before, token):
                last, added = token, fewer + 1
            if self.trie[child]:
                grown.append((child, before, fewer))
        if added is None:
            grown, added = [], len(c.encode("utf-8", "surrogatepass"))
        after = (*((node, before, fewer - added) for node, before, fewer in grown), (0, last, 0))
        number = self._ids.get(after)
        if number is None:
            number = self._ids[after] = len(self._states)
            self._states.append(after)
            self._next.append({})
        self._next[state][c] = number, added
        return number, added

    def run(self, segment: str) -> int:
        """Tokens of one segment."""
        state, total, steps = 0, 0, self._next
        for c in segment:
            to = steps[state].get(c) or self._step(state, c)
            state = to[0]
            total += to[1]
        return total

    def _merged(self, symbols: str) -> int:
        """Tokens of a segment that starts with several blanks, by plain merging.

        Pairs of blanks share a rank; the leftmost then goes first.
        """
        parts, after = list(symbols), list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(parts) and (joined := parts[i] + parts[j]) in self.scores:
                heapq.heappush(heap, (-self.scores[joined], i, joined))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= len(parts) or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, ""
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return sum(1 if p in self.scores else len(p.encode("utf-8", "surrogatepass")) for p in parts if p)

    def _new(self, segment: str) -> int:
        if len(self._states) > STATES:
            self._restart()
        return self._merged(segment) if segment.startswith(BLANK * 2) else self.run(segment)

    def count(self, text: str) -> int:
        """Tokens of a text that starts at a border."""
        segments = _SEGMENT.findall(text.replace(" ", BLANK))
        known, total = self._counts, 0
        if len(known) > REMEMBERED:
            known.clear()
        for s in segments:
            n = known.get(s)
            if n is None:
                n = self._new(s)
                if len(s) <= REMEMBERED_CHARS:
                    known[s] = n
            total += n
        return total

    def map(self, chunk: str) -> Map:
        """The map of a chunk whose surroundings are unknown."""
        found = _SEGMENT.findall(chunk.replace(" ", BLANK))
        if len(found) < 3:
            return "".join(found), 0, "", False
        return found[0], self.count("".join(found[1:-1])), found[-1], True

    def compose(self, one: Map, two: Map) -> Map:
        """The map of two chunks in a row."""
        met = (one[2] if one[3] else one[0]) + two[0]
        found = _SEGMENT.findall(met)
        if one[3] and two[3]:
            return one[0], one[1] + self.count(met) + two[1], two[2], True
        if one[3]:
            return one[0], one[1] + self.count("".join(found[:-1])), found[-1], True
        if two[3]:
            return found[0], self.count("".join(found[1:])) + two[1], two[2], True
        return self.map(met)

    def total(self, m: Map) -> int:
        return self.count(m[0]) + m[1] + self.count(m[2])

    def scan(self, maps: list[Map]) -> int:
        """Tokens of a text from its chunks' maps, composed in pairs."""
        while len(maps) > 1:
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])]
            maps = pairs + maps[len(pairs) * 2 :]
        return self.total(maps[0]) if maps else 0


def load(path: str) -> Transducer:
    return T.kept(path, lambda: Transducer(path))


def count_udf(path: str) -> Column:
    """Tokens of a whole text; null and empty texts have none."""

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = load(path)
        for batch in batches:
            yield pa.array([machine.count(BLANK + t.as_py()) if t.is_valid and len(t.as_py()) else 0 for t in batch], pa.int64())

    return count


_MAP = "struct<head: string, n: bigint, tail: string, inner: boolean>"


def map_udf(path: str) -> Column:
    """The map of each chunk."""

    @F.arrow_udf(_MAP)
    def maps(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = load(path)
        kind = pa.struct([("head", pa.string()), ("n", pa.int64()), ("tail", pa.string()), ("inner", pa.bool_())])
        for batch in batches:
            found = (machine.map(t.as_py() or "") for t in batch)
            yield pa.array([dict(zip(("head", "n", "tail", "inner"), m)) for m in found], kind)

    return maps


def scan_udf(path: str) -> Column:
    """Arrays of (position, map) to the tokens of the texts."""

    @F.arrow_udf("bigint")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = load(path)
        for batch in batches:
            rows = ([(x["m"]["head"], x["m"]["n"], x["m"]["tail"], x["m"]["inner"]) for x in row.as_py()] for row in batch)
            yield pa.array([machine.scan(row) for row in rows], pa.int64())

    return scan


def token_counts(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens", chunk: int = 1 << 20) -> DataFrame:
    """Adds the number of tokens of each text, without added begin, end or special tokens.

    Texts of up to `chunk` characters are counted where they stand; longer ones are cut
    into chunks, which are mapped in parallel and composed. Null and empty texts count
    0. Repeated rows and any other columns stay as they are.
    """
    df, long = df.drop(out), F.length(text) > chunk
    short = df.filter(~F.coalesce(long, F.lit(False))).withColumn(out, count_udf(path)(text))
    some = df.filter(long)
    if some.isEmpty():
        return short
    # Written with its row numbers, which a task that runs again would give anew.
    rows = stage(some.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "long")
    body = F.concat(F.lit(BLANK), F.col(f"row.{text}"))
    starts = F.sequence(F.lit(0), F.length(body) - 1, F.lit(chunk))
    chunks = rows.select("at", F.posexplode(F.transform(starts, lambda i: F.substring(body, i + 1, F.lit(chunk)))).alias("k", "part"))
    maps = chunks.repartition(F.col("at"), F.col("k")).select("at", "k", map_udf(path)("part").alias("m"))
    parts = maps.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("k", "m"))).alias("ms"))
    counted = parts.select("at", scan_udf(path)("ms").alias("n"))
    whole = rows.join(counted, "at").select("row.*", F.col("n").alias(out))
    return short.unionByName(whole)
