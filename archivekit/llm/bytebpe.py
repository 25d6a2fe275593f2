"""Byte-level BPE by prefix dynamic programming.

Of every byte prefix of a piece the unique valid last token is stored (see merges.py).
Walking back over them gives the encoding. Appending bytes continues the table;
an edit recomputes from its first byte until the last tokens agree with the old ones
over the length of the longest token. Text is first split by a pattern, as rank files
of this kind ask for; each match is a piece of its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from archivekit.llm import text as T
from archivekit.llm.merges import Merges

#: Pieces up to this length go through the table many at a time, at most so many.
SIDE_BY_SIDE, COLUMNS = 48, 1 << 13
#: Bounds of what a worker remembers: entries, and characters of one.
REMEMBERED, REMEMBERED_CHARS = 100_000, 64
_FILTER_BITS = 22

#: Unicode's White_Space characters (fixed values).
_WHITE = "\t\n\v\f\r \x85\xa0  -     　"
#: White space with the word after it: no match of the pattern crosses such a unit's border.
_UNIT = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


class ByteBpe:
    """A vocabulary in rank order, read from a rank file."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as file:
            ranks = [(int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, file)]
        ranks.sort()
        if [r for r, _ in ranks] != list(range(len(ranks))):
            raise ValueError("ranks must be 0 to n-1")
        self.merges = Merges([token for _, token in ranks])
        self.tokens = self.merges.tokens
        self.sizes = np.array([len(t) for t in self.tokens])
        self.pattern = regex.compile(pattern)
        self._inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        usable = np.flatnonzero(self.merges.usable)
        keys = np.array([self._key(self.tokens[i]) for i in usable], np.uint64)
        order = np.argsort(keys)
        self._keys, self._ids = keys[order], usable[order]
        self._filter = np.zeros(1 << _FILTER_BITS, bool)
        self._filter[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self._lengths = sorted({len(self.tokens[i]) for i in usable})
        self._pieces: dict[str, bytes] = {}
        self._units: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    @staticmethod
    def _key(token: bytes) -> int:
        total = 0
        for i, byte in enumerate(token):
            total += (byte + 1) * pow(int(_ODD), i, 1 << 64)
        return total & (1 << 64) - 1

    def _table(self, pieces: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Last tokens of all prefixes, one piece a column; `sizes` fall, rows are padded."""
        m, n = pieces.shape
        up = np.cumprod(np.array([1, *[_ODD] * n], np.uint64))
        down = np.cumprod(np.array([1, *[self._inverse] * n], np.uint64))
        total = np.zeros((n + 1, m), np.uint64)
        np.cumsum((pieces.T.astype(np.uint64) + np.uint64(1)) * up[:n, None], axis=0, out=total[1:])
        last = np.full((n + 1, m), -1, np.int32)
        shift = np.uint64(64 - _FILTER_BITS)
        for j in range(1, n + 1):
            # Columns whose prefix of this length has no last token yet.
            left = np.arange(np.searchsorted(-sizes, -j, side="right"))
            for size in reversed([s for s in self._lengths if s <= j]):
                if not left.size:
                    break
                i = j - size
                keys = (total[j, left] - total[i, left]) * down[i]
                some = np.flatnonzero(self._filter[(keys >> shift).view(np.int64)])
                if not some.size:
                    continue
                keys = keys[some]
                at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
                hit = self._keys[at] == keys
                some, found = some[hit], self._ids[at[hit]]
                if i:
                    fits = self.merges.apart(last[i, left[some]], found)
                    some, found = some[fits], found[fits]
                last[j, left[some]] = found
                left = np.delete(left, some)
        return last

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids of each piece, as the bytes of little-endian 32-bit numbers."""
        out: list = [None] * len(pieces)
        many: list[int] = []
        for k, piece in enumerate(pieces):
            whole = self.merges.rank.get(piece)
            if whole is not None:  # a piece that is a token is that token
                out[k] = whole.to_bytes(4, "little")
            elif len(piece) <= SIDE_BY_SIDE:
                many.append(k)
            else:
                out[k] = Prefixes(self, piece).ids().tobytes()
        many.sort(key=lambda k: -len(pieces[k]))
        for first in range(0, len(many), COLUMNS):
            at = many[first : first + COLUMNS]
            n = len(pieces[at[0]])
            rows = np.frombuffer(b"".join(pieces[k].ljust(n, b"\0") for k in at), np.uint8).reshape(len(at), n)
            place = np.array([len(pieces[k]) for k in at])
            last = self._table(rows, place)
            ids, live = np.full((len(at), n), -1, np.int32), np.flatnonzero(place)
            for step in range(n - 1, -1, -1):
                if not live.size:
                    break
                ids[live, step] = last[place[live], live]
                place[live] -= self.sizes[ids[live, step]]
                live = live[place[live] > 0]
            held = ids >= 0
            flat, ends = ids[held].astype("<i4").tobytes(), (4 * np.cumsum(held.sum(1))).tolist()
            for k, a, b in zip(at, [0, *ends], ends):
                out[k] = flat[a:b]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of whole texts."""
        split = [_UNIT.findall(text) for text in texts]
        # Units used since the last change stay remembered, so common ones always do.
        if len(self._units) > REMEMBERED // 2:
            self._older, self._units = self._units, {}
        if len(self._pieces) > REMEMBERED:
            self._pieces.clear()
        new = set().union(*split).difference(self._units)
        again = new.intersection(self._older)
        self._units.update((u, self._older[u]) for u in again)
        new -= again
        # A blank and letters, or letters alone, are one match of the pattern.
        plain = [u for u in new if u.isalpha() or u[0] == " " and u[1:].isalpha()]
        pieces = {u: self.pattern.findall(u) for u in new.difference(plain)}
        fresh = list({p for found in pieces.values() for p in found if p not in self._pieces}.union(plain))
        now = dict(zip(fresh, self.encode_pieces([p.encode() for p in fresh])))
        long: dict[str, bytes] = {}
        for unit in plain:
            (self._units if len(unit) <= REMEMBERED_CHARS else long)[unit] = now[unit]
        for unit, found in pieces.items():
            ids = b"".join([now[p] if p in now else self._pieces[p] for p in found])
            (self._units if len(unit) <= REMEMBERED_CHARS else long)[unit] = ids
        self._pieces.update((p, now[p]) for found in pieces.values() for p in found if p in now and len(p) <= REMEMBERED_CHARS)
        get = {**long, **self._units}.__getitem__ if long else self._units.__getitem__
        return [np.frombuffer(b"".join(map(get, units)), "<i4") for units in split]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Prefixes:
    """The unique valid last token of every prefix of one piece."""

    def __init__(self, bpe: ByteBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", [-1]
        self.append(data)

    def _last(self, j: int) -> int:
        merges = self.bpe.merges
        for size in self.bpe._lengths:
            if size > j:
                break
            token = merges.rank.get(self.data[j - size : j])
            if token is not None and merges.usable[token] and (size == j or merges.fits(self.last[j - size], token)):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def append(self, more: bytes) -> None:
        """Exactly as if the piece had been encoded with `more` at its end."""
        self.data += more
        for j in range(len(self.last), len(self.data) + 1):
            self.last.append(self._last(j))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put `new` in place of bytes `start` to `end`; gives the prefixes computed anew."""
        old, shift, edited = self.last, len(new) - (end - start), start + len(new)
        self.data = self.data[:start] + new + self.data[end:]
        self.last, alike = old[: start + 1], 0
        for j in range(start + 1, len(self.data) + 1):
            self.last.append(self._last(j))
            alike = alike + 1 if j > edited and self.last[j] == old[j - shift] else 0
            if alike == self.bpe.merges.longest:
                self.last += old[j - shift + 1 :]
                return j - start
        return len(self.data) - start

    def ids(self) -> np.ndarray:
        out, j = [], len(self.data)
        while j:
            out.append(self.last[j])
            j -= len(self.bpe.tokens[out[-1]])
        return np.array(out[::-1], np.int32)


def load(path: str, pattern: str) -> ByteBpe:
    return T.kept((path, pattern), lambda: ByteBpe(path, pattern))


def encode_udf(path: str, pattern: str) -> Column:
    """Text to its token ids; null and empty texts give no ids."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path, pattern)
        for batch in batches:
            out = [pa.array([], pa.list_(pa.int32()))]
            for part in T.slices(batch):
                out.append(T.lists(bpe.encode([t or "" for t in part.to_pylist()]), pa.int32()))
            yield pa.concat_arrays(out)

    return encode


def digest_udf(path: str, pattern: str) -> Column:
    """Number of tokens, and SHA-256 of the ids as text and of the bytes decoded from them."""
    fields = ["n_tokens", "ids_sha256", "decoded_sha256"]

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path, pattern)
        spelled = [str(i) for i in range(len(bpe.tokens))]
        for batch in batches:
            out: list[list] = [[], [], []]
            for part in T.slices(batch):
                for ids in bpe.encode([t or "" for t in part.to_pylist()]):
                    ids = ids.tolist()
                    out[0].append(len(ids))
                    out[1].append(hashlib.sha256(" ".join(map(spelled.__getitem__, ids)).encode()).hexdigest())
                    out[2].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            kinds = pa.int64(), pa.string(), pa.string()
            yield pa.StructArray.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=fields)

    return digest


def decode_udf(path: str, pattern: str) -> Column:
    """Token ids to the bytes they stand for; null gives no bytes."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path, pattern)
        for batch in batches:
            yield pa.array([bpe.decode(ids.values.to_pylist()) if ids.is_valid else b"" for ids in batch], pa.binary())

    return decode
