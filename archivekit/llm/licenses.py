"""License statements in texts by conditional compression.

Candidate blocks are windows of words around cues, twice as long as a template may be
with its edits and half overlapping, so that each stretch lies whole in one of them;
they run over line ends and blank lines. A block that holds enough of a template's words
is compressed by zstandard, alone and with the template as raw dictionary. Templates
that save bytes enough, by a bound calibrated on wordings with the most edits allowed,
are confirmed by the exact wording: the words that must be put in, taken out or changed
between the template and a stretch of the block. Of the confirmed stretches, the likest
that do not overlap are given, each with the rank of its template among all by the share
of bytes saved on it.

The bound is three quarters of the least saving in `TRIALS` random wordings of a
template with the most edits allowed, so a confirmable stretch is missed only where its
edits hide it better than any of these did; stretches without any cue are no candidates.
"""

from __future__ import annotations

import random
import re
from array import array
from bisect import bisect, bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivekit.llm import text as T

#: Wordings of well-known licenses and notices (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Random wordings of a template by which its bound is set.
TRIALS = 100
#: A word that license wordings hold; blocks without one are no candidates.
CUE = re.compile(r"licen[sc]|copyright|permission|permitted|warrant|redistribut|public domain|free software|cc0|\bcc by", re.I)
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")

def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def stretches(template: list[str], block: list[str], most: int) -> list[tuple[int, int, int]]:
    """For each end of a stretch of the block within `most` word edits of the template: edits, begin, end.

    Of begins with equal edits it is the last one.
    """
    cost = [(0, -j) for j in range(len(block) + 1)]
    for i, w in enumerate(template):
        row = [(i + 1, 0)]
        for j, v in enumerate(block):
            row.append(min((cost[j][0] + (w != v), cost[j][1]), (cost[j + 1][0] + 1, cost[j + 1][1]), (row[j][0] + 1, row[j][1])))
        cost = row
    return [(edits, -begin, end) for end, (edits, begin) in enumerate(cost) if edits <= most and -begin < end]


class Scanner:
    """Templates ready for compression and for comparison by words."""

    def __init__(self, templates: dict[str, str], level: int = 3):
        import zstandard

        self.names = sorted(templates)
        self.words = {n: words(templates[n]) for n in self.names}
        self._plain = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False)
        self._with = {}
        for n in self.names:
            data = zstandard.ZstdCompressionDict(" ".join(self.words[n]).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self._with[n] = zstandard.ZstdCompressor(level=level, dict_data=data, write_checksum=False, write_content_size=False)
        self._number = {w: k for k, w in enumerate(sorted({w for ws in self.words.values() for w in ws}), 1)}
        self._holds = {n: np.zeros(len(self._number) + 1, bool) for n in self.names}
        for n in self.names:
            self._holds[n][[self._number[w] for w in self.words[n]]] = True
        self._bounds: dict[tuple[str, float], float] = {}
        self._known: dict[str, list] = {}

    def reductions(self, block: str) -> list[tuple[float, str]]:
        """Share of compressed bytes each template saves, best first."""
        data = " ".join(words(block)).encode()
        alone = len(self._plain.compress(data))
        return sorted(((1 - len(self._with[n].compress(data)) / alone, n) for n in self.names), key=lambda x: (-x[0], x[1]))

    def saved(self, name: str, said: list[str]) -> int:
        """Bytes by which the template makes the compressed block smaller."""
        data = " ".join(said).encode()
        return len(self._plain.compress(data)) - len(self._with[name].compress(data))

    def bound(self, name: str, least: float) -> float:
        """What a block saves at least that holds the template with the most edits."""
        if (name, least) not in self._bounds:
            target, rng = self.words[name], random.Random(f"{name} {least}")
            most = self.edits(name, least)
            other = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9)))
            savings = []
            for _ in range(TRIALS):
                near = list(target)
                for _ in range(most):
                    kind, at = rng.randrange(3), rng.randrange(len(near))
                    near[at : at + (kind != 1)] = [other()] if kind else []
                rest = max(0, 2 * (len(target) + most) - len(near))
                before = rng.randint(0, rest)
                savings.append(self.saved(name, [*(other() for _ in range(before)), *near, *(other() for _ in range(rest - before))]))
            self._bounds[name, least] = 0.75 * min(savings)
        return self._bounds[name, least]

    def edits(self, name: str, least: float) -> int:
        return int((1 - least) * len(self.words[name]) + 1e-9)

    def _near(self, name: str, said: list[str], numbers: np.ndarray, least: float) -> Iterator[tuple[int, int, int]]:
        """Stretches of `said` near one template, in the blocks which it makes small enough.

        A stretch with at most `most` edits has so many words more than the template at
        most, and all but so many of the template's words: other blocks are no candidates.
        """
        target, most = self.words[name], self.edits(name, least)
        size, need = len(target) + most, len(target) - most
        sums = np.concatenate([[0], np.cumsum(self._holds[name][numbers])])
        begins = np.arange(0, max(1, len(said) - size), size)
        ends = np.minimum(begins + 2 * size, len(said))
        bound = self.bound(name, least)
        runs: list[list[int]] = []
        for low, high in np.stack([begins, ends], 1)[sums[ends] - sums[begins] >= need].tolist():
            if (Counter(target) - Counter(said[low:high])).total() > most or self.saved(name, said[low:high]) < bound:
                continue
            if runs and low <= runs[-1][1]:
                runs[-1][1] = high
            else:
                runs.append([low, high])
        for low, high in runs:
            for edits, begin, end in stretches(target, said[low:high], most):
                yield edits, low + begin, low + end

    def winners(self, said: list[str], least: float) -> list[tuple[str, float, int, int, float, int, int]]:
        """(license, reduction, rank, edits, likeness, first word, end) of confirmed stretches that do not overlap, in order.

        The likest are taken first, then what is left between them is searched again.
        """
        numbers = np.array([self._number.get(w, 0) for w in said], np.int64)
        found, todo = [], [(0, len(said))]
        while todo:
            low, high = todo.pop()
            near = [
                (1 - edits / len(self.words[n]), n, edits, low + begin, low + end)
                for n in self.names for edits, begin, end in self._near(n, said[low:high], numbers[low:high], least)]
            taken: list[tuple[int, int]] = []
            for likeness, name, edits, begin, end in sorted(near, key=lambda x: (-x[0], -len(self.words[x[1]]), x[1], x[3])):
                at = bisect(taken, (begin, end))
                if (at and taken[at - 1][1] > begin) or (at < len(taken) and taken[at][0] < end):
                    continue
                taken.insert(at, (begin, end))
                saved = self.reductions(" ".join(said[begin:end]))
                rank = next(k for k, (_, n) in enumerate(saved) if n == name)
                found.append((name, saved[rank][0], rank + 1, edits, likeness, begin, end))
            if taken:
                todo += [(a, b) for a, b in zip([low, *(e for _, e in taken)], [*(b for b, _ in taken), high]) if a < b]
        return sorted(found, key=lambda x: x[5])

    def scan(self, text: str, least: float) -> list[dict]:
        """Confirmed licenses of a text, each with the lines it stands in."""
        cues = [m.start() for m in CUE.finditer(text)]
        if not cues:
            return []
        starts, ends = array("q"), array("q")
        for m in _WORD.finditer(text):
            starts.append(m.start())
            ends.append(m.end())
        reach = max(len(self.words[n]) + self.edits(n, least) for n in self.names)
        regions: list[list[int]] = []
        for cue in cues:
            at = bisect_left(ends, cue + 1)
            low, high = max(0, at - reach), min(len(starts), at + reach + 1)
            if regions and low <= regions[-1][1]:
                regions[-1][1] = max(high, regions[-1][1])
            else:
                regions.append([low, high])
        out: list[dict] = []
        for low, high in regions:
            if low == high:
                continue
            for name, saved, rank, edits, likeness, begin, end in self._winners([text[starts[i] : ends[i]].lower() for i in range(low, high)], least):
                first = text.rfind("\n", 0, starts[low + begin]) + 1
                last = text.find("\n", ends[low + end - 1])
                lines = text[first : last if last >= 0 else len(text)].rstrip("\r\n")
                out.append({
                    "license": name, "begin": first, "end": first + len(lines), "reduction": saved, "rank": rank,
                    "edits": edits, "likeness": likeness})
        return out

    def _winners(self, said: list[str], least: float) -> list[tuple]:
        """`winners` of a region, with memory for the short ones."""
        if len(said) > 400:
            return self.winners(said, least)
        key = f"{least} " + " ".join(said)
        if key not in self._known:
            if len(self._known) > 10_000:
                self._known.clear()
            self._known[key] = self.winners(said, least)
        return self._known[key]


def _scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return T.kept(templates, lambda: Scanner(dict(templates)))


FOUND = "array<struct<license: string, begin: bigint, end: bigint, reduction: double, rank: int, edits: int, likeness: double>>"


def scan_udf(templates: dict[str, str], least: float) -> Column:
    key = tuple(sorted(templates.items()))
    fields = [("license", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("reduction", pa.float64()), ("rank", pa.int32()), ("edits", pa.int32()), ("likeness", pa.float64())]
    kind = pa.list_(pa.struct(fields))

    @F.arrow_udf(FOUND)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = _scanner(key)
        for batch in batches:
            yield pa.array([scanner.scan(t.as_py() or "", least) for t in batch], kind)

    return scan


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """One row per confirmed stretch of `docs` (doc_id, text).

    Gives doc_id, license, begin and end (characters of the line that holds the stretch,
    or of all its lines if it is broken over several), reduction, rank (of the template by
    reduction), edits (words) and likeness (1 - edits / its words). Null and empty texts
    give no row; repeated rows give repeated rows. Of stretches that overlap the likest,
    of those alike the one of the longer template, then of the first by name is given.
    """
    found = scan_udf(templates or TEMPLATES, least)(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(found).alias("f")).select("doc_id", "f.*")
