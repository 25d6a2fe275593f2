"""Toxicity, decontamination, license scans and language-model scores."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from archivekit.llm import ctw, decontaminate, licenses, toxicity

WORDS = "the quick brown fox jumps over lazy dog near river bank while small birds sing".split()
BAD = ["moron", "scum", "idiot"]


@pytest.fixture(scope="module")
def labelled(spark):
    import random

    rng, docs, labels = random.Random(3), [], []
    for k in range(600):
        toxic = k % 4 == 0
        text = [rng.choice(WORDS) for _ in range(30)]
        if toxic:
            text[rng.randrange(30)] = rng.choice(BAD)
        docs.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    sly = ["you 1d10t here", "what a m0r0n", "s c u m of the river", "i.d.i.o.t", "moooooron bank", "$cum bank"]
    docs += [(1000 + k, t) for k, t in enumerate(sly)] + [(2000, "the quick brown fox"), (2001, ""), (2002, None)]
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_rows_and_obfuscated_words(labelled):
    docs, labels = labelled
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(got) == docs.count()
    for k in range(600):
        assert got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1)
        assert got[k]["predicted"] == (k % 4 == 0), got[k]
    assert all(got[1000 + k]["predicted"] == 1 for k in range(6))
    assert all(got[k]["predicted"] == 0 and 0 <= got[k]["score"] <= 1 for k in (2000, 2001, 2002))


def test_long_and_short_spaced_runs_are_decoded():
    words = "you are such an idiot and the whole river bank knows that you are an idiot".split()
    table = np.full((64, 64, 64), -9.0, np.float32)
    for w in [*words, "bad"]:
        z = [0, 0, *(toxicity._CODE[c] for c in w), 0, 0]
        for x in zip(z, z[1:], z[2:]):
            table[x] = -1.0
    decoder = toxicity.Decoder(table)
    spaced = ".".join("idiot" * 20)
    assert len(spaced) > 128 and decoder.restored(spaced) != spaced
    assert "idiot" * 20 in decoder.terms(spaced)
    assert decoder.restore("b a d") == "bad"
    assert decoder.restored("i" + "d" * 100 + "iot") == "idiot"


def test_labels_of_held_out_rows_are_not_used(labelled):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted((r["doc_id"], round(r["score"], 9)) for r in toxicity.score_documents(docs, x).collect()) for x in (labels, turned))
    assert one == two


def test_toxicity_of_odd_rows(spark, odd, empty, labelled):
    none = labelled[1].limit(0)
    got = toxicity.score_documents(odd, none).collect()
    assert len(got) == odd.count() and all(r["predicted"] == 0 for r in got)
    assert toxicity.score_documents(empty, labelled[1]).count() == 0
    assert set(odd.columns) <= set(got[0].asDict())


def test_decoding_is_the_likeliest_path():
    rng = np.random.default_rng(1)
    model = np.log(rng.dirichlet(np.ones(toxicity.CODES), (toxicity.CODES, toxicity.CODES)))
    decoder = toxicity.Decoder(model)

    def cost(said):
        a = b = 0
        total = 0.0
        for c in said:
            z = toxicity._CODE.get(c, 0 if c == " " else toxicity._OTHER)
            total, a, b = total + model[a][b][z], b, z
        return total + model[a][b][0]

    for word in ("1d10t", "aaab$", "m-0-r", "$$x!", "l l l o", "b@@d"):
        paths = [("", 0.0)]
        for ways in decoder.lattice(word):
            paths = [(said + letters, paid + c) for said, paid in paths for letters, c in ways]
        assert decoder.decode(word) in {said for said, paid in paths if cost(said) - paid >= max(cost(s) - p for s, p in paths) - 1e-9}


# --- decontamination ---------------------------------------------------------

def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        i = rng.randrange(len(out))
        out[i : i + 1] = rng.choice([[], [f"x{rng.randrange(99)}"], [out[i], f"y{rng.randrange(99)}"]])
    return out


def test_windows_within_the_edits_are_found(spark, rng):
    vocabulary = [f"v{k}" for k in range(2000)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {k: some(rng.randint(15, 60)) for k in range(30)}
    docs, want, not_wanted = [], set(), set()
    for d in range(150):
        item = d % 30
        edits = rng.choice([0, 1, 2, len(items[item]) // 8, len(items[item]) // 2])
        docs.append((d, " ".join(some(rng.randint(0, 80)) + edited(rng, items[item], edits) + some(20)).title()))
        if edits <= len(items[item]) // 5:
            want.add((d, item))
    docs += [(1000 + d, " ".join(some(100))) for d in range(50)]
    benchmark = spark.createDataFrame([(k, ", ".join(v)) for k, v in items.items()], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.contaminated(frame, benchmark, block=7).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(want - found) <= len(want) // 50
    # Brute force: the exact edit distance over every stretch of the text.
    texts = dict(docs)
    for r in got:
        target = np.array([hash(w) for w in items[r["item_id"]]])
        window = np.array([hash(w.lower()) for w in texts[r["doc_id"]].split()])
        assert decontaminate.within(target, window)[0] == r["edits"] <= len(target) // 5
    left = {r["doc_id"] for r in decontaminate.clean(frame, benchmark).collect()}
    assert left == set(texts) - {d for d, _ in found}


def test_recall_of_short_items():
    assert decontaminate.found_probability(15, 3, 150) >= 0.9
    assert decontaminate.found_probability(40, 8, 100) >= 0.9


def test_decontamination_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "the cat sat on the mat!"), (2, None), (3, ""), (None, "word")], "item_id long, text string")
    got = decontaminate.contaminated(odd, items).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"], r["edits"]) for r in got) == [(0, 1, 0), (1, 1, 0), (1, 1, 0)]
    assert decontaminate.clean(odd, items).columns == odd.columns
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(odd, items.limit(0)).count() == 0
    assert decontaminate.clean(odd, items.limit(0)).count() == odd.count()


# --- licenses ----------------------------------------------------------------

def test_licenses_by_compression_and_wording(spark, empty):
    mit = licenses.TEMPLATES["MIT-text"]
    rows = [
        (1, "Intro.\nLicensed under the Apache License, Version 2.0.\nMore."), (2, "nothing here"), (3, None), (4, ""),
        (5, "text\n\n" + mit.replace("free of charge", "without charge").replace(" obtaining", "\nobtaining") + "\n\nend"),
        (6, "This work is licensed under the GNU General Public License, version 2."),
        (7, "A license is a permission to do what the law would forbid."), (8, "Licensed under CC BY-NC 4.0."),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.license_scan(frame).collect()}
    assert {k: (r["license"], r["edits"]) for k, r in got.items()} == {
        1: ("Apache-2.0", 0), 5: ("MIT-text", 2), 6: ("GPL-2.0", 0), 8: ("CC-BY-NC-4.0", 0)}
    text = dict(rows)[1]
    assert text[got[1]["begin"] : got[1]["end"]] == "Licensed under the Apache License, Version 2.0."
    assert all(0 < r["reduction"] < 1 and r["rank"] == 1 for r in got.values())
    assert licenses.license_scan(empty).count() == 0


MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
"""
APACHE = """ Licensed under the Apache License, Version 2.0 (the "License");
 you may not use this file except in compliance with the License.
 You may obtain a copy of the License at

     http://www.apache.org/licenses/LICENSE-2.0

 Unless required by applicable law or agreed to in writing, software
 distributed under the License is distributed on an "AS IS" BASIS,
 WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 See the License for the specific language governing permissions and
 limitations under the License.
"""


def test_licenses_in_their_usual_layout():
    scan = licenses.Scanner(licenses.TEMPLATES).scan
    for text, name in ((MIT, "MIT-text"), (BSD, "BSD-text"), (APACHE, "Apache-2.0-header")):
        padded = "Words before it.\n\n" + text + "\n\nAnd after.\n"
        (found,) = scan(padded, 0.8)
        assert found["license"] == name and found["likeness"] > 0.95 and found["rank"] == 1
        held = padded[found["begin"] : found["end"]]
        assert licenses.words(licenses.TEMPLATES[name])[-1] in held.lower() and "before" not in held and "after" not in held


def every_wording(scanner, said, least):
    """Brute force: every template against every stretch."""
    return {(n, e) for n in scanner.names for e, _, _ in licenses.stretches(scanner.words[n], said, scanner.edits(n, least))}


def test_compression_decides_and_misses_hardly_any(rng):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    noise = [f"word{k}" for k in range(500)] + "the of and to in under this license software for any with".split()
    wanted = found = 0
    for trial in range(150):
        name = rng.choice(scanner.names)
        near = list(scanner.words[name])
        for _ in range(rng.randint(0, scanner.edits(name, 0.8))):
            at = rng.randrange(len(near))
            near[at : at + rng.randint(0, 1)] = [rng.choice(noise)][: rng.randint(0, 1)]
        said = [rng.choice(noise) for _ in range(rng.randint(0, 80))] + near + [rng.choice(noise) for _ in range(rng.randint(0, 80))]
        numbers = np.array([scanner._number.get(w, 0) for w in said])
        exact = {n for n, _ in every_wording(scanner, said, 0.8)}
        got = {n for n in scanner.names for _ in scanner._near(n, said, numbers, 0.8)}
        assert got <= exact
        wanted, found = wanted + len(exact), found + len(got)
    assert wanted > 100 and found >= 0.99 * wanted
    text = "Licensed under the Apache License, Version 2.0."
    assert scanner.scan(text, 0.8)
    scanner.saved = lambda name, said: 0
    assert not scanner.scan(text + " ", 0.8) or scanner.bound("Apache-2.0", 0.8) <= 0


def test_licenses_of_repeated_rows_clashing_columns_and_long_texts(spark):
    long = "some words here " * 200_000 + "Released under the MIT License. " + "and more words " * 100_000
    rows = [(1, "Released under the MIT License.", "x", 3)] * 2 + [(2, long, "y", 4), (None, "Licensed under CC BY 4.0.", "z", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, license string, rank int")
    got = sorted((r["doc_id"] or 0, r["license"], r["edits"]) for r in licenses.license_scan(frame).collect())
    assert got == [(0, "CC-BY-4.0", 0), (1, "MIT", 0), (1, "MIT", 0), (2, "MIT", 0)]


def test_every_license_of_long_lines_and_of_one_line(rng):
    scan = licenses.Scanner(licenses.TEMPLATES).scan
    noise = [f"word{k}" for k in range(2000)] + "the of and to in under this license software".split()
    for name, wording in licenses.TEMPLATES.items():
        for n in (50, 2500):
            line = [rng.choice(noise) for _ in range(n)]
            got = scan(" ".join([*line, wording, *line]), 0.8)
            assert (name, 0) in {(x["license"], x["edits"]) for x in got}, (name, n, got)
    text = "Licensed under the Apache License, Version 2.0. Released under the MIT License."
    assert [(x["license"], x["edits"]) for x in scan(text, 0.8)] == [("Apache-2.0", 0), ("MIT", 0)]
    text = "Released under the\nMIT License. Licensed under CC BY-NC 4.0.\nunder the MIT License"
    assert [(x["license"], x["edits"]) for x in scan(text, 0.8)] == [("MIT", 0), ("CC-BY-NC-4.0", 0), ("MIT", 1)]


# --- context-tree weighting --------------------------------------------------

def brute_ctw(texts, depth):
    """Node counts and weighted probabilities by definition."""
    nodes = {}
    for text in texts:
        data = bytes(depth) + text.lower().encode() + bytes([ctw.END])
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                for k in range(8):
                    node = nodes.setdefault((data[i - d : i], 1 << k | data[i] >> 8 - k), [0, 0])
                    node[data[i] >> 7 - k & 1] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    weighted, gap = {}, {}
    for (ctx, node), (a, b) in sorted(nodes.items(), key=lambda x: -len(x[0][0])):
        own = kt(a, b)
        if len(ctx) == depth:
            weighted[ctx, node] = own
        else:
            deeper = sum(w for (c, n), w in weighted.items() if len(c) == len(ctx) + 1 and n == node and c[1:] == ctx)
            gap[ctx, node] = own - deeper
            weighted[ctx, node] = np.logaddexp(own, deeper) - math.log(2)

    def log10(text):
        data, total = bytes(depth) + text.lower().encode() + bytes([ctw.END]), 0.0
        for i in range(depth, len(data)):
            for k in range(8):
                node, p = 1 << k | data[i] >> 8 - k, None
                for d in range(depth, -1, -1):
                    key = data[i - d : i], node
                    if key in nodes:
                        a, b = nodes[key]
                        own = (b + 0.5) / (a + b + 1)
                        w = 1 if p is None else 1 / (1 + math.exp(-gap[key]))
                        p = own if p is None else w * own + (1 - w) * p
                p = 0.5 if p is None else p
                total += math.log10(p if data[i] >> 7 - k & 1 else 1 - p)
        return total

    return log10


def test_scores_equal_the_definition(spark, odd):
    rows = [(k, t) for k, t in enumerate(["The cat sat", "a cat sat on a mat", None, "", "Éa  cat", "dog dog dog", "the mat", "zebra quilt"] * 3)]
    got = ctw.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), depth=2).collect()
    taught = [t or "" for k, t in rows if zlib.crc32(str(k).encode()) % 7 != 2]
    log10 = brute_ctw(taught, 2)
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    counts = Counter(w for t in taught for w in split(t))
    n, v = sum(counts.values()), len(counts)
    texts = dict(rows)
    for r in got:
        words = split(texts[r["doc_id"]])
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), abs=1e-9)
        assert r["score"] == pytest.approx(log10(re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]] or "")), abs=1e-3)


def test_codes_outside_the_common_ones_have_whole_contexts(spark):
    # Contexts of five bytes seen once, and a held-out text that knows them in part only.
    texts = ["quick brown fox", "lazy dogs sleep", "quick brown cat", "some zebra quilt", "lazy foxes", "quilted fox", "zzzz"]
    rows = list(enumerate(texts * 2))
    log10 = brute_ctw([t for k, t in rows if zlib.crc32(str(k).encode()) % 7 != 2], 5)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (0, 20):
        got = ctw.score_documents(frame, depth=5, most_codes=most).collect()
        assert len(got) == len(rows) and any(r["held_out"] for r in got)
        assert all(r["score"] == pytest.approx(log10(texts[r["doc_id"] % 7]), abs=1e-6) for r in got)


def test_each_context_is_a_distribution(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(["abab abba", "abc", "bca"])], "doc_id long, text string")
    data, offsets = ctw.T.raw(__import__("pyarrow").array(["abab abba", "abc"]))
    codes, n = np.unique(ctw.codes(data, offsets, 2)[0], return_counts=True)
    frame = spark.createDataFrame(list(zip(codes.astype(np.int64).tolist(), n.tolist())), "code long, n long")
    scorer = ctw.Scorer(ctw.bounded_model(ctw.weighted_tree(frame, 2), 40))
    for context in (0x6162, 0x6261, 0x7A7A, 0):
        all_next = np.uint64(context) << np.uint64(8) | np.arange(256, dtype=np.uint64)
        assert (10 ** scorer.symbols(all_next)).sum() == pytest.approx(1, abs=1e-4)
        assert scorer.costs(all_next) == pytest.approx(scorer.symbols(all_next), abs=1e-4)
        assert scorer.costs(all_next) == pytest.approx(scorer.symbols(all_next), abs=1e-4)
    assert rows.count() == 3


def test_scores_of_odd_rows(odd, empty):
    got = ctw.score_documents(odd, depth=2, most_words=2).collect()
    assert len(got) == odd.count() and all(r["score"] < 0 for r in got)
    assert sorted({r["n_tokens"] for r in got if r["doc_id"] in (2, 3, 4)}) == [1]
    assert ctw.score_documents(empty, depth=2).count() == 0
