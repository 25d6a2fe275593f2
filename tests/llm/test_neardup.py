"""Near-duplicate documents and vectors against brute force."""

import math
import re

import numpy as np
import pytest

from archivekit.llm import graph, neardup, projections


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*[words[i:] for i in range(size)])) if len(words) >= size else frozenset([tuple(words)] if words else [])


def components_of(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, size):
    sets = {i: shingles(t, size) for i, t in rows}
    ids = sorted(i for i in sets if sets[i])
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, components_of(sets, links)


def corpus(rng, groups, n):
    words = [f"w{k}" for k in range(300)]
    rows, at = [], 0
    for _ in range(n):
        rows.append((at, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))))
        at += 1
    for size, changes in groups:
        base = [rng.choice(words) for _ in range(60)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, changes)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((at, " ".join(text).upper() if rng.random() < 0.2 else " ".join(text)))
            at += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(spark, rng, size):
    # Among others, a group that is alike by about the threshold and a large one.
    rows = corpus(rng, [(2, 1), (9, 3), (40, 6), (120, 2), (60, 9)], 150)
    sizes, want = brute(rows, size)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=size, limit=8, few=12).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_tiles_find_what_is_still_large(spark, rng, levels, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", 16)
    rows = corpus(rng, [(60, 8)], 10)
    _, want = brute(rows, 2)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2, limit=4, few=4, levels=levels).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_odd_rows(odd, empty):
    got = neardup.near_duplicates(odd, size=2).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    assert (by[1]["component_id"], by[1]["n_shingles"]) == (1, 5)
    assert [(by[i]["component_id"], by[i]["n_shingles"], by[i]["kept"]) for i in (2, 3, 4, 5)] == [(2, 0, True), (3, 0, True), (4, 0, True), (5, 1, True)]
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert neardup.near_duplicates(empty, size=2).count() == 0


def test_rows_that_share_an_id_are_one_document(spark):
    rows = [(7, "a b c d"), (7, "e f g h"), (3, "a b c d"), (9, "e f g h"), (5, "other words here now")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(7, 3), (3, 3), (9, 3), (5, 5)}


def test_full_sets_are_made_once(spark, monkeypatch):
    plans, stage = [], neardup.stage

    def staged(df, label, *rest):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return stage(df, label, *rest)

    monkeypatch.setattr(neardup, "stage", staged)
    docs = spark.createDataFrame([(1, "a b c"), (1, ""), (2, None), (3, "d")], "doc_id long, text string")
    sets = neardup._sets(docs, docs.select("doc_id").distinct(), 2, 10)
    assert sorted((r["id"], len(r["set"])) for r in sets.collect()) == [(1, 2), (3, 1)]
    assert [plan.count("ArrowEvalPython") for label, plan in plans if label == "sets"] == [1]


def test_a_path_of_edges_is_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    got = {r["v"]: r["root"] for r in graph.components(edges).collect()}
    assert all(got[k] == 0 for k in range(1, 61)) and got[101] == 100


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id long, root string")


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for center, many in ((0, 1), (1, 3), (2, 90), (3, 20)):
        base = rng.normal(size=16)
        for _ in range(many):
            rows.append((base + rng.normal(size=16) * 0.06, center % 2))
    rows += [(rng.normal(size=16), k % 3) for k in range(200)] + [rows[5], rows[5], rows[60]]
    data = [(k, v.astype(np.float32), label) for k, (v, label) in enumerate(rows)]
    x = np.stack([v.astype(np.float64) for _, v, _ in data])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([d[2] for d in data])
    near = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    want = components_of(range(len(data)), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])
    got = projections.near_vectors(vectors(spark, [(k, v.tolist(), int(l), 0, "x") for k, v, l in data]), window=16).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(near.sum(1).tolist()))
    assert {r["vec_id"]: r["component_id"] for r in got} == want


def test_vectors_that_link_with_nothing(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 1), (2, one, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 3.0], 1),
        (9, [1.0, math.nan, 3.0], 1), (10, [1.0, math.inf, 3.0], 1), (11, [1.0, 2.0], 1), (2, one, 1), (None, one, 1), (12, [2.0, 4.0, 6.0], 1),
    ]
    got = projections.near_vectors(vectors(spark, [(*r, 0, "x") for r in rows])).collect()
    assert len(got) == len(rows)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert by[1] == (2, 1, True) and by[2] == by[12] == (2, 1, False)
    assert all(by[i] == (0, i, True) for i in range(3, 12)) and by[None] == (0, None, True)
    assert projections.near_vectors(vectors(spark, [])).count() == 0


def test_more_vectors_need_more_passes():
    assert projections.passes_for(10**7, 32, 0.98, 0.99) > projections.passes_for(10**4, 32, 0.98, 0.99)
    assert neardup.trees_for(0.8, 0.999) > neardup.trees_for(0.8, 0.9)


def test_pairs_in_a_dense_label_of_unlinked_vectors(spark, monkeypatch):
    # Vectors at cosine 0.9 to one another fill every window; the planted pairs are at 0.982.
    monkeypatch.setattr(projections, "TILE", 256)
    random = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    apart = lambda x, cosine: cosine * x + math.sqrt(1 - cosine**2) * unit((y := random.normal(size=x.shape)) - (x * y).sum(-1, keepdims=True) * x)
    middle = unit(random.normal(size=64))
    group = apart(np.tile(middle, (2000, 1)), math.sqrt(0.93))
    pairs = apart(group[:200], 0.982)
    rows = [(k, v.tolist(), 1) for k, v in enumerate([*group, *pairs])]
    got = {r["vec_id"]: r for r in projections.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long"), window=8, recall=0.99).collect()}
    assert len(got) == len(rows)
    assert sum(got[2000 + k]["component_id"] == got[k]["component_id"] for k in range(200)) >= 196


@pytest.mark.parametrize("query", ["op5_embedding_near_dedup", "op8_minhash_near_dedup"])
def test_queries_equal_all_pairs_in_sql(spark, query):
    from archivekit.llm.queries import ORACLES, QUERIES
    from compare import connect, difference

    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES[query](spark, folder), ORACLES[query], connect(folder)) is None
