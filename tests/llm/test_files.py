"""The archive, sharding and the pipeline."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from archivekit.llm import decontaminate, queries, shards, toxicity, warc
from test_neardup import brute

SMALL = "/root/testdata/sf0.001"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, record long")


def test_archive_round_trip(spark, tmp_path):
    big, other = "<p>é" * 60, "<b>" * 50
    rows = [(5, "u5", big), (2, "u2", big), (9, None, big), (1, "u\r\nX: 1", other), (3, "u3", "small"), (4, "u4", "small"), (6, "u6", None), (7, "u7", "")]
    frame = pages(spark, [(*r, "x", 1) for r in rows])
    warc.write_archive(frame, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "payloads")).count() == 4
    got = {r["record"]: r for r in warc.read_records(spark, str(tmp_path)).withColumn("all", warc.record_bytes()).collect()}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in got.items()} == {
        2: ("response", None), 5: ("revisit", 2), 9: ("revisit", 2), 1: ("response", None), 3: ("response", None),
        4: ("response", None), 6: ("response", None), 7: ("response", None)}
    for k, _, html in rows:
        data = (html or "").encode()
        assert bytes(got[k]["payload"]) == data and bytes(got[k]["digest"]) == hashlib.sha256(data).digest()
        head, body = bytes(got[k]["all"]).split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        # The record is as long as its header says, and ends in two empty lines.
        assert len(body) == int(fields["Content-Length"]) + 4 and body.endswith(b"\r\n\r\n")
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(data).hexdigest()


def test_separators_inside_a_url_forge_no_header(spark):
    urls = [f"u{sep}X-Record-Key: 99{sep}X-Refers-To-Key: 7{sep}WARC-Type: revisit" for sep in ("\u2028", "\u2029", "\x85", "\r\n", "\n", "\r", "\x0b", "\x0c")]
    rows = [(i, url, "a" * 200) for i, url in enumerate(urls)]
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.archived(pages(spark, [(*r, "x", 1) for r in rows])).collect()}
    assert got == {i: ("revisit", 0) if i else ("response", None) for i in range(len(urls))}


def test_anchors_of_a_block_take_little_memory():
    import numpy as np

    rng = np.random.default_rng(1)
    items = {k: rng.integers(0, 1 << 62, 20).astype(np.uint64) for k in range(200)}
    block = decontaminate.Block(items)
    assert block.filter.nbytes <= 1 << 18
    keys = np.concatenate([t[0] for t in block.tables])
    assert block._may_hold(keys).all()
    assert block._may_hold(rng.integers(0, 1 << 63, 100_000).astype(np.uint64)).mean() < 0.1


def test_a_damaged_payload_ends_the_read(spark, tmp_path):
    warc.write_archive(pages(spark, [(1, "u", "a" * 200, "x", 1)]), str(tmp_path))
    spark.read.parquet(str(tmp_path / "payloads")).withColumn("payload", F.lit(b"b")).write.parquet(str(tmp_path / "bad" / "payloads"))
    spark.read.parquet(str(tmp_path / "headers")).write.parquet(str(tmp_path / "bad" / "headers"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_records(spark, str(tmp_path / "bad")).collect()


def test_archive_of_odd_rows(spark):
    rows = [(1, "u", "a" * 200), (1, "u", "a" * 200), (None, "u", "a" * 200), (None, None, None), (None, "v", None), (2, "u", "b" * 200)]
    got = warc.archived(pages(spark, [(*r, "x", 1) for r in rows])).collect()
    assert len(got) == len(rows)
    assert sorted((r["page_id"] or 0, r["record_type"]) for r in got) == [
        (0, "response"), (0, "response"), (0, "revisit"), (1, "response"), (1, "response"), (2, "response")]
    assert warc.archived(pages(spark, [])).count() == 0


def spread(rows):
    sums = [0] * 24
    for r in rows:
        sums[r["shard"]] += r["size"]
    return max(sums) - min(sums)


def greedy(sizes):
    sums = [0] * 24
    for s in sorted(sizes, reverse=True):
        sums[sums.index(min(sums))] += s
    return max(sums) - min(sums)


@pytest.mark.parametrize("block", [1024, 8192])
def test_shards_are_even_and_keep_groups(spark, block):
    rng = random.Random(4)
    texts = ["x" * rng.randint(0, 3000) + str(k) for k in range(3000)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(9000 + k, texts[k % 50]) for k in range(200)]
    got = shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(24))
    at = {r["doc_id"]: r["shard"] for r in got}
    assert all(at[9000 + k] == at[k % 50] for k in range(200))
    groups = {}
    for k, t in rows:
        groups[t] = groups.get(t, 0) + len(t) + 8
    assert spread(got) <= max(200, greedy(groups.values()))


def test_a_group_above_a_fair_share_is_alone(spark):
    rng = random.Random(4)
    rows = [(k, "y" * rng.randint(1, 300) + str(k)) for k in range(4000)] + [(9000 + k, "z" * 500) for k in range(200)]
    got = shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), block=512).collect()
    sums = {}
    for r in got:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
    *others, top = sorted(sums.values())
    assert top == 200 * 508 and others[-1] - others[0] < 500


def test_shards_of_odd_rows(odd, empty):
    got = shards.shard_documents(odd).collect()
    assert len(got) == odd.count()
    assert {r["size"] for r in got if r["doc_id"] in (2, 3)} == {8} and {r["law"] for r in got} == {"bytes"}
    assert len({r["shard"] for r in got if r["doc_id"] in (1, None)}) == 1
    assert shards.shard_documents(empty).count() == 0


def test_archive_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    sql = con.execute(queries.ORACLES["op3_content_addressed_warc"])
    names = [d[0] for d in sql.description]
    want = sorted(map(str, sql.fetchall()))
    got = queries.QUERIES["op3_content_addressed_warc"](spark, SMALL).select(*names).collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    one = steps["toxicity"](spark, docs, SMALL).cache()
    assert one.columns == docs.columns
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert one.join(labels.filter("toxic = 0"), "doc_id").count() == docs.join(labels.filter("toxic = 0"), "doc_id").count()
    two = steps["minhash_near_dedup"](spark, one, SMALL).cache()
    rows = [(r["doc_id"], r["text"]) for r in one.collect()]
    assert {r["doc_id"] for r in two.collect()} == {k for k, root in brute(rows, 5)[1].items() if k == root}
    three = steps["benchmark_decontamination"](spark, two, SMALL).cache()
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in three.collect()}
    assert left == {r["doc_id"] for r in two.collect() if not any(i in r["text"] for i in items)}
    four = steps["byte_level_bpe"](spark, three, SMALL).collect()
    assert {r["doc_id"] for r in four} == left
    assert all(r["decoded_sha256"] == hashlib.sha256(before[r["doc_id"]].encode()).hexdigest() for r in four)


def test_a_stage_called_alone_keeps_batches_small(spark, monkeypatch):
    wide = {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.execution.arrow.maxBytesPerBatch": "64m"}
    before = {key: spark.conf.get(key) for key in wide}

    @F.arrow_udf("long")
    def held(text: pa.Array) -> pa.Array:
        return pa.array([text.nbytes] * len(text), pa.int64())

    monkeypatch.setattr(queries, "bpe_digests", lambda docs: docs.select(held("text").alias("bytes")))
    docs = spark.range(0, 300, 1, 1).select(F.expr("repeat('x', 100000)").alias("text"))
    try:
        for key, value in wide.items():
            spark.conf.set(key, value)
        step = dict(corpus_pipeline.STAGES)["byte_level_bpe"]
        assert max(r["bytes"] for r in step(spark, docs, SMALL).collect()) < 5 << 20
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_stages_take_odd_rows(spark, odd, empty):
    for frame in (odd, empty):
        docs = frame
        for _, step in corpus_pipeline.STAGES[:-1]:
            docs = step(spark, docs, SMALL)
            assert docs.columns == frame.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()
    assert toxicity.score_documents and decontaminate.clean
