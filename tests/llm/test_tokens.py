"""Byte-level BPE and token counts against the libraries."""

import base64
import hashlib

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from archivekit.llm import bytebpe, piececount, queries

RANKS = P.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "", "a", "  ", "   x", "\n\n  b \t c", "été ﬁ Ａ 😀😀  x", "<s> </s><unk>▁x ▁▁ y", "\x00\x1c a\x85b\xa0c", "a" * 300,
    " " * 500 + "word" + " " * 70, " " * 5 + "\n" * 7, "don't we'll I'M", "日本語のテキスト 中文", "1234567890" * 12,
]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts():
    import random

    rng = random.Random(1)
    return TEXTS + ["".join(rng.choice("ab th e\n  1'é▁日!?xyz<>|") for _ in range(rng.randint(1, 80))) for _ in range(500)]


def test_encoding_equals_the_library(reference, texts):
    bpe = bytebpe.load(RANKS, P.PATTERN)
    for text, ids in zip(texts, bpe.encode(texts)):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert bpe.decode(ids.tolist()) == text.encode()


def test_appending_and_editing_equal_encoding_anew(rng):
    bpe = bytebpe.load(RANKS, P.PATTERN)
    word = lambda n: "".join(rng.choice("abthe n1é") for _ in range(n)).encode()
    for _ in range(60):
        start, more = word(rng.randint(0, 60)), word(8)
        table = bytebpe.Prefixes(bpe, start)
        table.append(more)
        assert table.last == bytebpe.Prefixes(bpe, start + more).last
        i = rng.randint(0, len(table.data))
        j, new, old = rng.randint(i, len(table.data)), word(rng.randint(0, 3)), table.data
        table.replace(i, j, new)
        assert table.last == bytebpe.Prefixes(bpe, old[:i] + new + old[j:]).last
        assert table.ids().tolist() == [bpe.merges.rank[t] for t in bpe.merges.merge(table.data)]


def test_pieces_of_all_lengths_share_a_table_and_common_words_stay(reference, monkeypatch):
    bpe, tables, given = bytebpe.ByteBpe(RANKS, P.PATTERN), [], []
    table, pieces = bpe._table, bpe.encode_pieces
    monkeypatch.setattr(bpe, "_table", lambda *a: (tables.append(1), table(*a))[1])
    monkeypatch.setattr(bpe, "encode_pieces", lambda p: (given.extend(p), pieces(p))[1])
    monkeypatch.setattr(bytebpe, "REMEMBERED", 40)
    texts = [" ".join(["qzcommonly", *["qz" + "xaj"[k % 3] * j for j in range(1, 40)]]) for k in range(6)]
    for text in texts:
        assert bpe.encode([text])[0].tolist() == reference.encode_ordinary(text)
    assert len(tables) == 6  # one for each text, whatever lengths its new words have
    assert given.count(b"qzcommonly") == 1
    monkeypatch.setattr(bytebpe, "COLUMNS", 7)
    again = bytebpe.ByteBpe(RANKS, P.PATTERN).encode(texts)
    assert [ids.tolist() for ids in again] == [reference.encode_ordinary(t) for t in texts]


def test_an_edit_of_a_long_piece_touches_little():
    bpe = bytebpe.load(RANKS, P.PATTERN)
    table = bytebpe.Prefixes(bpe, b"therationing" * 200)
    assert table.replace(1000, 1001, b"z") < 300


def test_digests(spark, odd, reference):
    got = queries.bpe_digests(odd).collect()
    assert len(got) == odd.count()
    for row, (text,) in zip(got, odd.select("text").collect()):
        ids = reference.encode_ordinary(text or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_columns_of_ids_and_bytes(odd, empty):
    out = odd.withColumn("ids", bytebpe.encode_udf(RANKS, P.PATTERN)("text"))
    out = out.withColumn("back", bytebpe.decode_udf(RANKS, P.PATTERN)("ids")).collect()
    assert all(bytes(r["back"]) == (r["text"] or "").encode() for r in out)
    assert queries.bpe_digests(empty).count() == 0


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def test_counts_equal_the_library(pieces, texts):
    machine = piececount.load(P.path("piece_bpe_32k.model"))
    for text in texts:
        assert (machine.count("▁" + text) if text else 0) == len(pieces.encode(text)), text[:60]


def test_chunk_maps_compose_in_any_grouping(rng, texts):
    machine = piececount.load(P.path("piece_bpe_32k.model"))
    for text in filter(None, texts[:200]):
        body = "▁" + text
        k = rng.randint(1, 9)
        maps = [machine.map(body[i : i + k]) for i in range(0, len(body), k)]
        left = maps[0]
        for m in maps[1:]:
            left = machine.compose(left, m)
        assert machine.scan(maps) == machine.total(left) == machine.count(body)


def test_long_texts_are_counted_in_chunks(spark, odd, pieces, empty):
    path = P.path("piece_bpe_32k.model")
    long = odd.unionByName(odd.withColumn("text", F.concat_ws(" ", F.array_repeat("text", 40))))
    got = piececount.token_counts(long, path, chunk=100).collect()
    assert len(got) == 16 and set(long.columns) < set(got[0].asDict())
    for row in got:
        assert row["n_tokens"] == (len(pieces.encode(row["text"])) if row["text"] else 0)
    assert piececount.token_counts(empty, path).count() == 0
