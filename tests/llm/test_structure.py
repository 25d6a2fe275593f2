"""Source divergence, URL filters and conversation repair."""

import hashlib
import random
import re
import zlib

import pytest

from archivekit.llm import conversations as C, divergence, redirects
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


# --- conversations ---------------------------------------------------------------

RIGHT = re.compile(r"(s?(ua)+)?")


def all_repairs(rows, most_inserts):
    """Every way to edit, by brute force: (cost, audit, repaired lines)."""
    ways = [(0, "", [])]
    inserts = [("I", 5, r + ":") for r in ("user", "assistant")]

    def inserted(ways):
        out = list(ways)
        for _ in range(most_inserts):
            ways = [(c + n, a + x, t + [line]) for c, a, t in ways for x, n, line in inserts if (a + x).count("I") <= most_inserts]
            out += ways
        return out

    for role, text, fault in rows:
        grown = []
        for cost, audit, lines in inserted(ways):
            grown.append((cost + 2, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                grown.append((cost + more, audit + "K", lines + [f"{role}:{text}"]))
                grown += [(cost + 1 + more, audit + "R", lines + [f"{r}:{text}"]) for r in ("user", "assistant")]
        ways = grown
    return [w for w in inserted(ways) if RIGHT.fullmatch("".join(line[0] for line in w[2]))]


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plainly_damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def table_repair(rows):
    """Least (cost, audit, lines) by a plain table over rows and states."""
    end = [(0, "", []), None, None, (0, "", [])]

    def with_inserts(now):
        for _ in range(8):
            for q in range(4):
                to = now[C.NEXT[q]]
                if to:
                    way = to[0] + 5, "I" + to[1], [C.NAMES[C.NEXT[q]] + ":"] + to[2]
                    now[q] = way if now[q] is None else min(now[q], way)
        return now

    now = with_inserts(end)
    for role, text, fault in reversed(rows):
        before = []
        for q in range(4):
            ways = [(now[q][0] + 2, "D" + now[q][1], now[q][2])]
            if fault not in ("blank", "duplicate"):
                more, to, given = 5 * (fault == "truncated"), C.STEPS[q].get(role[:1]), C.NEXT[q]
                if to is not None:
                    ways.append((now[to][0] + more, "K" + now[to][1], [f"{role}:{text}"] + now[to][2]))
                ways.append((now[given][0] + 1 + more, "R" + now[given][1], [f"{C.NAMES[given]}:{text}"] + now[given][2]))
            before.append(min(ways))
        now = with_inserts(before)
    return now[C.START]


def expected(rows):
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    plain = faults([r[1:] for r in order])
    turns = [r[1] for r in order if r[1] is not None]
    cost, audit, lines = table_repair(plain)
    initials = [r[2][:1] for r in order]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[sum(f == kind for _, _, f in plain) for kind in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, cost int, part string, audit string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", "a") for r in rows], SCHEMA)


def test_cheapest_edits_are_least_of_all(rng):
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice("xy"), rng.choice(["", "", "", "blank", "truncated"]))
                for _ in range(rng.randrange(4))]
        code = "".join(r[0] + {"": " ", "blank": "b", "truncated": "t"}[f] for r, _, f in rows)
        cost, audit, lines = min(all_repairs(rows, 2))
        assert C.cheapest(code) == (cost, audit)
        assert list(C.repaired(audit, C.START, [r[:2] for r in rows])) == lines


def test_blocks_join_to_the_whole(rng):
    for _ in range(40):
        rows = "".join(rng.choice("suuaax") + rng.choice("      btd") for _ in range(rng.randrange(1, 30)))
        cut = 2 * rng.randrange(len(rows) // 2 + 1)
        first, second = C.table(rows[:cut]), C.table(rows[cut:])
        joined = min((c + d, a + b) for p, q, c, a in first if p == C.START for r, s, d, b in second if r == q and s in C.ENDS)
        assert joined == C.cheapest(rows)


def test_repair_equals_the_plain_table(spark, rng, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 4)
    texts = ["Yes.", "No!", "What", "", " \t", "\u2028", "Well? ", "é. \u2028", None]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(["system", "user", "assistant", "", None, "Tool"]), rng.choice(texts))
            for c in [None, *range(12)] for _ in range(rng.randrange(1, 10))]
    rows += [(99, t, "ua"[t % 2] + "x", f"{t} said.") for t in range(700)]
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = expected([r for r in plainly_damaged(rows) if r[0] == conv]) if any(
            r[0] == conv for r in plainly_damaged(rows)) else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in C.repair_damaged(frame(spark, rows)).collect()}
    assert got == want


def test_repair_of_the_given_table(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    left = plainly_damaged(rows)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in C.repair_damaged(table).collect()}
    assert set(got) == {r[0] for r in rows}
    assert all(got[conv] == expected(mine) for conv in got if (mine := [r for r in left if r[0] == conv]))


def test_long_repeated_and_missing_conversations(spark):
    assert C.repair_damaged(frame(spark, [])).count() == 0
    long = "word " * 400_000 + "end."
    rows = [(7, 1, "user", long)] * 3 + [(7, 2, "assistant", "Fine.")]
    (row,) = C.repair(frame(spark, rows)).collect()
    assert (row["duplicate"], row["audit"], row["cost"]) == (2, "KDDK", 4)
    assert row["repaired_sha256"] == hashlib.sha256(f"user:{long}\nassistant:Fine.".encode()).hexdigest()


# --- URL filters -------------------------------------------------------------------

def link(kind, target):
    return f'<html><head><link rel="canonical" href="{target}"></head>' if kind == "c" else (
        f"<meta http-equiv='refresh' content='0; url={target}'>")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "https://a.net/x#top", link("c", "/y")),
        (2, "https://a.net/y?q", link("r", "http://www.Example.org/es/1?a=1&amp;b=2")),
        (3, "https://a.net/y", link("r", "https://a.net/y?q")),
        (4, "http://www.Example.org/es/1?a=1&b=2", None),
        (5, "https://free.org/", link("c", "https://a.net/x")),
        (6, "https://a.net/z", "<!-- " + link("c", "https://a.net/x") + "--><script>" + link("r", "/x") + "</script>"),
        (7, None, link("c", "https://a.net/x")), (8, "no scheme", ""), (9, "https://b.net", link("c", "page")),
        (10, "https://b.net/page", link("c", "//fr.shop.com/de/1")), (11, "https://shop.com/de", ""), (12, "http://org/en/1", ""),
        (13, "https://notexample.org/es/", ""), (14, "http://example.org/en/12", ""), (15, "http://x.example.org/en/1", ""),
        (6, "https://a.net/z", ""), (16, "https://far.net/1", ""),
    ]
    return spark.createDataFrame([(*r, "q", "v") for r in rows], "page_id long, url string, html string, rule string, vertex string")


def test_blocks_reach_aliases_and_allows_stay(spark, pages):
    more = spark.createDataFrame([("https://far.net/1", "https://far.net/2"), ("https://far.net/2#x", "https://c.com/de/")], "src string, dst string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in redirects.judge(pages, more).collect()}
    assert got == {
        1: (None, "block"), 2: (None, "block"), 3: (None, "block"), 4: ("example.org/es/", "block"), 5: ("org/", "allow"),
        6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "block"), 10: (None, "block"), 11: (None, "allow"),
        12: ("org/", "allow"), 13: ("org/", "allow"), 14: ("example.org/en/1", "block"), 15: ("example.org/en/1", "block"),
        16: (None, "block"),
    }
    hosts = {r["page_id"]: (r["host"], r["path"]) for r in redirects.judge(pages).collect()}
    assert hosts[4] == ("www.example.org", "/es/1") and hosts[9] == ("b.net", "") and hosts[7] == hosts[8] == ("", "")


def test_classes_equal_a_plain_walk(spark, rng):
    n = 300
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(200)] + [(i, 7) for i in range(n, n + 80)]
    edges += [(1000 + i, 1001 + i) for i in range(40)]
    links = spark.createDataFrame([(f"h://{a}", f"h://{b}") for a, b in edges], "src string, dst string")
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[root(a)] = root(b)
    got = {r["url"]: r["class"] for r in redirects.classes(links).collect()}
    assert set(got) == {f"h://{v}" for v in parent}
    groups = lambda of: sorted(sorted(v for v in parent if of(v) == k) for k in {of(v) for v in parent})
    assert groups(lambda v: got[f"h://{v}"]) == groups(root)


def test_url_filters_equal_sql(spark, pages, tmp_path):
    from archivekit.llm.queries import ORACLES, op12_redirect_equivalence

    pages.select("page_id", "url", "html").write.parquet(str(tmp_path / "p"))
    con = connect(str(tmp_path))
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/p/*.parquet')")
    assert difference(redirects.judge(pages), ORACLES["op12_redirect_equivalence"], con) is None
    assert difference(op12_redirect_equivalence(spark, FOLDER), ORACLES["op12_redirect_equivalence"], connect(FOLDER)) is None
    empty = redirects.judge(pages.limit(0))
    assert empty.count() == 0 and empty.columns == ["page_id", "host", "path", "rule", "verdict"]


def test_url_filters_run_without_python(spark, pages):
    plan = redirects.judge(pages)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# --- divergence ----------------------------------------------------------------------

def plain_audit(rows, min_documents, shown):
    find = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(a or "", b or "", find.findall((t or "").translate(low))) for a, b, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        kept = {w for _, _, ws in mine for w in ws}
        kept = {w for w in kept if sum(w in ws for _, _, ws in mine) >= min_documents}
        count = lambda ds: {w: sum(ws.count(w) for _, _, ws in ds) for w in kept}

        def shares(ds):
            n = count(ds)
            total = sum(n.values())
            return {w: 1 + 10**9 * (c + 5) // (total + 5 * len(kept)) for w, c in n.items()}, n

        whole, _ = shares(mine)
        by = {s: shares([d for d in mine if d[1] == s]) for s in {d[1] for d in mine}}
        for s, (p, n) in by.items():
            pairs = [(sum(abs(p[w] - q[w]) for w in kept), o) for o, (q, _) in by.items() if o != s]
            terms = [(p[w] - whole[w], w) for w in kept if n[w] and p[w] > whole[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, shown)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = ["the", "The", "cat", "Éa", "éa", "x", "ab", "zz", "long" * 30, "été", "\U0001f600", "naïve", "q"]
    rows = [(rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None]), " ".join(rng.choice(words) for _ in range(rng.randrange(12))))
            for _ in range(150)]
    return rows + [("de", "a", None), ("de", "b", ""), ("xx", "only", "word 12")] + rows[:5]


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_divergence_equals_brute_force(spark, texts, bits, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 2)
    docs = spark.createDataFrame([(i, t, a, b, "x", 1) for i, (a, b, t) in enumerate(texts)], "doc_id long, text string, lang string, source string, term string, n int")
    got = sorted(tuple(r) for r in divergence.audit(docs, 4, 5, bits).collect())
    assert got == plain_audit(texts, 4, 5)


def test_divergence_without_a_broadcast_and_over_long_texts(spark, texts, monkeypatch):
    monkeypatch.setattr(divergence, "BROADCAST_DIGESTS", 1)
    rows = texts + [("en", "a", "long text " * 200_000)]
    docs = spark.createDataFrame([(t, a, b) for a, b, t in rows], "text string, lang string, source string")
    for bits in (64, 2):
        assert sorted(tuple(r) for r in divergence.audit(docs, 4, 5, bits).collect()) == plain_audit(rows, 4, 5)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_divergence_equals_sql(spark):
    from archivekit.llm.queries import ORACLES, op11_source_divergence_audit

    folder = "/root/testdata/sf0.01"
    assert difference(op11_source_divergence_audit(spark, folder), ORACLES["op11_source_divergence_audit"], connect(folder)) is None


def test_divergence_tasks_hold_little_of_a_large_batch(rng):
    import tracemalloc

    import pyarrow as pa

    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=32_000)) for _ in range(40)] * 2
    named = pa.RecordBatch.from_arrays([pa.array([x] * len(texts)) for x in ("en", "s")] + [pa.array(texts)], ["lang", "source", "text"])
    for task, batch in ((divergence._counted(64), named), (divergence._described(64, None), named.select(["text"]))):
        tracemalloc.start()
        rows = sum(out.num_rows for out in task(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == len(set(words))  # over all slices of the batch, not for each of them
        assert peak < 64 << 20


def test_divergence_counts_sent_early_add_up(monkeypatch):
    import pyarrow as pa
    from collections import Counter

    monkeypatch.setattr(divergence, "HELD", 4)
    monkeypatch.setattr(divergence, "SENT", 3)
    rows = [("en", "ab"[k % 2], f"one two {'three ' * k} word{chr(97 + k)}") for k in range(9)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + 1])], ["lang", "source", "text"]) for k in range(9)]
    n, docs = Counter(), Counter()
    for out in divergence._counted(64)(iter(batches)):
        for lang, source, digest, count, held in zip(*(c.to_pylist() for c in out.columns)):
            n[source, digest] += count
            docs[source, digest] += held
    assert sorted(n.values()) == sorted([5, 4] * 2 + [20, 16] + [1] * 9)
    assert sorted(docs.values()) == sorted([5, 4] * 2 + [4, 4] + [1] * 9)
