"""Repair of conversation structure: the cheapest edits that make turns alternate.

A conversation is right if its roles' initials read `(s?(ua)+)?`: an optional system
turn, then user and assistant in pairs, or nothing at all. Edits are Keep (0), Rerole to
user or assistant (1), Delete (2, required for blank and duplicate rows) and Insert of an
empty user or assistant turn (5); keeping or reroling a truncated row costs 5 more. Of
the cheapest ways to edit, the one whose audit (the edits' initials in order) is least
is taken.

Nodes of the edit lattice are (rows used, state of the pattern). Bidirectional Dijkstra:
one heap grows from the start, one from the end; when the sum of their least costs
exceeds the best crossing, all crossings of that cost are known, and the least of their
concatenated audits is the answer. Two paths of one cost to one node never have audits
of which one begins the other (what more the longer one did would be Inserts, at a cost),
so the least audit to a node and the least from it join to the least over both.

Long conversations are cut into blocks. A block answers for each pair of states with its
cheapest audit, whatever stands before and after it; the blocks of a conversation are
then folded in order, with one candidate (cost, audit, running hash of the repaired
text) for each state. So a conversation that holds a third of all rows is searched in
many tasks, and only its audit, as long as the result it belongs to, and four hash
states are held where it is folded.

Rows are sorted over the whole cluster by conversation, turn, role and text. Short
conversations that lie inside one part of the order are searched whole and finished
there; others hand their blocks on.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.taskcontext import TaskContext

from archivekit.operators.lookup import attach_small
from archivekit.operators.workspace import stage
from archivekit.params import Params

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: What each state takes, by initial.
STEPS = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The role that may be inserted or given in each state, as the state it leads to.
NEXT = (USER, USER, ASSISTANT, USER)
#: Rows and characters of a block; blocks of one conversation held back in a task.
BLOCK_ROWS, BLOCK_CHARS, HELD_BLOCKS = 256, 1 << 20, 4

_BLANK, _DUPLICATE, _TRUNCATED = "b", "d", "t"


# --- the lattice -------------------------------------------------------------

def _forward(rows: str, i: int, q: int) -> Iterator[tuple[int, str, int, int]]:
    """(cost, letter, rows used, state) of the edits possible at a node.

    `rows` holds two signs a row: the initial of its role and its fault, if any.
    """
    if 2 * i < len(rows):
        initial, fault = rows[2 * i], rows[2 * i + 1]
        yield DELETE, "D", i + 1, q
        if fault != _BLANK and fault != _DUPLICATE:
            more = TRUNCATED if fault == _TRUNCATED else 0
            to = STEPS[q].get(initial)
            if to is not None:
                yield KEEP + more, "K", i + 1, to
            yield REROLE + more, "R", i + 1, NEXT[q]
    yield INSERT, "I", i, NEXT[q]


#: States from which a role's initial, or the role given or inserted, leads to a state.
_BEFORE = {q: [(p, c) for p in range(4) for c, to in STEPS[p].items() if to == q] for q in range(4)}
_GIVEN = {q: [p for p in range(4) if NEXT[p] == q] for q in range(4)}


def _backward(rows: str, i: int, q: int) -> Iterator[tuple[int, str, int, int]]:
    """The edits that lead to a node, as (cost, letter, rows used before, state before)."""
    if i > 0:
        initial, fault = rows[2 * i - 2], rows[2 * i - 1]
        yield DELETE, "D", i - 1, q
        if fault != _BLANK and fault != _DUPLICATE:
            more = TRUNCATED if fault == _TRUNCATED else 0
            for p, c in _BEFORE[q]:
                if c == initial:
                    yield KEEP + more, "K", i - 1, p
            for p in _GIVEN[q]:
                yield REROLE + more, "R", i - 1, p
    for p in _GIVEN[q]:
        yield INSERT, "I", i, p


def cheapest(rows: str, begin: int = START, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits from state `begin` to one of `ends`."""
    n = len(rows) // 2
    # Heaps order by cost, then by rows used, so that of equal costs the free steps
    # that lead to a node come before it is settled.
    ahead, back = {(0, begin): (0, "")}, {(n, q): (0, "") for q in ends}
    front, rear = [(0, 0, begin)], [(0, -n, q) for q in ends]
    heapq.heapify(rear)
    done, gone = {}, {}
    best = None
    while front or rear:
        if best is None and not (front and rear):
            return None
        least = [heap[0][0] if heap else 0 for heap in (front, rear)]
        # The ends themselves are settled in any case.
        if best is not None and sum(least) > best and (not rear or least[1] > 0):
            break
        if front and (not rear or least[0] <= least[1]):
            cost, i, q = heapq.heappop(front)
            at = i, q
            if at in done or ahead[at][0] != cost:
                continue
            audit = done[at] = ahead[at][1]
            if at in back and (best is None or cost + back[at][0] < best):
                best = cost + back[at][0]
            for more, letter, j, p in _forward(rows, i, q):
                new = cost + more, audit + letter
                if (j, p) not in done and ((j, p) not in ahead or new < ahead[j, p]):
                    ahead[j, p] = new
                    heapq.heappush(front, (new[0], j, p))
        else:
            cost, i, q = heapq.heappop(rear)
            i, at = -i, (-i, q)
            if at in gone or back[at][0] != cost:
                continue
            audit = gone[at] = back[at][1]
            if at in ahead and (best is None or cost + ahead[at][0] < best):
                best = cost + ahead[at][0]
            for more, letter, j, p in _backward(rows, i, q):
                new = cost + more, letter + audit
                if (j, p) not in gone and ((j, p) not in back or new < back[j, p]):
                    back[j, p] = new
                    heapq.heappush(rear, (new[0], -j, p))
    # Each cheapest way has an edit from a node settled ahead to one settled behind.
    audits = [done[at] + gone[at] for at in done if at in gone and ahead[at][0] + back[at][0] == best]
    for (i, q), audit in done.items():
        for more, letter, j, p in _forward(rows, i, q):
            if (j, p) in gone and ahead[i, q][0] + more + back[j, p][0] == best:
                audits.append(audit + letter + gone[j, p])
    return best, min(audits)


def table(rows: str) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) for each pair of states that some edits connect."""
    out = []
    for p in range(4):
        for q in range(4):
            found = cheapest(rows, p, (q,))
            if found is not None:
                out.append((p, q, *found))
    return out


def repaired(audit: str, state: int, turns: list[tuple[str, str]]) -> Iterator[str]:
    """The turns that edits leave, as `role:text`."""
    at = iter(turns)
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield NAMES[state] + ":"
            continue
        role, text = next(at)
        if letter == "K":
            state = STEPS[state][role[:1]]
            yield f"{role}:{text}"
        elif letter == "R":
            state = NEXT[state]
            yield f"{NAMES[state]}:{text}"


# --- blocks and their folding --------------------------------------------------

_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_PATHS = pa.list_(pa.struct([("from", pa.int8()), ("to", pa.int8()), ("cost", pa.int64()), ("audit", pa.string())]))
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn"]
_BLOCK = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), *[(c, pa.int64()) for c in _COUNTS],
    ("initials", pa.string()), ("paths", _PATHS), ("rows", _TURNS),
    ("cost", pa.int64()), ("audit", pa.string()), ("gaps", pa.int64()), ("repaired_sha256", pa.string()),
])
_BLOCK_DDL = (
    "conv_id bigint, part int, seq bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    + ", initials string, paths array<struct<from: tinyint, to: tinyint, cost: bigint, audit: string>>,"
    " rows array<struct<role: string, text: string>>, cost bigint, audit string, gaps bigint, repaired_sha256 string"
)
_RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_RESULT_DDL = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
    " audit string, repaired_sha256 string"
)
_LEGAL = {"su", "ua", "au"}


class Block:
    """A run of a conversation's rows in order, of bounded size."""

    def __init__(self):
        self.codes: list[str] = []
        self.rows: list[tuple[str, str]] = []
        self.turn_list: list[int] = []
        self.initials: list[str] = []
        self.chars = 0

    def add(self, turn, role: str, text: str, fault: str) -> None:
        self.codes.append((role[:1] or "-") + fault)
        self.rows.append((role, text))
        self.initials.append(role[:1])
        self.chars += len(text)
        if turn is not None and (not self.turn_list or self.turn_list[-1] != turn):
            self.turn_list.append(turn)

    def extend(self, other: "Block") -> None:
        self.codes += other.codes
        self.rows += other.rows
        self.initials += other.initials
        self.chars += other.chars
        self.turn_list += other.turn_list[self.turn_list[-1:] == other.turn_list[:1] != []:]

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def facts(self) -> dict:
        """What folding needs beside the rows; the paths only where they are asked for."""
        faults = [c[1] for c in self.codes]
        pairs = zip(self.initials, self.initials[1:])
        return {
            "blank": faults.count(_BLANK), "duplicate": faults.count(_DUPLICATE), "truncated": faults.count(_TRUNCATED),
            "illegal": sum(a + b not in _LEGAL for a, b in pairs), "turns": len(self.turn_list),
            "first_turn": self.turn_list[0] if self.turn_list else None,
            "last_turn": self.turn_list[-1] if self.turn_list else None,
            # Of the first and the last row; an empty role has a blank sign.
            "initials": (self.initials[0] or "-") + (self.initials[-1] or "-"),
        }


class Fold:
    """A conversation folded block by block."""

    def __init__(self):
        #: What the audits of all states begin with, in pieces.
        self.shared: list[str] = []
        #: State to cost, rest of the audit, hash of the text so far and whether it has turns.
        self.at = {START: (0, "", hashlib.sha256(), False)}
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.first, self.last, self.initial = 0, None, None, None

    def add(self, facts: dict, paths, turns: list[tuple[str, str]]) -> None:
        for name in self.counts:
            self.counts[name] += facts[name]
        initials = facts["initials"]
        if self.initial is not None:
            self.counts["illegal"] += self.initial + initials[0] not in _LEGAL
        self.initial = initials[1]
        if facts["turns"]:
            self.turns += facts["turns"] - (self.last == facts["first_turn"])
            self.first = facts["first_turn"] if self.first is None else self.first
            self.last = facts["last_turn"]
        chosen: dict[int, tuple] = {}
        for p, q, cost, audit in paths:
            if p in self.at:
                new = self.at[p][0] + cost, self.at[p][1] + audit, p, audit
                if q not in chosen or new[:2] < chosen[q][:2]:
                    chosen[q] = new
        now = {}
        for q, (cost, audit, p, piece) in chosen.items():
            digest, begun = self.at[p][2].copy(), self.at[p][3]
            for turn in repaired(piece, p, turns):
                digest.update((("\n" if begun else "") + turn).encode("utf-8", "surrogatepass"))
                begun = True
            now[q] = cost, audit, digest, begun
        same = len(commonprefix([x[1] for x in now.values()]))
        self.shared.append(next(iter(now.values()))[1][:same])
        self.at = {q: (cost, audit[same:], *more) for q, (cost, audit, *more) in now.items()}

    def result(self) -> dict:
        cost, audit, digest, _ = min((self.at[q] for q in ENDS if q in self.at), key=lambda x: x[:2])
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {"gaps": gaps, **self.counts, "cost": cost, "audit": "".join(self.shared) + audit, "repaired_sha256": digest.hexdigest()}


def _whole(blocks: list[Block]) -> dict:
    """The result of a conversation that is all there: one search from start to end."""
    whole = blocks[0]
    for block in blocks[1:]:
        whole.extend(block)
    cost, audit = cheapest("".join(whole.codes))
    fold = Fold()
    fold.add(whole.facts(), [(START, START, cost, audit)], whole.rows)
    return fold.result()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a part to results of whole conversations and blocks of others.

    The first and the last conversation of a part may go on in other parts, and long
    ones are better folded once all their blocks are known: their blocks are handed on.
    """
    part = TaskContext.get().partitionId()
    out: list[dict] = []
    size = seq = 0
    conv: object = _blocks  # no conversation yet
    held: list[Block] = []
    first = spilled = False
    before = None

    def hand_on(block: Block) -> None:
        nonlocal seq, size
        paths = [dict(zip(("from", "to", "cost", "audit"), x)) for x in table("".join(block.codes))]
        rows = [{"role": r, "text": t} for r, t in block.rows]
        out.append({"conv_id": conv, "part": part, "seq": seq, **block.facts(), "paths": paths, "rows": rows})
        seq += 1
        size += block.chars + 1000

    def close(inside: bool) -> None:
        nonlocal size
        if not held:
            return
        if inside and not spilled:
            result = _whole(held)
            out.append({"conv_id": conv, "part": part, "seq": -1, **result})
            size += len(result["audit"]) + 300
        else:
            for block in held:
                hand_on(block)
        held.clear()

    def flush() -> pa.RecordBatch:
        nonlocal size
        batch = pa.RecordBatch.from_pylist(out, _BLOCK)
        out.clear()
        size = 0
        return batch

    for batch in batches:
        for conv_id, turn, role, text, blank, ends, again in zip(*(c.to_pylist() for c in batch.columns)):
            if conv_id != conv:
                close(inside=not first and conv is not _blocks)
                first, conv, spilled, before = conv is _blocks, conv_id, False, None
                held.append(Block())
            same = before == (turn, role, text)
            before = turn, role, text
            fault = _BLANK if blank else _DUPLICATE if again or same else " " if ends else _TRUNCATED
            if held[-1].full():
                if len(held) >= HELD_BLOCKS or spilled:
                    for block in held:
                        hand_on(block)
                    held.clear()
                    spilled = True
                held.append(Block())
            held[-1].add(turn, role, text, fault)
            if size >= 8 << 20:
                yield flush()
    close(inside=False)
    if out:
        yield flush()


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order to one result per conversation."""
    fold, conv, out = None, None, []

    def results() -> pa.RecordBatch:
        schema = pa.schema([_BLOCK.field(c) for c in _RESULT])
        batch = pa.RecordBatch.from_pylist(out, schema)
        out.clear()
        return batch

    for batch in batches:
        for i in range(batch.num_rows):
            block = batch.slice(i, 1).to_pylist()[0]
            if fold is None or block["conv_id"] != conv:
                if fold is not None:
                    out.append({"conv_id": conv, **fold.result()})
                fold, conv = Fold(), block["conv_id"]
            paths = [(x["from"], x["to"], x["cost"], x["audit"]) for x in block["paths"]]
            fold.add(block, paths, [(r["role"], r["text"]) for r in block["rows"]])
        if len(out) >= 1000:
            yield results()
    if fold is not None:
        out.append({"conv_id": conv, **fold.result()})
    yield results()


# --- on tables -------------------------------------------------------------------

def _plain(conversations: DataFrame) -> DataFrame:
    """The four columns; a null role or text counts as one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        blank("role").alias("role"), blank("text").alias("text"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as damaged by the remainder of crc32(`conv_id:turn`) by 20.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4
    makes it a user's. A null id or turn is one space in the text of the checksum.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    rows = _plain(conversations).withColumn("_kind", kind).filter("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"role": F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")), "text": text})
    return rows.withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_kind", "_copy")


def _with_faults(rows: DataFrame, params: Params) -> DataFrame:
    """Adds `blank`, `ends` (the last sign is a sentence end) and `again` (said in an earlier turn).

    Equal rows of one turn are told apart in the order itself.
    """
    digest = F.sha2(F.concat_ws(":", F.octet_length("role"), "role", "text"), 256)
    narrow = rows.select("conv_id", "turn", digest.alias("_said"))
    turn = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    said = narrow.groupBy("conv_id", "_said").agg(
        F.min(turn).alias("_first"), F.max(turn).alias("_last")
    ).filter("_first <> _last").select(F.coalesce("conv_id", F.lit(0)).alias("_conv"), F.col("conv_id").isNull().alias("_none"), "_said", "_first")
    said = stage(said, "said")
    keyed = rows.withColumns({"_said": digest, "_conv": F.coalesce("conv_id", F.lit(0)), "_none": F.col("conv_id").isNull()})
    marked = attach_small(keyed, said, ["_conv", "_none", "_said"], ["turn"], params, "left")
    return marked.select(
        "conv_id", "turn", "role", "text",
        F.rlike("text", F.lit(r"\A[\x20\x09-\x0D]*\z")).alias("blank"),
        F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z")).alias("ends"),
        F.coalesce(turn > F.col("_first"), F.lit(False)).alias("again"),
    )


def repair(rows: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per conv_id of `rows` (conv_id, turn, role, text) with its faults and repair.

    conv_id, gaps (turns missing between the first and the last), blank, duplicate,
    truncated, illegal (neighbours whose initials are not su, ua or au), cost, audit,
    repaired_sha256 (of the repaired `role:text` lines).

    Rows stand in the order of their turn, null turns first; equal turns by role and
    text. A null conv_id is a conversation of its own, null roles and texts are one
    space. An empty role has no initial: its row is deleted or given a role. Repeated
    rows are duplicates. Texts of any length are taken whole.
    """
    # The bounds of the parts, which the driver holds, have the beginning of a text only.
    faults = _with_faults(_plain(rows), params).withColumn("_head", F.left(F.concat("role", F.lit("\0"), "text"), F.lit(32)))
    place = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("_head")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = faults.repartitionByRange(parts, *place).sortWithinPartitions(*place, "role", "text")
    ordered = ordered.select("conv_id", "turn", "role", "text", "blank", "ends", "again")
    blocks = stage(ordered.mapInArrow(_blocks, _BLOCK_DDL), "blocks")
    open_ = blocks.filter("seq >= 0").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return blocks.filter("seq < 0").select(*_RESULT).union(open_.mapInArrow(_folded, _RESULT_DDL))


def repair_damaged(conversations: DataFrame, params: Params = Params()) -> DataFrame:
    """`repair` of the damaged rows, for every conv_id of the table.

    A conversation that lost all its rows has zeros, an empty audit and the hash of an
    empty text. An empty table gives no rows.
    """
    done = repair(damaged(conversations), params)
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    key = lambda df: df.withColumns({"_conv": F.coalesce("conv_id", F.lit(0)), "_none": F.col("conv_id").isNull()})
    joined = key(ids).join(key(done).drop("conv_id"), ["_conv", "_none"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    return joined.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
