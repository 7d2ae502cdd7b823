"""Conversation structure repair: the cheapest edits that give a conversation the order system? (user assistant)*, found by A*.

Rows of a conversation stand by turn (nulls first), then role, then text. A row's first fault counts: blank, duplicate (its role and text stand
earlier) or truncated. Edits: Keep 0, Rerole 3, Delete 4, Insert of an empty row 3; blank and duplicate rows must be deleted,
truncated ones that stay add 3. The result's role initials match (s?(ua)+)?. Of the cheapest the audit, the edits'
initials in order, is the ASCII-least.

search() is A* over the lattice of (rows done, state of the order): four states, edges that delete, keep or rerole the next row or
insert one. The heuristic is a suffix sum: 4 for each row that must go, 3 for each truncated one (kept it pays 3, deleted 4), which
no path can undercut, and it is consistent; the queue's key is (cost plus heuristic, audit). Two cheapest paths to one node have
audits of which neither begins the other (what one has more are inserts, which cost), so the first to reach a node is the least.

Repeated rows are summed up first; which role and text stand where first is one aggregation, joined back. Conversations are then dealt by
ranges of (conversation, turn, role, text), so that one with a third of all rows is spread over many tasks. Where a whole conversation lies within one
block of a task it is finished there. Others, those at a task's edges and those of more than `block` rows or BLOCK_BYTES of text, are
searched block by block from every state, in parallel, and put together in order by the states at the blocks' ends:
(cost, audit) of a path through blocks is a sum and a concatenation. That last step streams a conversation's blocks through one task, which holds a
block, four audits and four running hashes; SHA-256 of one conversation is a chain and can't be split further.

Defined results: null conv_id, role and text count as one space in what they are compared, hashed and shown as; a null conv_id is one
conversation of its own; null turns stand first and are no turns for gaps; an empty role has the initial '-', which fits nowhere; rows that agree in all four columns are
repeats, each with its own edit; very long texts are whole; a conversation all of whose rows are gone has zeros, an empty audit and
the hash of nothing; an empty table gives an empty table; other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import counted, cut

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 512
BLOCK_BYTES = 1 << 18
#: States of the order: nothing yet, after system, after user, after assistant; a conversation may end in the first and the last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (EMPTY, ASSISTANT)
#: By state: the state that each initial leads to, and the role that may be put there.
STEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
NEXT = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_LEGAL = {"su", "ua", "au"}
_SMALL = 200_000


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n: rows as crc32 of conv_id:turn damages them; a row that it drops stays with n 0, so that no conversation is lost."""
    text, kind = F.coalesce("text", F.lit(" ")), F.col("_kind")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    dealt = rows.select("conv_id", "turn", "role", "text", (F.crc32(name.cast("binary")) % 20).alias("_kind"))
    changed = F.when(kind <= 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 0, "").when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    return dealt.select("conv_id", "turn", role.alias("role"), changed.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"))


@dataclass
class Row:
    role: str
    text: str
    fault: int

    @property
    def initial(self) -> str:
        return self.role[:1] or "-"


def search(rows: list[Row], start: int, whole: bool) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the cheapest edits from the state start to each state behind the rows; whole: only to the first of ENDS."""
    floor = [0] * (len(rows) + 1)
    for i in range(len(rows) - 1, -1, -1):
        floor[i] = floor[i + 1] + (0, DELETE, DELETE, min(DELETE, TRUNCATED))[rows[i].fault]
    queue = [(floor[0], "", 0, start)]
    done, found = set(), {}
    while queue:
        f, audit, i, state = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        cost = f - floor[i]
        target, _ = NEXT[state]
        if i == len(rows):
            found[state] = (cost, audit)
            if whole and state in ENDS:
                return {state: found[state]}
        else:
            row, after = rows[i], floor[i + 1]
            if (i + 1, state) not in done:
                heapq.heappush(queue, (cost + DELETE + after, audit + "D", i + 1, state))
            if row.fault not in (1, 2):
                extra = TRUNCATED if row.fault else 0
                kept = STEPS[state].get(row.initial)
                if kept is not None:
                    heapq.heappush(queue, (cost + KEEP + extra + after, audit + "K", i + 1, kept))
                if target != kept:  # where a row may stay as it is, a new role only costs
                    heapq.heappush(queue, (cost + REROLE + extra + after, audit + "R", i + 1, target))
        if (i, target) not in done:
            heapq.heappush(queue, (f + INSERT, audit + "I", i, target))
    return found


def repaired(rows: list[Row], audit: str, state: int) -> tuple[list[str], int]:
    """(lines role:text, the state behind them) of the edits of audit, from a state."""
    out, at = [], 0
    for edit in audit:
        target, role = NEXT[state]
        if edit == "I":
            out.append(f"{role}:")
            state = target
            continue
        row, at = rows[at], at + 1
        if edit == "K":
            out.append(f"{row.role}:{row.text}")
            state = STEPS[state][row.initial]
        elif edit == "R":
            out.append(f"{role}:{row.text}")
            state = target
    return out, state


@dataclass
class Block:
    """Neighbouring rows of a conversation, with what is counted of them."""

    rows: list[Row] = field(default_factory=list)
    turns: list[int] = field(default_factory=list)  # first, last, number of different ones

    @classmethod
    def of(cls, rows: list[Row], turns: list[int | None]) -> Block:
        seen = [t for t in turns if t is not None]
        return cls(rows, [seen[0], seen[-1], len(set(seen))] if seen else [])


@dataclass
class Totals:
    """A conversation's counts, block after block."""

    turns: list[int] = field(default_factory=list)
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    last: str = ""

    def add(self, block: Block) -> None:
        if block.turns:
            first, last, n = block.turns
            self.turns = [self.turns[0], last, self.turns[2] + n - (self.turns[1] == first)] if self.turns else block.turns
        for row in block.rows:
            self.faults[row.fault] += 1
            self.illegal += bool(self.last) and self.last + row.initial not in _LEGAL
            self.last = row.initial

    def row(self, conv: int | None, cost: int, audit: str, digest: str) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return (conv, gaps, *self.faults[1:], self.illegal, cost, audit, digest)


def together(conv: int | None, blocks: Iterator[tuple[Block, dict[int, dict[int, tuple[int, str]]]]]) -> tuple:
    """A conversation's result from its blocks' rows and paths, in order; holds one block, and an audit and a running hash for each state."""
    totals = Totals()
    best: dict[int, tuple[int, str]] = {EMPTY: (0, "")}
    hashes = {EMPTY: (hashlib.sha256(), True)}  # and whether nothing has been written
    for block, paths in blocks:
        totals.add(block)
        came: dict[int, tuple[int, str, int, str]] = {}
        for state, (cost, audit) in best.items():
            for end, (more, edits) in paths[state].items():
                new = (cost + more, audit + edits, state, edits)
                if end not in came or new[:2] < came[end][:2]:
                    came[end] = new
        drawn: dict[tuple[int, str], str] = {}
        after = {}
        for end, (_, _, state, edits) in came.items():
            if (state, edits) not in drawn:
                drawn[state, edits] = "\n".join(repaired(block.rows, edits, state)[0])
            digest, nothing = hashes[state]
            text = drawn[state, edits]
            if edits.strip("D"):
                digest = digest.copy()
                digest.update((text if nothing else f"\n{text}").encode("utf-8", "replace"))
                nothing = False
            after[end] = (digest, nothing)
        best, hashes = {end: x[:2] for end, x in came.items()}, after
    cost, audit, end = min((*best[e], e) for e in ENDS if e in best)
    return totals.row(conv, cost, audit, hashes[end][0].hexdigest())


def _result(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 9, kinds, strict=True)], list(_NAMES))


_NAMES = ("conv_id", *COUNTS, "audit", "repaired_sha256")
_FINAL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_PATHS = "array<struct<start:int,end:int,cost:long,audit:string>>"
_ROWS = "array<struct<role:string,text:string,fault:int>>"
_BLOCK = f"done boolean, {_FINAL}, part int, number long, turns array<long>, rows {_ROWS}, paths {_PATHS}"


def _schema(*fields: str) -> pa.Schema:
    row = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("fault", pa.int32())]))
    path = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    final = [(c, pa.string() if c in ("audit", "repaired_sha256") else pa.int64()) for c in _NAMES]
    return pa.schema([("done", pa.bool_()), *final, ("part", pa.int32()), ("number", pa.int64()), ("turns", pa.list_(pa.int64())), ("rows", row), ("paths", path)])


def _blocks(batches: Iterator[pa.RecordBatch], most: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Of a task's rows in order: results of conversations that end within a block, and blocks of the others."""
    schema, part = _schema(), TaskContext.get().partitionId()
    out: list[dict] = []
    number = 0

    def sent(least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(out) >= least:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()

    def block(conv, rows, turns, edge: bool) -> None:
        nonlocal number
        b = Block.of(rows, turns)
        if not edge:
            (cost, audit), = search(rows, EMPTY, whole=True).values()
            totals = Totals()
            totals.add(b)
            digest = hashlib.sha256("\n".join(repaired(rows, audit, EMPTY)[0]).encode("utf-8", "replace")).hexdigest()
            out.append({"done": True, **dict(zip(_NAMES, totals.row(conv, cost, audit, digest), strict=True))})
            return
        paths = [{"start": s, "end": e, "cost": c, "audit": a} for s in range(4) for e, (c, a) in search(rows, s, whole=False).items()]
        listed = [{"role": r.role, "text": r.text, "fault": r.fault} for r in rows]
        out.append({"done": False, "conv_id": conv, "part": part, "number": number, "turns": b.turns, "rows": listed, "paths": paths})
        number += 1

    conv, rows, turns, size, first, open_, any_ = None, [], [], 0, True, False, False
    for batch in batches:
        for c, turn, role, text, fault, n, later in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if any_ and c != conv:
                block(conv, rows, turns, edge=first or open_)
                rows, turns, size, first, open_ = [], [], 0, False, False
            conv, any_ = c, True
            for k in range(n):
                if rows and (len(rows) >= most or size + len(text) > most_bytes):
                    block(conv, rows, turns, edge=True)
                    rows, turns, size, open_ = [], [], 0, True
                rows.append(Row(role, text, fault if fault == 1 else 2 if later or k else fault))
                turns.append(turn)
                size += len(text)
            yield from sent(64)
    if any_:
        block(conv, rows, turns, edge=True)
    yield from sent()


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations whose blocks come in order."""

    def blocks():
        for batch in batches:
            for k in range(batch.num_rows):
                (x,) = batch.slice(k, 1).to_pylist()
                paths: dict[int, dict[int, tuple[int, str]]] = {}
                for p in x["paths"]:
                    paths.setdefault(p["start"], {})[p["end"]] = (p["cost"], p["audit"])
                yield x["conv_id"], Block([Row(**r) for r in x["rows"]], x["turns"]), paths

    stream = blocks()
    held = next(stream, None)
    while held:
        conv = held[0]

        def own(conv=conv):
            nonlocal held
            while held and held[0] == conv:
                yield held[1:]
                held = next(stream, None)

        yield _result([together(conv, own())])


def repair(rows: DataFrame, block: int = BLOCK, block_bytes: int = BLOCK_BYTES, small: int = _SMALL) -> DataFrame:
    """conv_id, counts, cost, audit and repaired_sha256 of each conversation; rows: conv_id, turn, role, text, n (how often; 0: it is gone)."""
    key = ("conv_id", "turn", "role", "text")
    summed = rows.groupBy(*key).agg(F.sum("n").alias("n"))
    mark = F.md5(F.concat_ws("/", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.md5("role"), F.md5("text"))).alias("_same")
    told = summed.withColumn("_same", mark)
    # where a role and text stand in more than one place: the first, nulls before all
    many = told.where("n > 0").groupBy("_same").agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("_first"), F.count("*").alias("_c"))
    many = counted(many.where("_c > 1").select("_same", F.col("_first.turn").alias("_turn")).withColumn("_met", F.lit(True)), small)
    placed = told.join(many, "_same", "left").withColumn("later", F.coalesce(F.col("_met") & ~F.col("turn").eqNullSafe(F.col("_turn")), F.lit(False)))
    blank = ~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    broken = ~F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    fault = F.when(blank, 1).when(broken, 3).otherwise(0).cast("int")
    # copies in runs, so that very many of them are spread as well
    runs = placed.withColumn("_from", F.explode(F.expr(f"sequence(0L, greatest(n - 1, 0L), {block}L)")))
    runs = runs.select(*key, fault.alias("fault"), F.expr(f"greatest(least(n - _from, {block}L), 0L)").alias("n"), (F.col("later") | (F.col("_from") > 0)).alias("later"), "_from")
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "_from"]
    ranged = runs.repartitionByRange(*order).sortWithinPartitions(*order).drop("_from")
    found = cut(ranged.mapInArrow(lambda batches: _blocks(batches, block, block_bytes), _BLOCK))
    shared = found.where("NOT done").select("conv_id", "part", "number", "turns", "rows", "paths")
    shared = shared.repartition(F.col("conv_id")).sortWithinPartitions(F.asc_nulls_first("conv_id"), "part", "number")
    whole = found.where("done").select(*_NAMES)
    return whole.union(shared.mapInArrow(_folded, _FINAL))
