"""Repair of conversations: the cheapest edits that give alternating roles, with an audit of them.

Edits are kept as linked nodes that share their prefixes, so a state of the dynamic program costs one
node, and equally cheap audits are compared by their longest common prefix: every node has ancestors
at powers of two and a rolling hash of all that leads to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import map_arrow, slices, staged

PRIME, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E68
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows of one conversation that are solved together.
BLOCK_ROWS = 1024
#: What the roles kept so far end with: nothing, a system row, a user row, an assistant row.
NONE, SYSTEM, USER, ASSISTANT = range(4)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _hash(text: str) -> int:
    value = 0
    for c in text:
        value = (value * BASE + ord(c)) % PRIME
    return value


class Edits:
    """A string of edits: a piece after a parent. `depth` is its length, `hash` that of the whole string."""

    __slots__ = ("parent", "piece", "depth", "hash", "ups")

    def __init__(self, parent: Edits | None, piece: str):
        self.parent, self.piece = parent, piece
        if parent is None:
            self.depth, self.hash, self.ups = 0, 0, ()
            return
        self.depth = parent.depth + len(piece)
        self.hash = (parent.hash * pow(BASE, len(piece), PRIME) + _hash(piece)) % PRIME
        ups, up = [parent], parent
        while len(up.ups) >= len(ups):  # the ancestor 2^k above is 2^(k-1) above the one 2^(k-1) above
            up = up.ups[len(ups) - 1]
            ups.append(up)
        self.ups = tuple(ups)

    def prefix_hash(self, length: int) -> int:
        """The hash of the first `length` characters."""
        if length >= self.depth:
            return self.hash
        node = self
        for k in range(len(node.ups) - 1, -1, -1):
            while k < len(node.ups) and node.ups[k].depth >= length:
                node = node.ups[k]
        if node.depth == length:
            return node.hash
        rest = length - node.parent.depth
        return (node.parent.hash * pow(BASE, rest, PRIME) + _hash(node.piece[:rest])) % PRIME

    def __str__(self) -> str:
        return _tails(self, ROOT)[0]


ROOT = Edits(None, "")


def _tails(a: Edits, b: Edits) -> tuple[str, str, int]:
    """What follows the nearest node that both have in common, in each, and its depth."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.piece)
            a = a.parent
        else:
            right.append(b.piece)
            b = b.parent
    return "".join(reversed(left)), "".join(reversed(right)), a.depth


def less(a: Edits, b: Edits) -> bool:
    """If the string of `a` comes before that of `b`: by the first character after the longest common prefix.

    The prefix is searched by hashes and then compared; if a collision made it too long, the strings are compared.
    """
    if a is b:
        return False
    low, high = 0, min(a.depth, b.depth)
    while low < high:
        middle = (low + high + 1) // 2
        if a.prefix_hash(middle) == b.prefix_hash(middle):
            low = middle
        else:
            high = middle - 1
    left, right, depth = _tails(a, b)
    at = low - depth
    if at < 0 or left[:at] != right[:at]:
        return left < right
    return left[at : at + 1] < right[at : at + 1]


Best = tuple[int, Edits] | None


def better(a: Best, b: Best) -> Best:
    """The cheaper one; of equally cheap ones the one that comes first.

    Of two equally cheap ways to one state neither is a prefix of the other, as each edit has its
    price: what follows can't change their order.
    """
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if less(b[1], a[1]) else a


def begun(start: int) -> list[Best]:
    """Ways before the first row: only `start` is reached."""
    return [(0, ROOT) if s == start else None for s in range(4)]


def _then(way: Best, cost: int, piece: str) -> Best:
    return way and (way[0] + cost, Edits(way[1], piece))


def _cheapest(ways: Iterable[tuple[Best, int, str]]) -> Best:
    """The best of (way, cost, piece); nodes are made for the cheapest only."""
    ways = [w for w in ways if w[0] is not None]
    if not ways:
        return None
    least = min(w[0][0] + w[1] for w in ways)
    best: Best = None
    for way, cost, piece in ways:
        if way[0] + cost == least:
            best = better(best, _then(way, cost, piece) if piece else way)
    return best


def inserted(ways: list[Best]) -> list[Best]:
    """With rows inserted: a user row after anything else, an assistant row after a user row."""
    none, system, user, assistant = ways
    user = _cheapest([(user, 0, ""), (none, INSERT, "I"), (system, INSERT, "I"), (assistant, INSERT, "I")])
    assistant = _cheapest([(assistant, 0, ""), (user, INSERT, "I")])
    return [none, system, user, assistant]


def after_row(ways: list[Best], role: str, faulty: bool, truncated: bool, copies: int) -> list[Best]:
    """Ways after one row and its copies. A faulty row (blank, or seen before) goes, and so does every further copy."""
    ways = inserted(ways)
    if faulty:
        return [_then(w, DELETE * copies, "D" * copies) for w in ways]
    none, system, user, assistant = ways
    more, rest, gone = TRUNCATED * truncated, DELETE * (copies - 1), "D" * (copies - 1)
    keep, rerole, delete = (KEEP + more + rest, "K" + gone), (REROLE + more + rest, "R" + gone), (DELETE + rest, "D" + gone)
    to_user, to_assistant = keep if role == "u" else rerole, keep if role == "a" else rerole
    return [
        _cheapest([(none, *delete)]),
        _cheapest([(system, *delete), *([(none, *keep)] if role == "s" else [])]),
        _cheapest([(user, *delete), (none, *to_user), (system, *to_user), (assistant, *to_user)]),
        _cheapest([(assistant, *delete), (user, *to_assistant)]),
    ]


def finished(ways: list[Best]) -> tuple[int, str]:
    """Cost and audit of the best way to an empty or whole conversation."""
    ways = inserted(ways)
    cost, edits = better(ways[NONE], ways[ASSISTANT])
    return cost, str(edits)


def illegal(before: str | None, role: str, copies: int = 1) -> int:
    """Neighbours that may not stand side by side; further copies never may."""
    return copies - 1 + (before is not None and before + role not in ("su", "ua", "au"))


class Block:
    """Rows of one conversation from every state it may start in, to be joined with the blocks around it."""

    def __init__(self, starts: Iterable[int]):
        self.ways = {s: begun(s) for s in starts}
        self.rows, self.illegal, self.first, self.last = 0, 0, None, None

    def add(self, role: str, faulty: bool, truncated: bool, copies: int) -> None:
        self.ways = {s: after_row(w, role, faulty, truncated, copies) for s, w in self.ways.items()}
        self.illegal += illegal(self.last, role, copies)
        self.rows, self.first, self.last = self.rows + 1, self.first or role, role

    def entries(self) -> list[tuple[int, int, int, str]]:
        return [(s, e, w[0], str(w[1])) for s, ways in self.ways.items() for e, w in enumerate(ways) if w]


def joined(ways: list[Best], entries: list[tuple[int, int, int, str]]) -> list[Best]:
    return [_cheapest((ways[s], cost, audit) for s, e, cost, audit in entries if e == end) for end in range(4)]


# Spark


def damaged(table: DataFrame) -> DataFrame:
    """(conv, turn, role, text): nulls as one blank, and by crc32 of `conv_id:turn` modulo 20 a row goes (0), loses its text (1),
    loses its full stops (2), stands twice (3) or becomes the user's (4)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = table.select(F.col("conv_id").alias("conv"), "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    rows = rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return rows.drop("copy")


def _is_blank() -> Column:
    return ~F.col("text").rlike(r"[^\x20\x09-\x0D]")


def _key() -> Column:
    """A row's role and text in short; rows of one turn are in its order."""
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))


def solved(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv, cost, illegal, audit) from (conv, turn, key, role, faulty, truncated, copies).

    Rows are cut into ranges of (conv, turn, key), so one conversation may span many tasks. Those within a
    task are solved there; the others leave blocks that are joined in order, a string per pair of states each.
    """
    kind = turns.schema["conv"].dataType.simpleString()
    names = ["conv", "part", "block", "whole", "cost", "illegal", "audit", "first", "last", "starts", "ends", "costs", "audits"]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, runs, now, state, types = TaskContext.get().partitionId(), 0, 0, None, None, None
        flushed, rows = False, []

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
            rows.clear()
            return made

        def flush() -> None:
            nonlocal number
            e = list(zip(*state.entries()))
            rows.append((now, part, number, False, None, state.illegal, None, state.first, state.last, *map(list, e)))
            number += 1

        for batch in batches:
            types = [batch.schema.field("conv").type, pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string())]
            for conv, role, faulty, truncated, copies in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "faulty", "truncated", "copies"))):
                if not runs or conv != now:
                    if runs > 1 and not flushed:  # neither the first nor the last of this task: nothing of it is elsewhere
                        cost, audit = finished(state.ways[NONE])
                        rows.append((now, part, number, True, cost, state.illegal, audit, None, None, [], [], [], []))
                    elif runs and state.rows:
                        flush()
                    runs, now, flushed = runs + 1, conv, False
                    state = Block(range(4) if runs == 1 else (NONE,))
                elif state.rows >= block_rows:
                    flush()
                    flushed, state = True, Block(range(4))
                state.add(role, faulty, truncated, copies)
                if len(rows) >= 256:
                    yield batch_of()
        if runs:
            flush()
            yield batch_of()

    ranged = turns.repartitionByRange("conv", "turn", "key").sortWithinPartitions("conv", "turn", "key")
    schema = f"conv {kind}, part int, block int, whole boolean, cost long, illegal long, audit string, first string, last string, starts array<int>, ends array<int>, costs array<long>, audits array<string>"
    blocks = staged(map_arrow(ranged.select("conv", "role", "faulty", "truncated", "copies"), solve, schema), "conversation-blocks")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, now, ways, wrong, last, kinds = False, None, None, 0, None, None

        def told() -> pa.RecordBatch:
            cost, audit = finished(ways)
            return pa.RecordBatch.from_arrays([pa.array([now], kinds), pa.array([cost], pa.int64()), pa.array([wrong], pa.int64()), pa.array([audit], pa.string())], ["conv", "cost", "illegal", "audit"])

        for batch in batches:
            kinds = batch.schema.field("conv").type
            for conv, bad, first, end, *entries in zip(*(batch.column(c).to_pylist() for c in ("conv", "illegal", "first", "last", "starts", "ends", "costs", "audits"))):
                if not started or conv != now:
                    if started:
                        yield told()
                    started, now, ways, wrong, last = True, conv, begun(NONE), 0, None
                wrong += bad + illegal(last, first)
                ways, last = joined(ways, list(zip(*entries))), end
        if started:
            yield told()

    cut = blocks.where("not whole").repartition("conv").sortWithinPartitions("conv", "part", "block")
    across = map_arrow(cut.select("conv", "illegal", "first", "last", "starts", "ends", "costs", "audits"), join, f"conv {kind}, cost long, illegal long, audit string")
    return blocks.where("whole").select("conv", "cost", "illegal", "audit").unionByName(across)


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, cost, illegal, audit, sha): the lines `role:text` of each repaired conversation, hashed in order.

    A hash of lines in order is a chain: the rows of a conversation pass one task, sorted, and none of them is held.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    none = F.lit(None)
    lines = rows.select("conv", F.lit(1).alias("kind"), "turn", "key", "role", "text", none.cast("long").alias("cost"), none.cast("long").alias("illegal"))
    heads = audits.select("conv", F.lit(0).alias("kind"), none.cast(rows.schema["turn"].dataType).alias("turn"), none.cast("string").alias("key"), none.cast("string").alias("role"), F.col("audit").alias("text"), "cost", "illegal")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, now, found, kinds = False, None, None, None

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], kinds), *(pa.array([v], t) for v, t in zip((found.cost, found.illegal, found.audit, found.end()), (pa.int64(), pa.int64(), pa.string(), pa.string())))], ["conv", "cost", "illegal", "audit", "sha"])

        for batch in batches:
            kinds = batch.schema.field("conv").type
            for part in slices(batch, "text"):
                for conv, kind, role, text, cost, wrong in zip(*(part[c] for c in ("conv", "kind", "role", "text", "cost", "illegal"))):
                    if kind == 0:
                        if started:
                            yield told()
                        started, now, found = True, conv, Lines(text, cost, wrong)
                    else:
                        found.row(role, text)
        if started:
            yield told()

    ordered = heads.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "key")
    return map_arrow(ordered.select("conv", "kind", "role", "text", "cost", "illegal"), read, f"conv {kind}, cost long, illegal long, audit string, sha string")


class Lines:
    """The repaired lines of one conversation, hashed as its rows pass."""

    def __init__(self, audit: str, cost: int, wrong: int):
        self.audit, self.cost, self.illegal, self.at, self.last = audit, cost, wrong, 0, ""
        self.sha = hashlib.sha256()
        self.some = False

    def line(self, role: str, text: str) -> None:
        self.sha.update(f"\n{role}:{text}".encode() if self.some else f"{role}:{text}".encode())
        self.some, self.last = True, role[:1]

    def other(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.line(self.other(), "")
            self.at += 1

    def row(self, role: str, text: str | None) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.line(role if edit == "K" else self.other(), text or "")

    def end(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


def repair(table: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are in the order of turn, nulls first, and within a turn in that of a hash of role and text. A null
    role, text, turn or conv_id counts as one blank where text is made of it; rows without conv_id are one
    conversation. Repeated rows are copies, so all but the first are duplicates. A conversation that loses all rows
    has zeros, an empty audit and the hash of nothing; an empty table gives no rows; other columns are
    ignored; gaps beyond a long are null. Roles count by their first character, as they are written.
    """
    rows = damaged(table).select("conv", "turn", "role", "text", _key().alias("key"), _is_blank().alias("blank"))
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    initial = F.substring("role", 1, 1)
    short = rows.select("conv", "turn", "key", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("role"), "blank", whole.alias("whole"))
    counted = staged(short.groupBy("conv", "turn", "key", "role", "blank", "whole").agg(F.count(F.lit(1)).alias("copies")), "conversation-turns")
    firsts = counted.groupBy(F.col("conv").alias("of"), F.col("key").alias("first_key")).agg(F.min(F.struct("turn")).alias("earliest"))
    same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("key") == F.col("first_key"))
    turns = counted.join(firsts, same).select(*counted.columns, (~F.col("earliest.turn").eqNullSafe(F.col("turn"))).alias("seen"))
    turns = staged(turns.select("*", (F.col("blank") | F.col("seen")).alias("faulty"), (~F.col("blank") & ~F.col("seen") & ~F.col("whole")).alias("truncated")), "conversation-faults")
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    turn = lambda f: f("turn").cast("decimal(38,0)")
    faults = turns.groupBy("conv").agg(
        F.when(F.max("turn").isNull(), 0).otherwise(turn(F.max) - turn(F.min) + 1 - F.count_distinct("turn")).alias("gaps"),
        count(F.when(F.col("blank"), F.col("copies"))).alias("blank"),
        count(F.when(~F.col("blank"), F.col("copies") - F.when(F.col("seen"), 0).otherwise(1))).alias("duplicate"),
        count(F.when(F.col("truncated"), 1)).alias("truncated"),
    )
    lines = rows.select("conv", "turn", "key", "role", F.when(~F.col("blank"), F.col("text")).alias("text"))
    found = repaired(lines, solved(turns, block_rows))
    zero, no = F.lit(0).cast("long"), F.lit(None).cast("string")
    long = lambda c: F.expr(f"try_cast({c} as bigint)").alias(c)
    columns = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha"]
    parts = [
        faults.select("conv", long("gaps"), "blank", "duplicate", "truncated", zero.alias("illegal"), zero.alias("cost"), no.alias("audit"), no.alias("sha"), F.lit(1).alias("told")),
        found.select("conv", zero.alias("gaps"), *(zero.alias(c) for c in ("blank", "duplicate", "truncated")), "illegal", "cost", "audit", "sha", F.lit(0).alias("told")),
        table.groupBy(F.col("conv_id").alias("conv")).agg(F.lit(0).alias("told")).select("conv", *(zero.alias(c) for c in columns[1:7]), no.alias("audit"), no.alias("sha"), "told"),
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    # Without a row of faults there are no gaps; those that no long holds stay null.
    gaps = F.when(F.max("told") == 0, 0).otherwise(F.max(F.when(F.col("told") == 1, F.col("gaps"))))
    return every.groupBy("conv").agg(
        gaps.cast("long").alias("gaps"), *(F.sum(c).alias(c) for c in columns[2:7]),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("sha"), F.lit(EMPTY_SHA)).alias("repaired_sha256"),
    ).withColumnRenamed("conv", "conv_id")
