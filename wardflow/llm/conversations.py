"""Repair of conversation structure: the cheapest edits that make the roles alternate, of equally cheap ones the least audit.

The rows of a conversation, in turn order, are a chain of nodes (row, state); the state says what the last kept role
was.  Keep, Rerole, Delete and Insert are arcs; a backward dynamic programme gives every node its cost to the end, and
arcs that lose nothing are optimal.  Of the optimal paths the one with the ASCII-least audit (initials of its edits) is
found by prefix doubling: nodes are ranked by the first letter of their least audit, then by 2, 4, 8 ... letters, each
rank from the ranks of a node and of the node that its pointer reaches; the doubled pointers then give the node at every
step of the least path at once.  (The optimal arcs of a node bear different letters, so no two least paths tie.)

Conversations may be of any length.  Rows are range-partitioned by conversation and turn, so a long conversation lies in
several tasks, and each task cuts its rows into segments.  A segment of a longer conversation is first reduced to its
costs from state to state (a 4 x 4 min-plus matrix); a scan over these small summaries, backward for the costs and
forward for the states, lets every segment be repaired on its own.  Only the digest of a conversation's whole text passes
its segments one after the other, held one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import column, tune, written

# Rows and characters of a segment, unless one row is larger.
SEGMENT_ROWS = 4096
SEGMENT_CHARS = 4_000_000
# Segments whose nodes are ranked together.
RANKED_ROWS = 20_000

WHITE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
LETTERS = ".DIKR"
# What an inserted or reroled turn leads to, and what a kept initial leads to.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {0: {START: SYSTEM}, 1: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, 3: {}}
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 60
# Kinds of rows: four times the initial (s, u, a, other) and the fault (none, truncated, blank, duplicate).
LEGAL = {(0, 1), (1, 2), (2, 1)}


def inserted(costs: list[int]) -> tuple[int, ...]:
    """Costs of the four states where turns may be inserted first."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


END = inserted([0, FAR, FAR, 0])


class Chain(dict):
    """(kind, costs behind the row) to (costs before it, least optimal arc of each state); costs relative to their minimum."""

    def __missing__(self, key: tuple) -> tuple:
        kind, behind = key
        initial, fault = divmod(kind, 4)
        options = []
        for s in range(4):
            arcs = [(DELETE + behind[s], 1, s)]
            if fault < 2:
                if s in KEPT[initial]:
                    arcs.append((KEEP + fault * TRUNCATED + behind[KEPT[initial][s]], 3, KEPT[initial][s]))
                arcs.append((REROLE + fault * TRUNCATED + behind[NEXT[s]], 4, NEXT[s]))
            options.append(arcs)
        before = inserted([min(a[0] for a in arcs) for arcs in options])
        best = []
        for s, arcs in enumerate(options):
            arcs.append((INSERT + before[NEXT[s]], 2, NEXT[s]))
            best.append(min((letter, target) for cost, letter, target in arcs if cost == before[s] or before[s] >= FAR))
        low = min(before)
        self[key] = out = (tuple(min(FAR, c - low) for c in before), low, tuple(best))
        return out

    def costs(self, kinds: bytes, behind: tuple) -> tuple[int, ...]:
        """Costs before the first of the rows."""
        total = min(behind)
        now = tuple(min(FAR, c - total) for c in behind)
        for kind in reversed(kinds):
            now, low, _ = self[kind, now]
            total += low
        return tuple(c + total if c < FAR else FAR for c in now)

    def matrix(self, kinds: bytes) -> list[int]:
        """Cost of each state before the rows to each state behind them, 16 numbers by the state behind."""
        return [c for s in range(4) for c in self.costs(kinds, tuple(0 if t == s else FAR for t in range(4)))]

    def arcs(self, kinds: bytes, behind: tuple | None) -> tuple[np.ndarray, np.ndarray]:
        """Letter and target of every node's least optimal arc; nodes behind the rows have none, or the inserts of the end."""
        n = len(kinds)
        letter, target = np.zeros((n + 1, 4), np.int8), np.arange(4 * n + 4).reshape(n + 1, 4)
        if behind is None:
            behind = END
            letter[n, [SYSTEM, USER]], target[n, [SYSTEM, USER]] = 2, (4 * n + USER, 4 * n + ASSISTANT)
        low = min(behind)
        now = tuple(min(FAR, c - low) for c in behind)
        for i in range(n - 1, -1, -1):
            now, _, best = self[kinds[i], now]
            letter[i] = [a[0] for a in best]
            target[i] = [4 * (i if a[0] == 2 else i + 1) + a[1] for a in best]
        return letter.ravel(), target.ravel()


def least_paths(letter: np.ndarray, target: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix doubling: ``(rank, nodes, ends)``, all nodes ranked by their least audits, and the nodes of the least path of
    each start one after the other; path i ends before ``ends[i]``.  A node without letter points to itself."""
    rank, steps, jump, doubled = letter.astype(np.int64), (letter > 0).astype(np.int64), target, [target]
    while (letter[jump] > 0).any():
        # Twice the letters: the rank of the node, then that of the node its pointer reaches.
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)[1]
        steps = steps + steps[jump]
        jump = jump[jump]
        doubled.append(jump)
    lengths = steps[starts]
    ends = np.cumsum(lengths)
    nodes = np.repeat(starts, lengths)
    step = np.arange(len(nodes)) - np.repeat(ends - lengths, lengths)
    for k, pointer in enumerate(doubled):
        move = (step >> k) & 1 == 1
        nodes[move] = pointer[nodes[move]]
    return rank, nodes, ends


def facts(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, role, text, kind, row`` per row: nulls of role and text are one space, the first fault of a row counts."""
    rows = df.select(
        column(id_col).alias("conv"), column(turn_col).cast("bigint").alias("turn"),
        F.coalesce(column(role_col), F.lit(" ")).alias("role"), F.coalesce(column(text_col), F.lit(" ")).alias("text"),
    )
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "turns")
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = rows.withColumn("fault", F.when(end == "", 2).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)).withColumn("digest", F.when(F.col("fault") < 2, F.sha2("text", 256)))
    # Texts of a role that come again, with the place of the first: few, or else met by a join that splits hot keys.
    order = F.struct("turn", "row")
    again = rows.where("fault < 2").groupBy("conv", "role", "digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = again.select(F.col("conv").alias("__conv"), F.col("role").alias("__role"), F.col("digest").alias("__digest"), F.col("first.row").alias("__first"))
    same = F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("role") == F.col("__role")) & (F.col("digest") == F.col("__digest"))
    rows = rows.join(again, same, "left")
    fault = F.when(F.col("__first") != F.col("row"), 3).otherwise(F.col("fault"))
    initial = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(F.col("role").startswith("a"), 2).otherwise(3)
    return rows.select("conv", "turn", "role", "text", (4 * initial + fault).alias("kind"), "row")


def _rows_out(schema: StructType) -> Callable[[list[dict]], pa.RecordBatch]:
    arrow = to_arrow_schema(schema)
    return lambda rows: pa.RecordBatch.from_pylist(rows, schema=arrow)


def _cut(out: Callable, rows_limit: int, chars_limit: int):
    """Sorted rows to segments; ``whole`` where the task has seen the rows before and after a conversation's only segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, chars, size, held, ready, begun = TaskContext.get().partitionId(), 0, 0, 0, None, [], False

        def closed(last: bool) -> None:
            nonlocal seq, chars, size
            ready.append(held | {"part": part, "seq": seq, "whole": last and held["first"], "kinds": bytes(held["kinds"])})
            seq, chars, size = seq + 1, 0, size + chars

        for batch in batches:
            for conv, turn, role, text, kind in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "kind"))):
                other = held is None or held["conv"] != conv
                if other or len(held["kinds"]) >= rows_limit or chars >= chars_limit:
                    if held is not None:
                        closed(other)
                    held = {"conv": conv, "first": other and begun, "kinds": [], "turns": [], "roles": [], "texts": []}
                    begun = True
                    if len(ready) >= 500 or size >= chars_limit:
                        yield out(ready)
                        ready.clear()
                        size = 0
                held["kinds"].append(kind)
                held["turns"].append(turn)
                held["roles"].append(role)
                held["texts"].append(text)
                chars += len(text) + len(role)
        if held is not None:
            closed(False)
        if ready:
            yield out(ready)

    return run


def segments(rows: DataFrame, rows_limit: int = SEGMENT_ROWS, chars_limit: int = SEGMENT_CHARS) -> DataFrame:
    """``conv, part, seq, whole, kinds, turns, roles, texts``: conversations in turn order, long ones in several rows.

    Equal turns are ordered by role, then text.  A range of the sort key is one task; the key has the whole text of short
    rows and a prefix of others, so that neither a hot conversation, turn or text lies in one task nor long texts are
    sampled for the range bounds.
    """
    head = F.substring("text", 1, 64)
    tie = F.when(F.length("text") <= 64, F.col("row")).otherwise(F.lit((1 << 63) - 1))
    ranged = rows.repartitionByRange("conv", "turn", "role", head, tie).sortWithinPartitions("conv", "turn", "role", "text", "row")
    kind = rows.schema["conv"].dataType.simpleString()
    schema = StructType.fromDDL(f"conv {kind}, part int, seq int, whole boolean, kinds binary, turns array<bigint>, roles array<string>, texts array<string>")
    cut = ranged.select("conv", "turn", "role", "text", "kind").mapInArrow(_cut(_rows_out(schema), rows_limit, chars_limit), schema)
    return written(cut, "segments")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chain = Chain()
    for batch in batches:
        found = [chain.matrix(kinds) for kinds in batch.column("kinds").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "part", "seq")), pa.array(found, pa.list_(pa.int64()))], names=["conv", "part", "seq", "matrix"])


def _backward(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Costs behind each segment of a conversation; null behind the last."""
    table = table.sort_by([("part", "ascending"), ("seq", "ascending")])
    behind, now = [], None
    for matrix in reversed(table.column("matrix").to_pylist()):
        behind.append(now)
        costs = END if now is None else now
        now = [min(min(FAR, costs[t] + matrix[4 * t + s]) for t in range(4)) for s in range(4)]
    return table.select(["part", "seq"]).append_column("behind", pa.array(behind[::-1], pa.list_(pa.int64())))


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state behind each segment for each state before it, along the least paths."""
    chain = Chain()
    for batch in batches:
        found = []
        for kinds, behind in zip(batch.column("kinds").to_pylist(), batch.column("behind").to_pylist()):
            _, target = arcs = chain.arcs(kinds, None if behind is None else tuple(behind))
            state = []
            for s in range(4):
                _, nodes, _ = least_paths(*arcs, np.array([s]))
                state.append(int(target[nodes[-1]] if len(nodes) else s) % 4)
            found.append(state)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "part", "seq")), pa.array(found, pa.list_(pa.int64()))], names=["conv", "part", "seq", "exits"])


def _forward(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The state before each segment of a conversation."""
    table = table.sort_by([("part", "ascending"), ("seq", "ascending")])
    entry, now = [], START
    for exits in table.column("exits").to_pylist():
        entry.append(now)
        now = exits[now]
    return table.select(["part", "seq"]).append_column("entry", pa.array(entry, pa.int32()))


def _placed(cut: DataFrame) -> DataFrame:
    """The segments with ``entry`` and ``behind``: the state before them, the costs behind them."""
    kind = cut.schema["conv"].dataType.simpleString()
    parts = cut.where("not whole").select("conv", "part", "seq", "kinds")
    matrices = parts.mapInArrow(_matrices, f"conv {kind}, part int, seq int, matrix array<bigint>")
    behind = written(matrices.groupBy("conv").applyInArrow(_backward, "part int, seq int, behind array<bigint>"), "behind")
    exits = parts.join(behind, ["part", "seq"]).mapInArrow(_exits, f"conv {kind}, part int, seq int, exits array<bigint>")
    entry = written(exits.groupBy("conv").applyInArrow(_forward, "part int, seq int, entry int"), "entries")
    open_ones = cut.where("not whole").join(behind, ["part", "seq"]).join(entry, ["part", "seq"])
    closed = cut.where("whole").withColumn("behind", F.lit(None).cast("array<bigint>")).withColumn("entry", F.lit(START))
    return closed.unionByName(open_ones)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, str, list[tuple]]]:
    """Per segment its row, the audit, and the steps as (letter, row, state behind): many segments ranked together."""
    chain, held, rows = Chain(), [], 0

    def ranked() -> Iterator[tuple]:
        each = [chain.arcs(row["kinds"], None if row["behind"] is None else tuple(row["behind"])) for row in held]
        first = np.cumsum([0, *(len(a[0]) for a in each)])
        letter, target = np.concatenate([a[0] for a in each]), np.concatenate([a[1] + at for a, at in zip(each, first)])
        _, nodes, ends = least_paths(letter, target, first[:-1] + np.array([row["entry"] for row in held]))
        begin = 0
        for row, at, end in zip(held, first.tolist(), ends.tolist()):
            path = nodes[begin:end]
            letters, begin = letter[path].tolist(), end
            audit = "".join(LETTERS[x] for x in letters)
            yield row, audit, list(zip(letters, ((path - at) // 4).tolist(), (target[path] % 4).tolist()))

    for batch in batches:
        for row in batch.to_pylist():
            held.append(row)
            rows += len(row["kinds"])
            if rows >= RANKED_ROWS:
                yield from ranked()
                held, rows = [], 0
    if held:
        yield from ranked()


def _turns_of(row: dict, steps: list[tuple]) -> Iterator[tuple]:
    """``(edit, turn, role, text)`` of every step; an inserted turn has no number, a deleted one keeps what it was."""
    for letter, i, state in steps:
        edit = LETTERS[letter]
        if edit == "I":
            yield edit, None, NAMES[state], ""
        else:
            yield edit, row["turns"][i], NAMES[state] if edit == "R" else row["roles"][i], row["texts"][i]


def _edits(out: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _, steps in _repaired(batches):
            found = [{"edit": e, "turn": t, "role": r, "text": x} for e, t, r, x in _turns_of(row, steps)]
            yield out([{"conv": row["conv"], "part": row["part"], "seq": row["seq"], "edits": found}])

    return run


def _spent(audit: str, steps: list[tuple], kinds: bytes) -> int:
    cost = {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}
    return sum(cost[x] for x in audit) + sum(TRUNCATED for letter, i, _ in steps if letter > 2 and kinds[i] % 4 == 1)


def _pieces(out: Callable):
    """Figures of each segment, and the digest of its repaired text where it is a whole conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, chars = [], 0
        for row, audit, steps in _repaired(batches):
            kinds, turns = row["kinds"], [t for t in row["turns"] if t is not None]
            initials = [k // 4 for k in kinds]
            text = "\n".join(f"{r}:{x}" for e, _, r, x in _turns_of(row, steps) if e != "D")
            faults = [k % 4 for k in kinds]
            piece = {c: row[c] for c in ("conv", "part", "seq", "whole")}
            piece |= {"blank": faults.count(2), "duplicate": faults.count(3), "truncated": faults.count(1)}
            piece |= {"illegal": sum(p not in LEGAL for p in zip(initials, initials[1:])), "first": initials[0], "last": initials[-1]}
            piece |= {"low": turns[0] if turns else None, "high": turns[-1] if turns else None, "turns": len(set(turns))}
            piece |= {"cost": _spent(audit, steps, kinds), "audit": audit, "text": None if row["whole"] else text}
            piece |= {"sha": hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() if row["whole"] else None}
            ready.append(piece)
            chars += 0 if row["whole"] else len(text)
            if len(ready) >= 500 or chars >= SEGMENT_CHARS:
                yield out(ready)
                ready, chars = [], 0
        if ready:
            yield out(ready)

    return run


_SUMS = ("blank", "duplicate", "truncated", "illegal", "cost", "turns")
_REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_NONE = hashlib.sha256(b"").hexdigest()


def _merged(out: Callable):
    """Segments, sorted by conversation and place, to one row per conversation; one segment is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, audit, begun = None, None, [], False

        def done() -> pa.RecordBatch:
            return out([now | {"whole": True, "audit": "".join(audit), "sha": digest.hexdigest(), "text": None}])

        for batch in batches:
            for piece in batch.to_pylist():
                if now is None or piece["conv"] != now["conv"]:
                    if now is not None:
                        yield done()
                    now, digest, audit, begun = piece, hashlib.sha256(), [], False
                else:
                    for c in _SUMS:
                        now[c] += piece[c]
                    now["illegal"] += (now["last"], piece["first"]) not in LEGAL
                    now["turns"] -= now["high"] is not None and now["high"] == piece["low"]
                    now["low"] = piece["low"] if now["low"] is None else now["low"]
                    now["high"] = now["high"] if piece["high"] is None else piece["high"]
                    now["last"] = piece["last"]
                audit.append(piece["audit"])
                if piece["text"]:
                    digest.update((("\n" if begun else "") + piece["text"]).encode("utf-8", "surrogatepass"))
                    begun = True
        if now is not None:
            yield done()

    return run


def _prepared(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, **limits) -> DataFrame:
    tune(df.sparkSession)
    return _placed(segments(facts(df, id_col, turn_col, role_col, text_col), **limits))


def repair_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", **limits) -> DataFrame:
    """The edits themselves: ``conv_id, part, seq, step, edit, turn, role, text``, in order of the last but four.

    ``edit`` is Keep, Rerole, Delete or Insert by its initial; without the deleted ones the rows are the repaired
    conversations.  The rules, nulls and ties are those of ``repair_report``.
    """
    placed = _prepared(df, id_col, turn_col, role_col, text_col, **limits)
    kind = placed.schema["conv"].dataType.simpleString()
    schema = StructType.fromDDL(f"conv {kind}, part int, seq int, edits array<struct<edit string, turn bigint, role string, text string>>")
    edits = placed.mapInArrow(_edits(_rows_out(schema)), schema)
    return edits.select(F.col("conv").alias("conv_id"), "part", "seq", F.posexplode("edits").alias("step", "e")).select("conv_id", "part", "seq", "step", "e.*")


def repair_report(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", **limits) -> DataFrame:
    """Per conversation: gaps, faults, illegal neighbours, cost and audit of the least repair, digest of the repaired turns.

    Rows count by turn, null turns first, equal turns by role, then text.  Null roles and texts are one space, so a null
    text is blank and a null role fits nothing; an empty role has no initial.  Repeated rows are duplicates of the first.
    Rows without id are one conversation of the null id.  An empty table gives no rows.  Only the four columns named are
    read, so others may have any name.
    """
    placed = _prepared(df, id_col, turn_col, role_col, text_col, **limits)
    kind = placed.schema["conv"].dataType.simpleString()
    schema = StructType.fromDDL(
        f"conv {kind}, part int, seq int, whole boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first int, last int, "
        "low bigint, high bigint, turns bigint, cost bigint, audit string, text string, sha string"
    )
    out = _rows_out(schema)
    pieces = written(placed.mapInArrow(_pieces(out), schema), "pieces")
    merged = pieces.where("not whole").repartition("conv").sortWithinPartitions("conv", "part", "seq").mapInArrow(_merged(out), schema)
    both = pieces.where("whole").unionByName(merged)
    gaps = F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(F.lit(0)).cast("bigint")
    return both.select(F.col("conv").alias("conv_id"), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))


def damaged(df: DataFrame) -> DataFrame:
    """``conversations`` rows with planned faults, by crc32 of ``conv_id:turn`` modulo 20: dropped (0), emptied (1), without
    ``[.!?]`` (2), twice (3), as user (4); nulls are one space in the key, in role and in text."""
    null = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), null), F.coalesce(F.col("turn").cast("string"), null))
    code = F.pmod(F.crc32(key), F.lit(20))
    role, text = F.coalesce("role", null), F.coalesce("text", null)
    rows = df.select(
        "conv_id", "turn", code.alias("code"), F.when(code == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(code == 1, F.lit("")).when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
    ).where("code <> 0")
    return rows.withColumn("copy", F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("code", "copy")


def repair_damaged(df: DataFrame, **limits) -> DataFrame:
    """The report on the damaged ``conversations``, with every original ``conv_id``; zeros where no row is left."""
    report = repair_report(damaged(df), **limits).withColumnRenamed("conv_id", "__conv")
    every = df.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(_NONE)}
    return every.select("conv_id", *[F.coalesce(c, empty.get(c, F.lit(0).cast("bigint"))).alias(c) for c in (f.split(" ")[0] for f in _REPORT.split(", "))])
