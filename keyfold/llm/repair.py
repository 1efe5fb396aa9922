"""Conversation structure repair with Four-Russians block tables.

A dialogue is to become ``(s?(ua)+)?`` in role initials by keeping, re-roling,
deleting and inserting turns at least cost.  What the turns from a place on
cost at least, from each of the four states a dialogue can be in there, is a
vector; less its minimum, only a few dozen vectors ever occur.  So for every
such vector and every block of four turns (by initial and fault) the vector
before the block is computed once, and a dialogue is gone through from its end
by one lookup a block.  The edits are then read forward: each block is expanded
backward from the vector behind it, and of the cheapest edits the ASCII-least
is taken, which makes the whole string the least.

A dialogue of more than ``segment`` turns is no single group: its turns are
numbered over ranges, cut into segments, and a segment is a map from vectors to
vectors until the segments' maps are put together, 1/``segment`` of its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm._spark import stored
from keyfold.operators.running import running_by

#: States: nothing yet, after a system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": 0, "u": 1, "a": 2}
#: Symbols: 2 * initial (3: another) + truncated; or one that must go.
SYMBOLS, GONE = 9, 8
BLOCK = 4
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: The state after an inserted or re-roled turn, the one that the state asks for.
NEXT = (USER, USER, ASSISTANT, USER)
#: The state after a kept turn, by state and initial.
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
_SPACES = " \t\n\v\f\r"
_PART_CHARS = 1 << 19


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """Cheapest costs when turns may also be inserted here first."""
    costs = list(costs)
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


#: Behind the last turn a dialogue is empty or ends with an assistant's turn.
LAST = _inserted([0, 99, 99, 0])


def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """The costs before a turn from those after it."""
    if symbol == GONE:
        return _inserted([DELETE + c for c in after])
    more = TRUNCATED * (symbol & 1)
    costs = []
    for q in range(4):
        ways = [DELETE + after[q], REROLE + more + after[NEXT[q]]]
        kept = KEPT.get((q, symbol >> 1))
        costs.append(min(ways + ([more + after[kept]] if kept is not None else [])))
    return _inserted(costs)


class Tables:
    """Vectors less their minimum, and the moves between them, a turn or a block at once."""

    def __init__(self) -> None:
        self.vectors, place, rows = [LAST], {LAST: 0}, []
        for vector in self.vectors:  # grows while new vectors come up
            row = []
            for symbol in range(SYMBOLS):
                costs = _before(vector, symbol)
                least = min(costs)
                norm = tuple(c - least for c in costs)
                if norm not in place:
                    place[norm] = len(self.vectors)
                    self.vectors.append(norm)
                row.append((place[norm], least))
            rows.append(row)
        self.step = rows
        to, add = np.array([[x[0] for x in r] for r in rows]), np.array([[x[1] for x in r] for r in rows])
        codes = np.arange(SYMBOLS ** BLOCK)
        at = np.repeat(np.arange(len(rows))[:, None], len(codes), 1)
        total = np.zeros_like(at)
        for k in range(BLOCK):  # the last turn of a block is the code's last digit
            digit = codes // SYMBOLS ** k % SYMBOLS
            total += add[at, digit]
            at = to[at, digit]
        self.block_to, self.block_add = at, total


@cache
def tables() -> Tables:
    return Tables()


def _blocks(symbols: list[int]) -> tuple[list[list[int]], list[int]]:
    """Blocks from the first turn on (the last may be shorter) and the codes of full ones."""
    blocks = [symbols[i:i + BLOCK] for i in range(0, len(symbols), BLOCK)]
    return blocks, [reduce(lambda c, s: c * SYMBOLS + s, b, 0) for b in blocks if len(b) == BLOCK]


def _walk(symbols: list[int], at, add=0):
    """Vector numbers and added cost at every block's start, from behind the last turn; ``at`` may be an array."""
    t = tables()
    blocks, codes = _blocks(symbols)
    ends = [(at, add)]
    if len(blocks) > len(codes):
        to, more = (np.array([[x[k] for x in row] for row in t.step]) for k in (0, 1))
        for symbol in reversed(blocks[-1]):
            at, add = to[at, symbol], add + more[at, symbol]
        ends.append((at, add))
    for code in reversed(codes):
        at, add = t.block_to[at, code], add + t.block_add[at, code]
        ends.append((at, add))
    return blocks, ends[::-1]


@cache
def _expanded(block: tuple[int, ...], right: int, state: int) -> tuple[str, int]:
    """(the ASCII-least cheapest edits of a block from ``state``, the state behind it)."""
    t = tables()
    at, add = [right], [0]
    for symbol in reversed(block):
        to, more = t.step[at[-1]][symbol]
        at.append(to)
        add.append(add[-1] + more)
    at.reverse()
    add.reverse()
    edits = ""
    for i, symbol in enumerate(block):
        here, after = t.vectors[at[i]], t.vectors[at[i + 1]]
        more = TRUNCATED * (symbol & 1) if symbol != GONE else 0
        while True:
            left = here[state] + add[i] - add[i + 1]
            kept = KEPT.get((state, symbol >> 1)) if symbol != GONE else None
            if DELETE + after[state] == left:
                edits += "D"
            elif INSERT + here[NEXT[state]] == here[state]:
                edits, state = edits + "I", NEXT[state]
                continue
            elif kept is not None and more + after[kept] == left:
                edits, state = edits + "K", kept
            else:
                edits, state = edits + "R", NEXT[state]
            break
    return edits, state


def edits(symbols: list[int], state: int = START, right: int = 0, last: bool = True) -> tuple[str, int, int]:
    """(edits, cost, state behind) of a run of turns entered in ``state``, with
    vector ``right`` behind it; with ``last``, missing turns are put at the end."""
    blocks, ends = _walk(symbols, right)
    cost = int(ends[0][1]) + tables().vectors[int(ends[0][0])][state]
    out = []
    for block, (behind, _) in zip(blocks, ends[1:], strict=True):
        done, state = _expanded(tuple(block), int(behind), state)
        out.append(done)
    while last and state not in (START, ASSISTANT):
        out.append("I")
        state = NEXT[state]
    return "".join(out), cost, state


def applied(edit: str, turns: list[tuple[str, str]], state: int = START) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each turn that stays or comes in."""
    rows = iter(turns)
    for e in edit:
        role, text = ("", "") if e == "I" else next(rows)
        if e == "D":
            continue
        state = KEPT[state, INITIALS[role[0]]] if e == "K" else NEXT[state]
        yield e, role if e == "K" else ROLE[state], text


def _counts(turns: list[tuple[str, str]], symbols: list[int], faults: list[int], before: str | None = None) -> list[int]:
    """Blank, duplicate, truncated turns and illegal neighbours."""
    first = [r[:1] for r, _ in turns]
    pairs = zip(([before] if before is not None else []) + first, first if before is not None else first[1:], strict=False)
    return [*(faults.count(k) for k in (1, 2, 3)), sum(a + b not in ("su", "ua", "au") for a, b in pairs)]


def _faults(turns: list[tuple[str, str]]) -> list[int]:
    """0 none, 1 blank, 2 duplicate, 3 truncated."""
    seen, out = set(), []
    for turn in turns:
        text = turn[1].rstrip(_SPACES)
        out.append(1 if not text else 2 if turn in seen else 0 if text[-1] in ".!?" else 3)
        seen.add(turn)
    return out


def _symbols(turns: list[tuple[str, str]], faults: list[int]) -> list[int]:
    return [GONE if f in (1, 2) else 2 * INITIALS.get(r[:1], 3) + (f == 3) for (r, _), f in zip(turns, faults, strict=True)]


def _grouped_rows(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) of sorted batches; the first ``keys`` columns are the key."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for key, group in groupby(rows, key=lambda row: row[:keys]):
        yield key, [row[keys:] for row in group]


def _tables_of(names: list[str], kinds: list[pa.DataType | None], rows: Iterator[tuple], size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)


_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = "edit string, position long, role string, text string"


def _dialogues(kind: pa.DataType, as_turns: bool):
    """Whole dialogues, sorted: their summaries, or their repaired turns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (conv,), rows in _grouped_rows(batches, 1):
                live = [r for r in rows if r[3]]
                turns = [(r[1], r[2]) for r in live]
                faults = _faults(turns)
                symbols = _symbols(turns, faults)
                audit, cost, _ = edits(symbols)
                kept = list(applied(audit, turns))
                if as_turns:
                    yield from ((conv, e, i, role, text) for i, (e, role, text) in enumerate(kept))
                    continue
                numbers = [r[0] for r in live if r[0] is not None]
                gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
                text = "\n".join(f"{role}:{text}" for _, role, text in kept)
                yield conv, gaps, *_counts(turns, symbols, faults), cost, audit, hashlib.sha256(text.encode()).hexdigest()
        names = ["conv_id", *(x.split()[0] for x in (_TURNS if as_turns else _SUMMARY).split(", "))]
        kinds = [kind, pa.string(), pa.int64(), pa.string(), pa.string()] if as_turns else [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        yield from _tables_of(names, kinds, found())
    return run


def _maps(kind: pa.DataType):
    """``conv_id, seg, to, add``: a segment's vector before it, and the cost, for every vector behind it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (conv, seg), rows in _grouped_rows(batches, 2):
                _, ends = _walk([r[1] for r in rows], np.arange(len(tables().vectors)), np.zeros(len(tables().vectors), np.int64))
                yield conv, seg, ends[0][0].tolist(), ends[0][1].tolist()
        yield from _tables_of(["conv_id", "seg", "to", "add"], [kind, pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())], found(), 100)
    return run


def _rights(group: pd.DataFrame) -> pd.DataFrame:
    """The vector behind each segment of a dialogue, and the dialogue's whole cost."""
    group = group.sort_values("seg", ignore_index=True)
    at, cost, behind = 0, 0, []
    for to, add in zip(group["to"][::-1], group["add"][::-1], strict=True):
        behind.append(at)
        at, cost = int(to[at]), cost + int(add[at])
    return pd.DataFrame({"conv_id": group["conv_id"], "seg": group["seg"], "behind": behind[::-1], "cost": cost + tables().vectors[at][START]})


def _exits(kind: pa.DataType):
    """``conv_id, seg, behind, cost, exits``: the state behind a segment by the state before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (conv, seg), rows in _grouped_rows(batches, 2):
                symbols, behind, cost = [r[1] for r in rows], rows[0][2], rows[0][3]
                yield conv, seg, behind, cost, [edits(symbols, q, behind, last=False)[2] for q in range(4)]
        yield from _tables_of(["conv_id", "seg", "behind", "cost", "exits"], [kind, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())], found(), 1000)
    return run


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    """The state before each segment, and whether it is the last."""
    group = group.sort_values("seg", ignore_index=True)
    state, entry = START, []
    for exits in group["exits"]:
        entry.append(state)
        state = int(exits[state])
    return group[["conv_id", "seg", "behind", "cost"]].assign(entry=entry, last=group["seg"] == group["seg"].max())


def _segments(kind: pa.DataType, as_turns: bool):
    """Segments, sorted, with what lies around them: a part of the dialogue's summary each, or their repaired turns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (conv, seg), rows in _grouped_rows(batches, 2):
                turns, faults, symbols = [(r[1], r[2]) for r in rows], [r[3] for r in rows], [r[4] for r in rows]
                behind, cost, entry, last = rows[0][5:9]
                audit, _, _ = edits(symbols, entry, behind, last)
                kept = list(applied(audit, turns, entry))
                if as_turns:
                    yield from ((conv, e, (seg << 32) + i, role, text) for i, (e, role, text) in enumerate(kept))
                    continue
                parts, size = [[]], 0  # of about _PART_CHARS characters
                for _, role, text in kept:
                    if size > _PART_CHARS:
                        parts.append([])
                        size = 0
                    parts[-1].append(f"{role}:{text}")
                    size += len(role) + len(text) + 2
                yield conv, seg, *_counts(turns, symbols, faults), turns[0][0][:1], turns[-1][0][:1], cost, audit, ["\n".join(p) for p in parts if p]
        if as_turns:
            yield from _tables_of(["conv_id", *(x.split()[0] for x in _TURNS.split(", "))], [kind, pa.string(), pa.int64(), pa.string(), pa.string()], found())
        else:
            yield from _tables_of(["conv_id", "seg", "blank", "duplicate", "truncated", "illegal", "first", "latest", "cost", "audit", "parts"],
                                  [kind, *[pa.int64()] * 5, pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.string())], found(), 8)
    return run


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    """A dialogue's summary from its segments' (their texts are elsewhere)."""
    group = group.sort_values("seg", ignore_index=True)
    across = sum(a + b not in ("su", "ua", "au") for a, b in zip(group["latest"][:-1], group["first"][1:], strict=True))
    sums = {c: int(group[c].sum()) for c in ("blank", "duplicate", "truncated", "illegal")}
    sums["illegal"] += across
    return pd.DataFrame([{"conv_id": group["conv_id"][0], **sums, "cost": int(group["cost"][0]), "audit": "".join(group["audit"])}])


def _hashes(kind: pa.DataType):
    """sha256 of each dialogue's parts as they come, sorted; no dialogue is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for conv, parts in groupby(rows, key=lambda row: row[0]):
                digest, some = hashlib.sha256(), False
                for part in parts:
                    if part[3] is not None:
                        digest.update((b"\n" if some else b"") + part[3].encode())
                        some = True
                yield conv, digest.hexdigest()
        yield from _tables_of(["conv_id", "repaired_sha256"], [kind, pa.string()], found())
    return run


def _rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, live: Column) -> DataFrame:
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), live.alias("live"))
    return rows.withColumn("tie", F.sha2(F.col("text").cast("binary"), 256))


def _long_dialogues(rows: DataFrame, segment: int, arrow: pa.DataType) -> tuple[DataFrame, DataFrame]:
    """(turns with symbols, segments with their surroundings) of dialogues beyond one segment."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    numbered = running_by(rows.filter("live").drop("live"), "conv_id", "turn", count="nth", tiebreak=["role", "tie"])
    numbered = stored(numbered.withColumn("seg", F.floor((F.col("nth") - 1) / segment)), "turns")
    first = numbered.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("tie").alias("t")).agg(F.min("nth").alias("first"))
    seen = numbered.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("tie") == F.col("t"))).drop("c", "r", "t")
    text = F.rtrim("text", F.lit(_SPACES))
    fault = F.when(text == "", 1).when(F.col("nth") > F.col("first"), 2).when(F.right(text, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3)
    initial = reduce(lambda c, x: c.when(F.left("role", F.lit(1)) == x[0], x[1]), INITIALS.items(), F.when(F.lit(False), 0)).otherwise(3)
    symbol = F.when(F.col("fault").isin(1, 2), GONE).otherwise(2 * F.col("initial") + (F.col("fault") == 3).cast("int"))
    turns = stored(seen.withColumns({"fault": fault, "initial": initial}).withColumn("symbol", symbol)
                   .select("conv_id", "seg", "nth", "turn", "role", "text", "fault", "symbol"), "symbols")

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "nth")

    key = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s"))
    named = lambda df: df.withColumnsRenamed({"conv_id": "c", "seg": "s"})
    narrow = turns.select("conv_id", "seg", "nth", "symbol")
    maps = in_order(narrow).mapInArrow(_maps(arrow), f"conv_id {kind}, seg long, to array<long>, add array<long>")
    rights = stored(maps.groupBy("conv_id").applyInPandas(_rights, f"conv_id {kind}, seg long, behind long, cost long"), "vectors")
    around = in_order(narrow.join(named(rights), key).select("conv_id", "seg", "nth", "symbol", "behind", "cost"))
    exits = around.mapInArrow(_exits(arrow), f"conv_id {kind}, seg long, behind long, cost long, exits array<long>")
    entries = stored(exits.groupBy("conv_id").applyInPandas(_entries, f"conv_id {kind}, seg long, behind long, cost long, entry long, last boolean"), "states")
    return turns, in_order(turns.join(named(entries), key).select("conv_id", "seg", "nth", "role", "text", "fault", "symbol", "behind", "cost", "entry", "last"))


def _repair(rows: DataFrame, segment: int, as_turns: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    kind, arrow = rows.schema["conv_id"].dataType.simpleString(), to_arrow_type(rows.schema["conv_id"].dataType)
    schema = f"conv_id {kind}, " + (_TURNS if as_turns else _SUMMARY)
    many = rows.filter("live").groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > segment).select(F.col("conv_id").alias("c"))
    many = stored(many, "long")
    is_long = F.col("conv_id").eqNullSafe(F.col("c"))
    some_long = bool(many.head(1))
    short = rows.join(many, is_long, "left_anti") if some_long else rows
    short = (short.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "tie")
             .select("conv_id", "turn", "role", "text", "live").mapInArrow(_dialogues(arrow, as_turns), schema))
    if not some_long:
        return short
    turns, around = _long_dialogues(rows.join(many, is_long, "left_semi"), segment, arrow)
    if as_turns:
        return short.unionByName(around.mapInArrow(_segments(arrow, True), schema))
    found = stored(around.mapInArrow(_segments(arrow, False), f"conv_id {kind}, seg long, blank long, duplicate long, truncated long, illegal long, first string, latest string, cost long, audit string, parts array<string>"), "segments")
    summed = found.drop("parts").groupBy("conv_id").applyInPandas(_summed, f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    # A hash takes its text in order: one stream a dialogue, read in parts and never held.
    parts = found.select("conv_id", "seg", F.posexplode_outer("parts").alias("part", "text")).repartition("conv_id").sortWithinPartitions("conv_id", "seg", "part")
    hashed = parts.mapInArrow(_hashes(arrow), f"conv_id {kind}, repaired_sha256 string").withColumnRenamed("conv_id", "h")
    apart = (turns.groupBy(F.col("conv_id").alias("g"))
             .agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")))
    whole = (summed.join(hashed, F.col("conv_id").eqNullSafe(F.col("h"))).join(apart, F.col("conv_id").eqNullSafe(F.col("g"))))
    return short.unionByName(whole.select(*short.columns))


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", *, live: Column | None = None, segment: int = 4096) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``, a row per dialogue.

    Turns stand by number (null first), then role, then the sha256 of the text.
    A null role or text is one space; null ids are one dialogue.  ``live`` is
    false for rows that only name their dialogue: one without turns has zeros,
    an empty audit and the empty text's hash.  Repeated rows are turns of their
    own (and duplicates).  No rows give no rows.  Other columns are ignored.
    An audit is one string, so a dialogue has at most 2**31 edits.
    """
    return _repair(_rows(conversations, conv_col, turn_col, role_col, text_col, F.lit(True) if live is None else live), segment, False)


def repaired_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", *, segment: int = 4096) -> DataFrame:
    """``conv_id, edit, position, role, text``: the turns of the repaired dialogues,
    kept, re-roled or inserted, in the order of ``position``; as :func:`repair`."""
    return _repair(_rows(conversations, conv_col, turn_col, role_col, text_col, F.lit(True)), segment, True)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, live``: rows with the faults that
    crc32(``conv_id:turn``) mod 20 gives them (a null in any column is one space
    there): 0 drops a row (``live`` is false), 1 empties its text, 2 takes
    ``.!?`` out of it, 3 repeats the row, 4 makes its role ``user``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fault.alias("fault"))
    rows = rows.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       F.when(F.col("fault").isin(0, 1), F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                       (F.col("fault") != 0).alias("live"), F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")


#: DuckDB SQL for the rows of ``repair(damaged(conversations))``: crc32 bit by
#: bit, the least (cost, edits) from every turn and state on, then the edits applied.
REPAIR_SQL = r"""
WITH RECURSIVE
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(k, ''), lambda z: [ord(z)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc % 2 = 1 THEN xor(acc >> 1, 3988292384::BIGINT) ELSE acc >> 1 END), 4294967295::BIGINT) % 20 AS f FROM c),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN f = 3 THEN [1, 2] ELSE [1] END) AS copy FROM h WHERE f <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM d),
e AS (SELECT *, min(i) OVER (PARTITION BY conv_id, role, text) AS seen, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM n),
r AS (SELECT *, CASE WHEN bare = '' THEN 1 WHEN i > seen THEN 2 WHEN right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS fault,
        prior || left(role, 1) AS pair FROM e),
y AS (SELECT *, CASE WHEN fault IN (1, 2) THEN 'x' ELSE left(role, 1) END AS s, CASE WHEN fault = 3 THEN 3 ELSE 0 END AS m FROM r),
dp AS (
  SELECT conv_id, max(i) + 1 AS i, {'c': 0, 'a': ''} AS v0, {'c': 6, 'a': 'II'} AS v1, {'c': 3, 'a': 'I'} AS v2, {'c': 0, 'a': ''} AS v3 FROM r GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, list_sort([b0, {'c': 3 + w2.c, 'a': 'I' || w2.a}])[1], list_sort([b1, {'c': 3 + w2.c, 'a': 'I' || w2.a}])[1], w2, list_sort([b3, {'c': 3 + b2.c, 'a': 'I' || b2.a}])[1]
  FROM (SELECT *, list_sort([b2, {'c': 3 + b3.c, 'a': 'I' || b3.a}])[1] AS w2 FROM (
    SELECT y.conv_id, y.i,
      list_sort([{'c': 4 + v0.c, 'a': 'D' || v0.a}, {'c': CASE WHEN s = 'x' THEN 999999 ELSE 3 + m + v2.c END, 'a': 'R' || v2.a},
        {'c': CASE WHEN s = 's' THEN m + v1.c ELSE 999999 END, 'a': 'K' || v1.a}, {'c': CASE WHEN s = 'u' THEN m + v2.c ELSE 999999 END, 'a': 'K' || v2.a}])[1] AS b0,
      list_sort([{'c': 4 + v1.c, 'a': 'D' || v1.a}, {'c': CASE WHEN s = 'x' THEN 999999 ELSE 3 + m + v2.c END, 'a': 'R' || v2.a}, {'c': CASE WHEN s = 'u' THEN m + v2.c ELSE 999999 END, 'a': 'K' || v2.a}])[1] AS b1,
      list_sort([{'c': 4 + v2.c, 'a': 'D' || v2.a}, {'c': CASE WHEN s = 'x' THEN 999999 ELSE 3 + m + v3.c END, 'a': 'R' || v3.a}, {'c': CASE WHEN s = 'a' THEN m + v3.c ELSE 999999 END, 'a': 'K' || v3.a}])[1] AS b2,
      list_sort([{'c': 4 + v3.c, 'a': 'D' || v3.a}, {'c': CASE WHEN s = 'x' THEN 999999 ELSE 3 + m + v2.c END, 'a': 'R' || v2.a}, {'c': CASE WHEN s = 'u' THEN m + v2.c ELSE 999999 END, 'a': 'K' || v2.a}])[1] AS b3
    FROM dp JOIN y ON y.conv_id IS NOT DISTINCT FROM dp.conv_id AND y.i = dp.i - 1))),
least_ AS (SELECT conv_id, v0.c AS cost, v0.a AS audit FROM dp WHERE i = 1),
ap AS (
  SELECT conv_id, audit, 1 AS p, 1::BIGINT AS i, 0 AS q, CAST([] AS VARCHAR[]) AS lines FROM least_
  UNION ALL
  SELECT ap.conv_id, audit, p + 1, CASE WHEN x = 'I' THEN ap.i ELSE ap.i + 1 END,
    CASE x WHEN 'D' THEN q WHEN 'K' THEN CASE left(y.role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE WHEN q = 2 THEN 3 ELSE 2 END END,
    CASE x WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, y.role || ':' || y.text)
      ELSE list_append(lines, CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END || CASE WHEN x = 'I' THEN '' ELSE y.text END) END
  FROM (SELECT *, audit[p] AS x FROM ap WHERE p <= length(audit)) ap LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM ap.conv_id AND y.i = ap.i),
fixed AS (SELECT conv_id, sha256(array_to_string(lines, chr(10))) AS hash FROM ap WHERE p = length(audit) + 1),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
  count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM y GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN least_ ON least_.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN fixed ON fixed.conv_id IS NOT DISTINCT FROM o.conv_id
"""
