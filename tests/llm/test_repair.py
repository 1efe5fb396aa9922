"""Conversation repair: block tables against plain dynamic programming, segments against whole dialogues."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from keyfold.llm import repair

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}


def by_force(symbols):
    """(cost, edits): the least over all edits, every turn and state."""
    after = None
    for i in range(len(symbols), -1, -1):
        ways = [[] for _ in range(4)]
        for q in range(4):
            if i == len(symbols):
                ways[q] = [(0, "")] if q in (0, 3) else [(10**9, "")]
                continue
            s = symbols[i]
            ways[q].append((4 + after[q][0], "D" + after[q][1]))
            if s != repair.GONE:
                more, kind = 3 * (s & 1), s >> 1
                ways[q].append((3 + more + after[NEXT[q]][0], "R" + after[NEXT[q]][1]))
                to = 1 if kind == 0 and q == 0 else 2 if kind == 1 and q != 2 else 3 if kind == 2 and q == 2 else None
                if to is not None:
                    ways[q].append((more + after[to][0], "K" + after[to][1]))
        here = [min(w) for w in ways]
        for _ in range(6):
            here = [min(h, (3 + here[NEXT[q]][0], "I" + here[NEXT[q]][1])) for q, h in enumerate(here)]
        after = here
    return after[0]


def test_edits_are_the_least():
    r = random.Random(5)
    for _ in range(4000):
        symbols = [r.randrange(repair.SYMBOLS) for _ in range(r.randint(0, 15))]
        audit, cost, state = repair.edits(symbols)
        assert (cost, audit) == by_force(symbols) and state in (repair.START, repair.ASSISTANT)


def test_block_tables_are_steps_in_a_row():
    t, r = repair.tables(), random.Random(2)
    assert len(t.vectors) < 100 and all(min(v) == 0 for v in t.vectors)
    for _ in range(500):
        at = r.randrange(len(t.vectors))
        block = [r.randrange(repair.SYMBOLS) for _ in range(repair.BLOCK)]
        code = 0
        for s in block:
            code = code * repair.SYMBOLS + s
        to, add = at, 0
        for s in reversed(block):
            to, more = t.step[to][s]
            add += more
        assert (t.block_to[at, code], t.block_add[at, code]) == (to, add)


def summaries(df, **options):
    return sorted(map(tuple, repair.repair(df, live=F.col("live") if "live" in df.columns else None, **options).collect()), key=str)


@pytest.fixture(scope="module")
def odd_rows(spark):
    r = random.Random(7)
    texts = ["Fine.", "cut off", " \t\n", "", None, "Why?  ", "twice.", "twice.", "a line\nmore!", "<|end|>"]
    rows = [(r.choice([1, 2, 3, None]), r.choice([*range(60), None, None]), r.choice(["user", "assistant", "system", None, "", "tool", "User", "sys"]), r.choice(texts), "extra", 0) for _ in range(400)]
    rows += [(9, 5, "user", "Same.", "x", 1)] * 12 + [(10, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.", "x", 1) for t in range(300)]
    rows += [(11, 0, "user", "z" * 200_000 + ".", "x", 1), (11, 1, "assistant", "y" * 300_000, "x", 1)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seg string, nth int").repartition(5)


def sql_rows(df):
    pdf = df.select("conv_id", "turn", "role", "text").toPandas()
    pdf = pdf.astype({"conv_id": "Int64", "turn": "Int64"})
    with duckdb.connect() as c:
        c.register("raw", pdf)
        c.execute("create view conversations as select conv_id, turn, role, text from raw")
        columns = [d[0] for d in c.execute(repair.REPAIR_SQL).description]
        return columns, sorted(c.execute(repair.REPAIR_SQL).fetchall(), key=str)


def test_damaged_rows_as_sql(odd_rows):
    columns, want = sql_rows(odd_rows)
    got = repair.repair(repair.damaged(odd_rows), live=F.col("live"))
    assert got.columns == columns and sorted(map(tuple, got.collect()), key=str) == want


@pytest.mark.parametrize("segment", [5, 64])
def test_segments_change_nothing(odd_rows, segment):
    rows = repair.damaged(odd_rows)
    assert summaries(rows, segment=segment) == summaries(rows)
    order = lambda df: [tuple(x)[:2] + tuple(x)[3:] for x in sorted(df.collect(), key=lambda x: (x.conv_id or -1, x.position))]
    assert order(repair.repaired_turns(odd_rows, segment=segment)) == order(repair.repaired_turns(odd_rows))


def test_repaired_turns_have_the_form(odd_rows):
    by = {}
    for x in repair.repaired_turns(odd_rows).collect():
        by.setdefault(x.conv_id, []).append(x)
    sums = {x.conv_id: x for x in repair.repair(odd_rows).collect()}
    for conv, turns in by.items():
        turns.sort(key=lambda x: x.position)
        assert [x.position for x in turns] == list(range(len(turns)))
        roles = "".join(x.role[0] for x in turns).removeprefix("s")
        assert roles == "ua" * (len(roles) // 2)
        assert all(x.text == "" and x.role in ("user", "assistant") for x in turns if x.edit == "I")
        text = "\n".join(f"{x.role}:{x.text}" for x in turns)
        assert hashlib.sha256(text.encode()).hexdigest() == sums[conv].repaired_sha256
        assert sums[conv].audit.replace("D", "") == "".join(x.edit for x in turns)


def test_dialogues_without_turns(spark):
    empty = hashlib.sha256(b"").hexdigest()
    rows = spark.createDataFrame([(1, 0, "user", "a.", False), (None, None, None, None, False), (2, None, None, None, True)], "conv_id long, turn long, role string, text string, live boolean")
    assert summaries(rows) == sorted([(1, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty), (2, 0, 1, 0, 0, 0, 4, "D", empty)], key=str)
    assert summaries(rows.limit(0)) == [] and repair.repaired_turns(rows.limit(0)).collect() == []
    assert repair.damaged(rows.drop("live").limit(0)).collect() == []


def test_damage_by_checksum(spark):
    import zlib
    rows = spark.createDataFrame([(c, t, "assistant", "One. Two? Three!") for c in range(8) for t in range(20)] + [(None, 3, None, None)], "conv_id long, turn long, role string, text string")
    got = {}
    for x in repair.damaged(rows).collect():
        got.setdefault((x.conv_id, x.turn), []).append((x.role, x.text, x.live))
    for (conv, turn), found in got.items():
        f = zlib.crc32(f"{' ' if conv is None else conv}:{turn}".encode()) % 20
        if conv is None:
            continue
        text = {0: "", 1: "", 2: "One Two Three"}.get(f, "One. Two? Three!")
        assert found == [("user" if f == 4 else "assistant", text, f != 0)] * (2 if f == 3 else 1)
    assert len(got) == 161
