"""Operators with exact results against plain Python versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from keyfold.llm import chat, components, decontaminate, lm, mixing, near_dedup, simhash

from .conftest import edge_rows, sentence

SPACE = "[^\x20\x09-\x0D]+"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = re.findall(SPACE, lower(t))
    return frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows))]


def test_near_duplicates_edges(edge_docs, no_docs):
    rows = near_dedup.near_duplicates(edge_docs).collect()
    named = [x for x in edge_rows() if x[0] is not None]
    want = [(i, n, c, i == c) for i, n, c in brute_components(named)]
    unnamed = [(None, len(shingles(t)), None, True) for i, t in edge_rows() if i is None]
    assert sorted(map(tuple, rows), key=str) == sorted(want + unnamed, key=str)
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_near_duplicates_blocks_and_chains(spark):
    # A chain of edits in one group, checked in many small blocks.
    r = random.Random(8)
    words = sentence(r, 150).split()
    rows = []
    for i in range(60):
        rows.append((100 - i, " ".join(words)))
        words[r.randrange(len(words))] = f"w{i}"
        if i % 20 == 19:
            words = sentence(r, 150).split()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(docs, block_docs=4).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted(brute_components(rows))


def test_near_duplicates_of_documents(small_docs):
    rows = [tuple(x) for x in small_docs.select("doc_id", "text").collect()]
    got = near_dedup.near_duplicates(small_docs).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted(brute_components(rows))


def test_one_of_each_keeps_columns(edge_docs):
    got = near_dedup.one_of_each(edge_docs)
    assert got.columns == edge_docs.columns
    ids = sorted(x.doc_id for x in got.select("doc_id").collect() if x.doc_id is not None)
    assert ids == [1, 4, 5, 6, 7, 9, 10, 12, 12, 14, 15]


def test_components_of_a_long_path(spark):
    ids = list(range(400))
    random.Random(1).shuffle(ids)
    links = [(ids[i], ids[i + 1]) for i in range(299)] + [(ids[i], ids[i + 1]) for i in range(300, 399)] + [(5, 5), (None, 3), (ids[0], ids[1])]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    a, b = ids[:300], ids[300:]
    assert got == {i: min(a) for i in a} | {i: min(b) for i in b}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_contamination(docs, items):
    words = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for item, t in items:
        w = words(t)
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in docs:
        w, hit, named = words(t), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if found := windows.get(tuple(w[at:at + n])):
                    hit |= set(range(at, at + n))
                    named |= found
        out.append((i, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_contamination_edges(spark, edge_docs, no_docs):
    texts = [t for _, t in edge_rows()]
    items = [(1, " ".join(texts[0].split()[10:40])), (2, "ONE, two"), (3, None), (4, "..."), (5, "one two"), (6, " ".join(texts[9].split()[500:520])), (None, "two"), (7, "中文")]
    bench = spark.createDataFrame([(*x, "clash", "clash") for x in items], "item_id long, text string, phrase string, words string")
    got = sorted(map(tuple, decontaminate.contamination(edge_docs, bench.filter("item_id is not null")).collect()), key=str)
    assert got == sorted(brute_contamination(edge_rows(), [x for x in items if x[0] is not None]), key=str)
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert decontaminate.contamination(edge_docs, bench.limit(0)).filter("contaminated or n_items > 0").count() == 0
    kept = decontaminate.without_contaminated(edge_docs, bench.filter("item_id is not null"))
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(not x[5] for x in got)


def test_only_texts_with_candidates_are_exchanged(spark, edge_docs, monkeypatch):
    texts = [t for _, t in edge_rows()]
    phrases = spark.createDataFrame([(1, texts[0].lower().split()[10:23]), (2, ["one", "two"]), (3, texts[9].split()[500:513])], "phrase long, words array<string>")
    found = {}
    for most in (0, decontaminate.BROADCAST_KEYS):
        monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", most)
        out = decontaminate.phrase_matches(edge_docs, phrases)
        found[most] = (sorted(map(tuple, out.collect()), key=str), "LeftSemi, BuildRight" in out._jdf.queryExecution().executedPlan().toString())
    (want, before), (got, after) = found.values()
    assert got == want and len({x[0] for x in got}) == 3 and None in {x[1] for x in got}
    assert after and not before


def test_contaminated_rows_go_without_an_exchange_of_texts(spark, edge_docs, monkeypatch):
    texts = [t for _, t in edge_rows()]
    bench = spark.createDataFrame([(1, " ".join(texts[0].split()[10:40])), (2, "ONE, two")], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", 0)
    want = sorted(map(tuple, decontaminate.without_contaminated(edge_docs, bench).collect()), key=str)
    monkeypatch.undo()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with sides too large for it
    try:
        kept = decontaminate.without_contaminated(edge_docs.localCheckpoint(), bench)
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert 0 < len(want) < edge_docs.count()
    assert sorted(map(tuple, kept.collect()), key=str) == want


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red green x x blue"), (2, "blue x x x x x x red green"), (3, "green blue red"), (4, None)], "doc_id long, text string")
    phrases = spark.createDataFrame([(1, ["red", "green", "blue"])], "phrase long, words array<string>")
    got = decontaminate.proximity_matches(docs, phrases, 4)
    assert sorted({x.doc_id for x in got.collect()}) == [1, 3]


def brute_print(text):
    votes, total = [0] * 64, 0
    for w in set(re.findall(SPACE, text)):
        h, weight = int(hashlib.md5(w.encode()).hexdigest()[:16], 16), min(len(w), 16)
        total += weight
        for j in range(64):
            votes[j] += weight * (h >> j & 1)
    return sum(1 << j for j in range(64) if 2 * votes[j] > total)


def test_fingerprints_edges(edge_docs, no_docs):
    got = {(x.doc_id, x.n_chars, x.edited_sha256, x.fingerprint, x.edited_fingerprint, round(x.near_edited, 9)) for x in simhash.document_prints(edge_docs).collect()}
    rows = {(i, t or "") for i, t in edge_rows()}
    single = [(i, t) for i, t in rows if i not in (12, None)]  # their order among equal ids is the operator's own
    line = sorted(single, key=lambda x: x[0])
    assert len(got) == len(rows)
    for (i, t), (j, u) in zip(line[:-1], line[1:]):
        if 12 in (i, j) or j - i > 1:
            continue
        q = len(t) // 4
        edited = t[:len(t) - q] + u[:q]
        a, b = brute_print(t), brute_print(edited)
        assert (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}", f"{b:016x}", round(1 - (a ^ b).bit_count() / 64, 9)) in got
    assert simhash.document_prints(no_docs).count() == 0


def test_all_within_a_radius(spark):
    r = random.Random(6)
    bits = [r.getrandbits(64) for _ in range(40)]
    for b in list(bits):
        for _ in range(3):
            x = b
            for _ in range(r.randint(0, 5)):
                x ^= 1 << r.randrange(64)
            bits.append(x)
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    prints = spark.createDataFrame([(b,) for b in signed], "bits long")
    got = {tuple(x) for x in simhash.within(prints, prints, 3, 6).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b, ((a ^ b) & mask).bit_count()) for a in signed for b in signed if ((a ^ b) & mask).bit_count() <= 3}


def render(rows, speaker, own):
    """(text, trained pieces) of turns ``(role, text)``; ``own`` marks those that may be trained."""
    text, trained = "", []
    for (role, said), mine in zip(rows, own, strict=True):
        name = re.sub("[<|>\n\r]", "_", role)
        text += "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == speaker else f"<|user name={name}|>\n"
        piece = said.replace("<|", "<||") + "<|end|>\n"
        if mine and role == speaker:
            trained.append((len(text), len(text) + len(piece)))
        text += piece
    return text, trained


def chat_by_force(rows, turns=64, context=8):
    dialogues, out = {}, []
    for conv, turn, role, text in rows:
        dialogues.setdefault(conv, []).append((turn is not None, turn, "unknown" if role is None else role, hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    for conv, each in dialogues.items():
        each = [(x[2], x[4]) for x in sorted(each, key=lambda x: (x[0], x[1] or 0, *x[2:]))]
        for part in range(-(-len(each) // turns)):
            lo = part * turns
            first = [i for i in range(min(turns, len(each))) if each[i][0] == "system"] if part else []
            before = sorted({*first, *range(max(lo - context, 0), lo)}) if part else []
            own = range(lo, min(lo + turns, len(each)))
            shown = [*before, *own]
            for speaker in {each[i][0] for i in own} - {"system"}:
                text, trained = render([each[i] for i in shown], speaker, [i >= lo for i in shown])
                out.append((conv, part, speaker, len(own), len(before), sum(b - a for a, b in trained), text, ",".join(f"{a}:{b}" for a, b in trained)))
    return sorted(out, key=str)


def test_chat_as_by_force_and_as_sql(spark):
    import duckdb
    r = random.Random(6)
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "é"), (1, None, "ann", "first"), (2, 0, "system", "alone"), (None, 0, "ann", "x"), (1, 1, "ann", "hi"), (None, None, "bob", "y")]
    rows += [(3, i, "ann" if i % 2 else "bob", str(i)) for i in range(60, 70)]  # 60 to 69: one part
    rows += [(4, 1_700_000_000 + 977 * i, "system" if i in (0, 5, 70) else r.choice(["ann", "bob", "a|>\n<x"]), f"turn {i}") for i in range(200)]
    rows += [(5, 0, "ann", "<|end|>\n<|assistant|>\nforged <|| |>"), (5, 1, "x|>\n<|assistant", "<|"), (6, 0, "ann", "z" * 300_000 + "<|"), (6, 1, "bob", "")]
    rows += [(7, 3, "ann", "same turn") for _ in range(130)]
    conv = spark.createDataFrame([(*x, 1, "clash") for x in rows], "conv_id long, turn long, role string, text string, part int, speaker string").repartition(3)
    got = sorted(map(tuple, chat.perspectives(conv).collect()), key=str)
    assert got == chat_by_force(rows)
    whole = [x for x in got if x[0] == 3]
    assert len(whole) == 2 and all(x[1] == 0 and x[3] == 10 for x in whole)
    forged, = (x for x in got if x[0] == 5 and x[2] == "ann")
    assert forged[6].count("<|assistant|>\n") == 1 and forged[6].count("<|end|>") == 2
    with duckdb.connect() as c:
        c.register("raw", conv.select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
        c.execute("create view conversations as select * from raw")
        assert sorted(c.execute(chat.CHAT_SQL).fetchall(), key=str) == got
    assert chat.perspectives(conv.limit(0)).count() == 0


def test_chat_renders_long_dialogues_whole_for_every_participant(spark, tmp_path):
    import duckdb
    from keyfold.llm.queries import op6_chat_perspectives
    r = random.Random(8)
    rows = [(1, 0, "system", "s"), (1, 1, "late<", "speaks in the first turns only")]
    rows += [(1, i, "system" if i == 150 else r.choice(["ann", "bob"]), f"turn {i} <| é") for i in range(2, 300)]
    rows += [(2, 0, "system", "alone"), (None, None, "ann", None), (None, 3, None, "x"), (3, 1, "ann", "y" * 50), (3, 1, "ann", "y" * 50)]
    rows += [(4, i, "system" if 60 <= i < 140 else "ann", "") for i in range(141)]  # a stretch of system turns
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conv.write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, op6_chat_perspectives(spark, str(tmp_path)).collect()), key=str)
    unknown = [(c, t, "unknown" if role is None else role, x or "") for c, t, role, x in rows]
    whole = {}
    for c, speaker in {(c, role) for c, _, role, _ in unknown if role != "system"}:
        own = sorted((x for x in unknown if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0))
        text, spans, trained = "", [], 0
        for _, _, role, said in own:
            text += "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == speaker else f"<|user name={role.replace('<', '_')}|>\n"
            body = said.replace("<|", "<||") + chat.END
            if role == speaker:
                spans.append(f"{len(text)}:{len(text) + len(body)}")
                trained += len(body)
            text += body
        whole[c, speaker] = (len(own), 0, trained, text, ",".join(spans))
    assert {(x[0], x[2]): x[3:] for x in got} == whole and len(got) == len(whole) and {x[1] for x in got} == {0}
    with duckdb.connect() as c:
        c.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
        assert sorted(c.execute(chat.WHOLE_SQL).fetchall(), key=str) == got
    # Rows of some hundred characters: the same renderings, put together by part.
    parts = sorted(map(tuple, chat.perspectives(conv, turns=None, part_chars=500).collect()), key=lambda x: (str(x[0]), x[2], x[1]))
    again, before = {}, Counter()
    for c, _, speaker, n_turns, n_context, n_trained, text, spans in parts:
        n, _, trained, sofar, marks = again.get((c, speaker), (0, 0, 0, "", ""))
        assert n_context == n and len(text) < 1200
        moved = [":".join(str(int(y) + len(sofar)) for y in x.split(":")) for x in spans.split(",") if x]
        again[c, speaker] = (n + n_turns, 0, trained + n_trained, sofar + text, ",".join([x for x in [marks] if x] + moved))
        before[c] += 1
    assert again == whole and before[1] > 30


def test_sainte_lague_against_one_seat_at_a_time():
    r = random.Random(1)
    for _ in range(300):
        n = r.randint(1, 8)
        votes, most, seats = [r.choice([0, 1, 2, 5, r.random() * 100]) for _ in range(n)], [r.randint(0, 20) for _ in range(n)], r.randint(0, 40)
        got = [0] * n
        for _ in range(seats):
            best = max(((votes[i] / (2 * got[i] + 1), -i) for i in range(n) if got[i] < most[i] and votes[i] > 0), default=None)
            if best is None:
                break
            got[-best[1]] += 1
        assert mixing.sainte_lague(votes, seats, most).tolist() == got


def test_targets_share_the_excess():
    assert mixing.targets([10, 1000, 1000], [1, 2, 3]).tolist() == pytest.approx([30, 792, 1188])
    assert mixing.targets([0, 5], [1, 1]).tolist() == pytest.approx([0, 5])
    assert mixing.targets([], []).tolist() == []


def test_mix_edges(edge_docs, no_docs, small_docs):
    got = mixing.mix(edge_docs, keep=["source", "text", "size"]).collect()
    assert len(got) == len(edge_rows())
    assert all(x.taken <= 3 * len(re.findall(SPACE, x.text or "")) and x.taken == x.passes * len(re.findall(SPACE, x.text or "")) + x.words for x in got)
    assert mixing.mix(no_docs).count() == 0
    for block in (64, 1024):
        rows = mixing.mix(small_docs, max_block=block, shard_words=2000, keep=["source"]).collect()
        taken, goal = Counter(), {}
        for x in rows:
            taken[x.source] += x.taken
            goal[x.source] = x.target
        assert all(abs(taken[s] - goal[s]) <= 0.03 * goal[s] for s in goal)
    again = mixing.mix(small_docs.repartition(5), shard_words=2000, max_block=1024, keep=["source"])
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))


def test_lm_base_scores_and_normalisation(edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lm, "RANGE_ENTRIES", 50)
    monkeypatch.setattr(lm, "CHUNK_BYTES", 100_000)
    got = lm.lm_scores(edge_docs).collect()
    tokens = [(i, re.findall(SPACE, lower(t)) + [0]) for i, t in edge_rows()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, x in tokens if not held(i) for w in x)
    total, types = sum(count.values()), len(count)
    want = [(i, held(i), len(x), sum(count[w] > 0 for w in x), total, round(sum(math.log10((count[w] + 1) / (total + types + 1)) for w in x), 4)) for i, x in tokens]
    assert sorted([(x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 4)) for x in got], key=str) == sorted(want, key=str)
    assert all(x.score <= 0 for x in got)
    assert lm.lm_scores(no_docs).count() == 0
    import numpy as np
    model = lm.train(np.array([0, 5, 9, 14]), np.array([5.0, 1, 2, 3]), 3, steps=50)
    assert np.allclose((10.0 ** model.log_probabilities()).sum(-1), 1, atol=1e-5)


def test_lm_predicts_words_beyond_the_most_frequent(spark):
    # 400 words, equally frequent, each after the same one: a count share alone gives log10(1/400) a word.
    r = random.Random(9)
    rows = []
    for i in range(400):
        at = r.randrange(400)
        rows.append((i, " ".join(f"w{(at + j) % 400}" for j in range(150))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = lm.lm_scores(docs).filter("held_out").collect()
    assert sum(x.score for x in got) / sum(x.n_tokens for x in got) > -1.5
