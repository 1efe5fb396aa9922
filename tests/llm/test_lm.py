"""The language model's vocabulary, blocks and shards; its words against a discounted unigram."""

import math
import re
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark import SparkConf

from keyfold.llm import lm

SPACE = re.compile("[^\x20\x09-\x0d]+")


def test_buckets_rise_with_counts():
    counts = np.unique(np.concatenate([np.arange(1, 5000), 2 ** np.arange(3, 50), 2 ** np.arange(3, 50) - 1, 2 ** np.arange(3, 50) + 1]))
    b = lm.bucket(counts)
    assert (np.diff(b) >= 0).all() and (b[counts < 64] == counts[counts < 64]).all() and b.max() < 1100
    for x in np.unique(b):
        own = counts[b == x]
        assert own.max() <= own.min() * 17 / 16 + 1


def test_classes_hold_all_words_up_to_a_bound():
    rng = np.random.default_rng(1)
    c = np.sort((rng.pareto(1.0, 20_000) * 5 + 5).astype(np.int64))
    h = rng.integers(0, 1 << 63, len(c), dtype=np.uint64)
    b = lm.bucket(c)
    words, tokens = ({int(k): int(v) for k, v in zip(np.unique(b), np.bincount(b, w)[np.unique(b)], strict=True)} for w in (None, c))
    whole = lm.Classes.planned(words, tokens, int(c.sum()), 10**9, block_words=1000)
    assert whole.lowest == b.min()
    cls = whole.of(h, c)
    assert (np.diff(whole.block) >= 0).all() and cls.max() < len(whole.block) and np.bincount(whole.block[cls]).max() < 2500
    for k in np.unique(cls):
        assert len(np.unique(b[cls == k])) == 1  # a class is of about one frequency
    part = lm.Classes.planned(words, tokens, int(c.sum()), 5000)
    assert (b >= part.lowest).sum() <= 5000 < (b >= part.lowest).sum() + words[int(b[b < part.lowest].max())]
    assert lm.Classes.planned({}, {}, 0, 10).lowest > 0


def by_id(rows):
    return sorted(((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, x.base_score, x.score) for x in rows), key=str)


def test_scores_do_not_depend_on_partitions(small_docs, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 20_000)
    runs = []
    for n in (1, 7):
        docs = small_docs.repartition(n)
        held_out = lm.crc_mod("doc_id", 7) == 2
        rows = lm.score(docs, ~held_out, shard_bytes=100_000).collect()
        runs.append(sorted((x.doc_id, x.score, x.base_score) for x in rows))
    assert [x[0] for x in runs[0]] == [x[0] for x in runs[1]]
    assert max(abs(a[1] - b[1]) for a, b in zip(*runs, strict=True)) < 1e-6


def test_more_words_than_may_have_vectors(small_docs):
    held_out = lm.crc_mod("doc_id", 7) == 2
    few = lm.score(small_docs, ~held_out, most_words=50).collect()
    assert len(few) == small_docs.count() and all(x.score < 0 and math.isfinite(x.score) for x in few)


@pytest.mark.parametrize("sf", ["0.01"])
def test_beats_a_discounted_unigram_on_known_words(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    texts = [(x.doc_id, [w.translate({c: c + 32 for c in range(65, 91)}) for w in SPACE.findall(x.text or "")] + [0]) for x in docs.select("doc_id", "text").collect()]
    count = Counter(w for i, t in texts if not held(i) for w in t)
    total, once, twice = sum(count.values()), sum(c == 1 for c in count.values()), sum(c == 2 for c in count.values())
    discount = min(0.9, max(0.1, once / (once + 2 * twice)))
    # As the operator treats words below its floor: discounted, unseen ones share the discounts.
    rest, types = sum(c for c in count.values() if c < 5), sum(c < 5 for c in count.values())
    share = lambda w: (count[w] if count[w] >= 5 else rest * (count[w] - discount) / rest if count[w] else rest * discount * types / rest) / total
    got = {x.doc_id: x.score for x in lm.lm_scores(docs).filter("held_out").collect()}
    unigram = {i: sum(math.log10(share(w)) for w in t) for i, t in texts if held(i)}
    tokens = sum(len(t) for i, t in texts if held(i))
    assert set(got) == set(unigram)
    gain = (sum(got.values()) - sum(unigram.values())) / tokens
    assert gain > 0.05, gain


def test_a_learning_worker_holds_one_copy_beside_the_blocks(monkeypatch):
    words, d, rng = 200_000, 16, np.random.default_rng(2)
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    held = lambda x: SimpleNamespace(value=x)
    n = 1 << 15
    vocabulary = lm.Shared({(lm.VOCABULARY, i): held(np.stack([np.arange(lo, min(lo + n, words)) // 100, rng.integers(0, 1 << 62, min(n, words - lo)), np.full(min(n, words - lo), 9)]).tobytes())
                            for i, lo in enumerate(range(0, words, n))})
    none = pa.record_batch([pa.array([-1], pa.int32())] * 3, names=["two", "one", "w"])
    rows = [x.to_pylist()[0] for x in lm._first(vocabulary, 100.0, d, 1000, 1)(iter([none]))]
    model = lm.Shared({(x["part"], x["block"]): held(x["data"]) for x in rows})
    batch = pa.record_batch([pa.array([1, 2]), pa.array(["one two one", "three"]), pa.array([True, True])], names=["doc_id", "text", "train"])
    chunks = list(lm._chunks(iter([batch])))
    tracemalloc.start()
    assert sum(x.num_rows for x in lm._learner(vocabulary, 100.0, model, d, 100.0, 1)(iter(chunks))) == 2 * len(vocabulary.blocks) + 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 350 * words, peak / words


def test_numbers_packed_in_16_bits():
    values = np.array([0, 1, 65534, 65535, 65536, 1 << 40, 7])
    assert (lm._unpacked(lm._packed(values)) == values).all() and len(lm._unpacked(lm._packed(values[:0]))) == 0


def test_equal_numbers_are_added_up():
    rng = np.random.default_rng(3)
    for most in (3, 50, 100_000, 10_000_000):
        index, values = rng.integers(0, most, 500), rng.random((500, 4))
        at, sums = lm._grouped(index, values)
        assert at.tolist() == sorted(set(index.tolist())) and np.allclose(sums, [values[index == i].sum(0) for i in at])


def test_broadcasts_are_read_anew_and_not_kept(spark):
    shared = lm.Shared().add(spark, spark.createDataFrame([(i, lm.VOCABULARY, bytes([i]) * 5) for i in range(3)], lm._BLOCKS))

    def run(batches):
        list(batches)
        found = b"".join(shared.arrays(lm.VOCABULARY))
        yield pa.record_batch([pa.array([found]), pa.array([sum(hasattr(x, "_value") for x in shared.blocks.values())])], names=["found", "kept"])

    rows = spark.range(0, 2, 1, 1).mapInArrow(run, "found binary, kept long").collect()
    assert [(bytes(x.found), x.kept) for x in rows] == [(bytes([0] * 5 + [1] * 5 + [2] * 5), 0)]


@pytest.mark.parametrize("part, shape", [(lm.WORDS, (10, 5)), (lm.TARGETS, (10, 6)), (lm.REST, (1, 23))])
def test_changes_are_averaged_by_pieces(part, shape):
    rng = np.random.default_rng(5)
    was = rng.random(shape, np.float32)
    changes = [rng.integers(-4, 5, shape).astype(np.float32) * (rng.random((shape[0], 1)) < 0.5) for _ in range(7)]
    block = -1 if part == lm.REST else 0
    shared = lm.Shared({(part, block): SimpleNamespace(value=was.tobytes())})
    width = shape[1] if part == lm.REST else shape[1] - 1
    count = np.maximum(1, [7] if part == lm.REST else sum(x[:, :width].any(1).astype(int) for x in changes))[:, None]
    expected = was.copy()
    expected[:, :width] += sum(x[:, :width] for x in changes) / count
    for pieces in (1, 3):
        sent = [row for i in rng.permutation(7) for row in lm._change_rows(block, part, int(i), changes[i][:, :width], pieces)]
        done = [lm._averaged(shared, 4, pieces)(pa.Table.from_batches([x for x in sent if x.column("piece")[0].as_py() == p])) for p in rng.permutation(pieces)]
        whole = lm._whole(pa.concat_tables(done))
        assert np.allclose(np.frombuffer(whole.column("data")[0].as_py(), np.float32).reshape(shape), expected, atol=1e-6)


def test_a_task_with_a_large_model_takes_more_cores():
    conf = lambda **x: SparkConf(loadDefaults=False).setAll([("spark." + k.replace("_", "."), v) for k, v in x.items()])
    tool = conf(master="local-cluster[3,2,3000]", executor_memory="1800m")
    assert [lm.cores_a_task(tool, n) for n in (0, 100_000, 731_000, 8_000_000)] == [1, 1, 2, 2]
    assert lm.cores_a_task(conf(master="yarn", executor_memory="16g", executor_cores="8"), 731_000) == 1
    assert lm.cores_a_task(conf(master="yarn", executor_memory="16g", executor_cores="8"), 8_000_000) > 3
    assert lm.cores_a_task(conf(master="local[4]", executor_memory="1g"), 8_000_000) == 1


def test_settings_are_restored(spark, small_docs):
    before = {key: spark.conf.get(key, None) for key in lm.TIDY | lm.FEW}
    lm.lm_scores(small_docs.limit(20)).count()
    assert {key: spark.conf.get(key, None) for key in before} == before


def test_files_of_broadcast_blocks_go(spark):
    rows = lm.stored(spark.createDataFrame([(i, lm.WORDS, bytes([i])) for i in range(3)], lm._BLOCKS), "model", 1)
    folder = rows.inputFiles()[0].rpartition("/")[0]
    assert lm.fs.exists(spark, folder)
    shared = lm.Shared().taken(spark, rows)
    assert {key: x.value for key, x in shared.blocks.items()} == {(lm.WORDS, i): bytes([i]) for i in range(3)}
    assert not lm.fs.exists(spark, folder)


def held(x):
    return SimpleNamespace(value=x)


def vocabulary_of(words, n=1 << 13):
    """Blocks of a vocabulary of words that are 9 times there each, and its word numbers by hash."""
    h = np.random.default_rng(2).integers(0, 1 << 62, words)
    blocks = [np.stack([np.arange(lo, hi) // 100, h[lo:hi], np.full(hi - lo, 9)]) for lo in range(0, words, n) for hi in [min(lo + n, words)]]
    rows = pa.record_batch([pa.array(range(len(blocks))), pa.array([x.tobytes() for x in blocks])], names=["block", "data"])
    sent = pa.Table.from_batches(lm._by_hash({i: i * n for i in range(len(blocks))}, 4)(iter([rows])))
    lookup = [lm._lookup_row(sent.filter(pa.compute.equal(sent["r"], r))).to_pylist()[0] for r in sent["r"].unique()]
    return lm.Shared({(lm.VOCABULARY, i): held(x.tobytes()) for i, x in enumerate(blocks)} | {(x["part"], x["block"]): held(x["data"]) for x in lookup}), h.view(np.uint64)


def test_words_are_found_by_ranges_of_hashes():
    shared, h = vocabulary_of(20_000)
    v = lm.Vocabulary(shared, 100.0)
    asked = np.concatenate([h[::-7], h[:5] + np.uint64(1), h[:3], np.array([0, 2**64 - 1], np.uint64)])
    expected = [*range(19_999, -1, -7), *[20_000] * 5, 0, 1, 2, 20_000, 20_000]
    assert len(v.lookup) > 1 and v.ids_of(asked).tolist() == expected and v.ids_of(asked[:0]).tolist() == []
    assert v.times_of(np.array([20_000, 3, 3])).tolist() == [100.5, 9.5, 9.5]
    whole = lm.Vocabulary(lm.Shared({key: x for key, x in shared.blocks.items() if key[0] != lm.LOOKUP}), 100.0)
    assert whole.ids_of(asked).tolist() == expected
    sums = np.add.reduceat(np.append(np.full(20_000, 9.5), 100.5), v.bounds[:-1])
    assert v.bounds.tolist() == [*range(0, 20_001, 100), 20_001] and v.mass.tolist() == sums.tolist()


def test_a_learning_worker_holds_the_rows_of_its_shard_only(monkeypatch):
    words, d = 300_000, 16
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    vocabulary, _ = vocabulary_of(words)
    none = pa.record_batch([pa.array([-1], pa.int32())] * 3, names=["two", "one", "w"])
    batch = pa.record_batch([pa.array([1, 2]), pa.array(["one two one", "three"]), pa.array([True, True])], names=["doc_id", "text", "train"])
    chunks = list(lm._chunks(iter([batch])))
    model = {}

    def begin():
        for x in lm._first(vocabulary, 100.0, d, 1000, 1)(iter([none])):
            row = x.to_pylist()[0]
            model[row["part"], row["block"]] = held(row["data"])

    def learn():
        assert sum(x.num_rows for x in lm._learner(vocabulary, 100.0, lm.Shared(model), d, 100.0, 1)(iter(chunks))) == len(model)

    for run, kept in ((begin, 140), (learn, 0)):  # bytes a word: what the test itself keeps
        tracemalloc.start()
        run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < (kept + 60) * words, (run.__name__, peak / words)


def test_contexts_of_many_words_are_told_apart():
    k, rng = 70_000, np.random.default_rng(4)  # k * k has more than 32 bits
    model = lm.LogBilinear.start(rng.pareto(1.0, k) * 5, 4, 1)
    model.words[:] *= 5
    grams = tuple(rng.integers(0, k, 3000, np.int32) for _ in range(3))
    two, one, w = grams
    q = np.append(model.words[two] @ model.places[0] + model.words[one] @ model.places[1], np.ones((3000, 1)), 1)
    expected = np.zeros(3000)
    c = np.searchsorted(model.bounds, w, "right") - 1
    g = np.searchsorted(model.over, c, "right") - 1
    for i in range(3000):
        for table, lo, hi, chosen in ((model.groups, 0, len(model.groups), g[i]), (model.classes, *model.over[g[i]:g[i] + 2], c[i]), (model.targets, *model.bounds[c[i]:c[i] + 2], w[i])):
            z = table[lo:hi].astype(float) @ q[i]
            expected[i] += z[chosen - lo] - np.log(np.exp(z).sum())
    assert abs(model.log_probability(grams) - expected / math.log(10)).max() < 1e-4


def test_products_beyond_the_range_of_a_float():
    model = lm.LogBilinear.start(np.full(50, 9.0), 4, 1)
    model.targets[:, -1] += 200.0
    model.targets[7, -1] += 300.0
    whole = 10.0 ** model.log_probabilities().astype(float)
    assert abs(whole.sum(2) - 1).max() < 1e-4


def test_workers_map_broadcasts(spark):
    shared = lm.Shared().add(spark, spark.createDataFrame([(0, lm.WORDS, b"x" * 100_000), (1, lm.WORDS, b"y" * 300), (2, lm.WORDS, b"z" * 9)], lm._BLOCKS))

    def run(batches):
        list(batches)
        for x in shared.arrays(lm.WORDS):
            yield pa.record_batch([pa.array([bytes(x)]), pa.array([type(x).__name__])], names=["data", "kind"])

    rows = spark.range(0, 1, 1, 1).mapInArrow(run, "data binary, kind string").collect()
    assert [(bytes(x.data), x.kind) for x in rows] == [(b"x" * 100_000, "memoryview"), (b"y" * 300, "memoryview"), (b"z" * 9, "memoryview")]


def test_tasks_of_the_model_take_one_core(small_docs, monkeypatch):
    kind, profiles = type(small_docs), []
    was = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, schema, *a, **b: profiles.append(b.get("profile")) or was(self, f, schema, *a, **b))
    monkeypatch.setattr(lm, "cores_a_task", lambda conf, words: 2)  # however many words there are
    assert lm.lm_scores(small_docs).count() == small_docs.count()
    assert len(profiles) > 5 and set(profiles) == {None}


def test_sums_of_some_shards_changes_are_kept(small_docs, monkeypatch):
    held_out, names = lm.crc_mod("doc_id", 7) == 2, []
    was = lm.stored
    monkeypatch.setattr(lm, "stored", lambda df, name, *a, **b: names.append(name) or was(df, name, *a, **b))
    monkeypatch.setattr(lm, "SHARDS_A_BLOCK", 3)  # several pieces
    runs = []
    for some in (96, 2):
        monkeypatch.setattr(lm, "SHARDS_AT_ONCE", some)
        runs.append(sorted((x.doc_id, x.score) for x in lm.score(small_docs, ~held_out, shard_bytes=60_000).collect()))
    assert names.count("changes") >= 2 and runs[0] == runs[1]
