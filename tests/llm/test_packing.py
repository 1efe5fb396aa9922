"""Packing: the search against brute force, token ids against the tokenizer, whole results."""

import random
import zlib

import numpy as np
import pytest

from keyfold.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
TEXTS = ["", " \n\t", "Hello, World's it's 12345 don't", "É é ﬁ Straße ΣΑΣ x y", "a<|endoftext|>b <|STARTOFTEXT|>", "x" * 5000, "中文 日本語\U0001F600", "́lead ̣́mark", "plain words " * 3000,
         "l'été, «oui», (a)b ) c, d’accord; 3.14, A.B.C.'s it's,'s x,'t 're. é, ñ× ÷a ß.ﬀ, a\u0301, e.\u0301f \u0301, ǅ, —, a—, ('ll)'d 1,2;3\u00a0,4"]


def least_bins(sizes, capacity):
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for room in {b for b in bins if b + sizes[i] <= capacity}:
            k = bins.index(room)
            bins[k] += sizes[i]
            go(i + 1, bins)
            bins[k] -= sizes[i]
        go(i + 1, [*bins, sizes[i]])
    go(0, [])
    return best[0]


def checked(plan, counts, capacity):
    held = np.zeros(capacity + 1, int)
    for filling, times in plan:
        assert times > 0 and sum(s * n for s, n in filling) <= capacity
        for s, n in filling:
            held[s] += n * times
    assert (held == counts).all()
    return sum(t for _, t in plan)


def test_search_is_exact_on_small_cases():
    r, better = random.Random(1), 0
    for _ in range(200):
        capacity = r.choice([20, 50, 100])
        sizes = sorted((r.randint(r.choice([1, capacity // 6, capacity // 4]), r.choice([capacity // 2, capacity * 2 // 3])) for _ in range(r.randint(0, 12))), reverse=True)
        counts = np.bincount(sizes, minlength=capacity + 1)
        least = least_bins(sizes, capacity)
        assert packing.lower_bound(counts, capacity) <= least
        fit = checked(packing.best_fit(counts, capacity), counts, capacity)
        assert checked(packing.complete_bins(counts, capacity, nodes=100_000, looks=10**7), counts, capacity) == least
        better += fit > least
    assert better  # best-fit alone is not enough


def test_search_on_many_pieces():
    rng = np.random.default_rng(2)
    for low, high, n in ((1, 4097, 5000), (800, 2000, 20_000), (1366, 2049, 10**6), (4096, 4097, 7)):
        counts = np.bincount(rng.integers(low, high, n), minlength=4097) * 1000
        fit = checked(packing.best_fit(counts, 4096), counts, 4096)
        got = checked(packing.complete_bins(counts, 4096, nodes=20), counts, 4096)
        assert packing.lower_bound(counts, 4096) <= got <= fit
    with pytest.raises(ValueError):
        packing.complete_bins([1], 10)


def test_undominated_fillings():
    counts = np.bincount([9, 7, 5, 4, 3, 3], minlength=13)
    found = {tuple(s) for s, _ in packing.fillings(12, counts)}
    assert found == {(9, 3), (7, 5)}  # 9 takes the place of 5 and 4, 5 that of 4, and 3 still fits beside 9
    assert {tuple(s) for s, _ in packing.fillings(12, np.bincount([7, 6, 4, 3], minlength=13))} == {(7, 4)}  # 7 takes the place of 6


def brute(rows, capacity=4096):
    """Pieces of each text by the tokenizer itself."""
    t = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    out = []
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            piece = ids[k:k + capacity]
            out.append((i, k // capacity, k, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())))
    return sorted(out, key=str)


def laid_out(rows, capacity=4096):
    """Every sequence is filled without gaps; returns how many there are."""
    by = {}
    for x in rows:
        by.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_are_the_tokenizers(spark):
    rows = [*enumerate(TEXTS), (None, None), (3, TEXTS[3]), (3, "another")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, length int, nth int").repartition(3)
    got = packing.pack(docs).collect()
    assert sorted(((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got), key=str) == brute(rows)
    lengths = sorted((x.length for x in got), reverse=True)
    assert laid_out(got) == least_bins(lengths, 4096)


@pytest.mark.parametrize("capacity", [7, 100])
def test_sequences_hold_the_ids(spark, edge_docs, capacity):
    packed = packing.pack(edge_docs.filter("length(text) < 2000"), capacity=capacity, keep_ids=True, nodes=20)
    rows = {x.sequence_id: x for x in packing.sequences(packed).collect()}
    for x in packed.collect():
        s = rows[x.sequence_id]
        assert s.ids[x.offset:x.offset + x.length] == x.ids and x.offset in s.starts
    assert all(len(s.ids) <= capacity for s in rows.values())


def test_edges(spark, edge_docs, no_docs):
    got = packing.pack(edge_docs).collect()
    want = brute([(x.doc_id, x.text) for x in edge_docs.select("doc_id", "text").collect()])
    assert sorted(((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got), key=str) == want
    laid_out(got)
    assert packing.pack(no_docs).collect() == []


def test_same_result_for_any_partitions(spark, small_docs):
    rows = [sorted(map(tuple, packing.pack(small_docs.repartition(n)).collect())) for n in (1, 5)]
    assert rows[0] == rows[1]


def test_whole_table_is_packed_to_the_bound(small_docs):
    got = packing.pack(small_docs).collect()
    counts = np.bincount([x.length for x in got], minlength=4097)
    assert laid_out(got) <= packing.lower_bound(counts, 4096) + 1
    assert sorted((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == sorted(brute([(x.doc_id, x.text) for x in small_docs.collect()]))


def test_forgotten_words_are_learned_again():
    one, two = packing._Encoder(None), packing._Encoder(None, most=10)
    from keyfold.llm._words import text_bytes
    import pyarrow as pa
    for texts in (["alpha beta gamma"] * 3, ["beta delta " * 20], ["alpha epsilon", ""]):
        data, offsets = text_bytes(pa.array(texts))
        a, b = (e.encode(data, offsets, 1) for e in (one, two))
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
