"""Trained operators: edge rows, and held-out labels or brute force where there are some."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyfold.llm import lang_id, pii, quality, toxicity
from keyfold.llm._spark import bounded_sample, crc_mod

from .conftest import edge_rows, sentence

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def held_out_accuracy(scored, labels, label):
    rows = scored.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return sum(x.predicted == x[label] for x in rows) / len(rows)


@pytest.mark.parametrize(("run", "label"), [(toxicity.toxicity, "toxic"), (quality.quality, "quality")])
def test_classifiers(docs, labels, edge_docs, no_docs, run, label):
    assert held_out_accuracy(run(docs, labels), labels, label) > 0.93
    odd = labels.selectExpr("doc_id", "quality", "toxic", "'clash' as text", "'clash' as label").limit(5)
    rows = run(edge_docs, odd).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= x.score <= 1 for x in rows)
    assert run(no_docs, labels).count() == 0
    assert run(edge_docs, labels.limit(0)).count() == len(edge_rows())


def test_toxic_filter_keeps_columns_and_passages(docs, labels):
    model = toxicity.trained(docs, labels)
    scored = {x.doc_id: x.predicted for x in toxicity.score(docs, model).collect()}
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {x.doc_id for x in kept.select("doc_id").collect()} == {i for i, p in scored.items() if not p}
    texts = {x.doc_id: x.text for x in docs.collect()}
    for x in toxicity.toxic_passages(docs, model).limit(20).collect():
        assert texts[x.doc_id].encode()[x.first:x.end].decode() == x.passage


def test_maximal_segments_against_brute_force():
    r = random.Random(3)
    for _ in range(200):
        n = r.randint(1, 40)
        scores = [r.choice([2.0317, 0.4173, 0.1139]) if r.random() < 0.3 else -toxicity.BETA for _ in range(n)]
        sums = np.concatenate([[0], np.cumsum(scores)])
        # the definition, recursively: the best run, then left and right of it
        want = []

        def split(a, b):
            best = max(((sums[j] - sums[i], -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
            if best and best[0] > 1e-12:
                want.append(round(best[0], 6))
                split(a, best[2])
                split(best[3], b)

        split(0, n)
        at = [i for i in range(n) if scores[i] > 0]
        got = sorted(round(x, 6) for _, _, x in toxicity.segments(at, [scores[i] for i in at], n))
        assert sum(got) == pytest.approx(sum(want)) and max(got, default=0) == pytest.approx(max(want, default=0))


def test_forest_learns_and_ignores_constant_statistics():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    x[:, 2] = 7
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    forest = quality.grow(x, y)
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.97
    assert quality.grow(x, np.ones(2000)).probability(x[:3]).min() > 0.9
    assert quality.grow(x[:0], y[:0]).probability(x[:1])[0] == 0.5


def test_language(docs, edge_docs, no_docs):
    rows = lang_id.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(x.lang == x.lang_pred for x in rows) / len(rows) > 0.97
    got = lang_id.languages(edge_docs).collect()
    by = {x.doc_id: x for x in got}
    assert len(got) == len(edge_rows()) and all(by[i].lang_pred == "und" for i in (4, 5, 6, 15)) and by[14].lang_pred == "en"
    assert lang_id.languages(no_docs).count() == 0


def test_rare_languages_are_learned(spark):
    r = random.Random(4)
    letters = {"aa": "abcde", "bb": "fghij", "rare": "uvwxyz"}
    word = lambda lang: "".join(r.choice(letters[lang]) for _ in range(6))
    rows = [(i, " ".join(word(lang) for _ in range(30)), lang) for i in range(10_000) for lang in ["rare" if i in (4000, 8000) else r.choice(["aa", "bb"])]]
    rows += [(10_001, "abc " * 2_000_000, "aa"), (10_002, None, "rare"), (10_003, "x", None)]  # a text larger than its share of the sample
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.fit(docs, F.lit(True), max_rows=300, max_bytes=600_000)
    assert model.languages == ["aa", "bb", "rare"]
    asked = spark.createDataFrame([(k, " ".join(word(lang) for _ in range(20))) for k, lang in enumerate(letters)], "doc_id long, text string")
    assert [x.lang_pred for x in sorted(lang_id.predict(asked, model).collect(), key=lambda x: x.doc_id)] == list(letters)


def test_bounded_samples_are_whole_texts(spark):
    rows = [(f"text {i} " * 10, "ab"[i % 50 == 0]) for i in range(5000)]
    df = spark.createDataFrame(rows, "text string, kind string")
    got = bounded_sample(df, ["text"], 200, 10**6, by="kind").collect()
    assert {x.text for x in got} <= {t for t, _ in rows} and sum(x.kind == "b" for x in got) > 60 and 150 < len(got) < 300
    assert sum(len(x.text) for x in bounded_sample(df, ["text"], 10**6, 30_000).collect()) < 40_000
    assert bounded_sample(df, ["text"], 10**6, 10**9, by="kind").count() == 5000 and bounded_sample(df.limit(0), ["text"], 5, 5).count() == 0


def slow_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]


def test_base_spans(docs):
    r = random.Random(2)
    for _ in range(20_000):
        t = "".join(r.choice("a@.@1223 -+(é5") for _ in range(r.randint(0, 40)))
        assert sorted(pii.base_spans(t)) == sorted(slow_spans(t))
    for x in docs.collect():
        assert sorted(pii.base_spans(x.text)) == sorted(slow_spans(x.text))


def test_tagger_gradients():
    rng = np.random.default_rng(0)
    model = pii.Tagger.start(rng, 4, 3)
    for f in ("embed", "w", "u", "b", "out", "bias", "trans"):
        setattr(model, f, getattr(model, f).astype(float))
    x, y = rng.integers(0, 60, (2, 7)), np.zeros((2, 7), int)
    y[0, 2], y[0, 3] = 1, 2
    _, grads = pii._gradients(model, x, y)
    for p, g in zip(model.parameters(), grads, strict=True):
        i = (x[0, 2], 1) if p is model.embed else tuple(rng.integers(0, s) for s in p.shape)
        old, ends = p[i], []
        for step in (1e-4, -1e-4):
            p[i] = old + step
            ends.append(pii._gradients(model, x, y)[0])
        p[i] = old
        assert (ends[0] - ends[1]) / 2e-4 == pytest.approx(g[i], abs=1e-3)


def test_long_addresses_lie_whole_in_a_window():
    class All:  # tags all of a window that isn't filler
        def decode(self, xs):
            tags = np.zeros(xs.shape, int)
            for row, x in zip(tags, xs, strict=True):
                at = np.flatnonzero(x > 1)
                if len(at):
                    row[at[0]:at[-1] + 1] = 2
                    row[at[0]] = 1
            return tags

    address = "firstname.lastname (at) department.university (dot) edu"
    for span in (address, "a" * (80 - len(address)) + address):
        for offset in range(200):
            text = "\u201c" * offset + span + "\u201c" * 200
            assert pii.model_spans(All(), [text], [[]]) == [[(0, offset, offset + len(span))]]


def test_pii_finds_and_redacts(spark, docs, edge_docs, no_docs):
    model = pii.fit(docs)
    r = random.Random(5)
    text = f"{sentence(r, 30)} write to john.doe (at) mail.example.com or +1 (415) 555-2671 {sentence(r, 30)} call (415) 555-2671 now, card 4111111111111111. {sentence(r, 30)}"
    rows = spark.createDataFrame([(1, text, "clash"), (2, None, None), (3, "", None), (4, "9" * 100_000, None), (4, "a" * 100_000 + "@", None)], "doc_id long, text string, spans string")
    got = {(x.doc_id, x.n_card, x.n_phone, x.n_added): x.spans for x in pii.find(rows, model).collect()}
    assert len(got) == 4
    (key, spans), = ((k, s) for k, s in got.items() if k[0] == 1)
    assert key[1:3] == (1, 1)
    found = {text[int(a):int(b)] for _, a, b in (s.split(":") for s in spans.split(","))}
    assert {"+1 (415) 555-2671", "4111111111111111"} <= found
    # What the patterns can't find, the model does: a spelled-out address, a number without its country.
    assert {"john.doe (at) mail.example.com", "(415) 555-2671"} <= found and key[3] >= 2
    hidden = pii.redact(rows, model)
    assert hidden.columns == rows.columns
    out = {x.doc_id: x.text for x in hidden.collect()}
    assert "[CARD]" in out[1] and "[PHONE]" in out[1] and "4111" not in out[1] and out[2] is None and out[3] == ""
    assert pii.find(edge_docs, model).count() == len(edge_rows()) == pii.redact(edge_docs, model).count()
    assert pii.find(no_docs, pii.fit(no_docs)).count() == 0


def test_remainders_follow_the_text_of_the_id(spark):
    import zlib
    got = spark.createDataFrame([(i,) for i in (0, 7, 12345, -3, None)], "doc_id long").select("doc_id", crc_mod("doc_id", 5).alias("m")).collect()
    assert all(x.m == (-1 if x.doc_id is None else zlib.crc32(str(x.doc_id).encode()) % 5) for x in got)
