"""Fill-in-middle: cuts by chunk summaries against plain regular expressions, exact round trips."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from keyfold.llm import infill
from keyfold.llm._words import text_bytes

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def by_force(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(m in text for m in infill.MARKS) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return doc_id, n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def odd_texts():
    r = random.Random(8)
    alphabet = "abXYZ é中\U0001F600.\n<>"
    texts = ["".join(r.choice(alphabet) if r.random() < .6 else "q" * r.randint(0, 40) for _ in range(r.choice([1, 3, 40, 3000]))) for _ in range(150)]
    return [*texts, "<", "<P", "a<P>b", "<S><M>", "<<S", "x" * 20_000, "é" * 9000, "\U0001F600" * 5000, "<S" * 300, "\x00\x01 b", None, ""]


def test_as_by_force(spark):
    rows = [(i if i % 11 else None, t) for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, form string").repartition(4)
    got = infill.fill_in_middle(docs).withColumn("back", infill.restored("output", "form")).collect()
    columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    assert sorted((tuple(x[c] for c in columns) for x in got), key=str) == sorted((by_force(i, t) for i, t in rows), key=str)
    assert sorted(x.back for x in got) == sorted(t or "" for _, t in rows)
    assert {x.form for x in got} == {"plain", "psm", "spm"}


def test_edges(spark, edge_docs, no_docs):
    got = infill.digests(edge_docs).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for x in edge_docs.select("doc_id", "text").collect():
        *rest, output = by_force(x.doc_id, x.text)
        want.append((*rest, sha(output), sha(x.text or "")))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert infill.digests(no_docs).collect() == []


def ends_of(texts):
    data, offsets = text_bytes(pa.array(texts))
    return data, offsets, infill.chunk_ends(data, offsets)


def test_chunks_depend_on_content_alone():
    r = random.Random(3)
    passage = "".join(r.choice("etaoin shrdlu,é") for _ in range(20_000))
    a, b = "One start. " * 31 + passage, passage[:0] + "Quite another beginning, " * 70 + passage + " and an end"
    data, offsets, ends = ends_of([a, b, "", passage])
    raw, begins = data.tobytes(), np.append(0, ends[:-1])
    parts = [{raw[i:j] for i, j in zip(begins, ends, strict=True) if lo <= i < hi} for lo, hi in zip(offsets[:-1], offsets[1:], strict=True)]
    assert len(parts[0] & parts[1]) > 20 and len(parts[0] & parts[3]) > 20 and not parts[2]
    alone = ends_of([b])
    assert [int(e) for e in alone[2]] == [int(e - offsets[1]) for e in ends if offsets[1] < e <= offsets[2]]
    sizes = np.diff(np.append(0, ends))
    assert sizes.max() <= infill.MOST
    for i, j in zip(begins, ends, strict=True):
        raw[i:j].decode()  # whole code points


def test_summaries_are_read_once_and_may_be_forgotten():
    text = "".join(random.Random(5).choice("some letters 123 ") for _ in range(30_000))
    data, offsets, ends = ends_of([text] * 6)
    raw, begins = data.tobytes(), np.append(0, ends[:-1])
    chunks = [raw[i:j] for i, j in zip(begins, ends, strict=True)]
    kept, small = infill.Summaries(), infill.Summaries(500)
    assert [kept.of(c) for c in chunks] == [small.of(c) for c in chunks] == [infill.summary(c) for c in chunks]
    assert kept.read == len(set(chunks)) <= len(chunks) // 5 and small.read > kept.read and small.held < 10_000


def test_restores_what_marks_surround(spark):
    rows = [("<P><S>bc<M>a<", "psm"), ("<S><<P><M>><M", "spm"), ("<S>left alone", "plain"), ("", "plain")]
    df = spark.createDataFrame(rows, "output string, form string").select(infill.restored(F.col("output"), F.col("form")).alias("t"))
    assert [x.t for x in df.collect()] == ["a<bc", "><M<", "<S>left alone", ""]
