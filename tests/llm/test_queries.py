"""Registered queries against their SQL, and the pipeline stage by stage."""

import re
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from keyfold.llm import decontaminate, near_dedup, pii, toxicity
from keyfold.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    got = QUERIES[name](spark, SF)
    with duckdb.connect() as c:
        for t in ("documents", "benchmark", "conversations"):
            c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        want = c.execute(ORACLE_SQL[name])
        columns = [d[0] for d in want.description]
        assert sorted(got.columns) == sorted(columns)
        assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))


def test_queries_without_sql_are_these():
    assert set(QUERIES) - set(ORACLE_SQL) == {"op1_toxicity", "op4_quality", "op5_mixing", "op7_lm_scores", "op9_language", "op10_pii", "op11_best_fit_packing"}
    assert corpus_pipeline.ORACLE_SQL is None
    assert {"pipeline", *QUERIES} <= set(__spark_entry__.queries())


def kept_by_force(docs, percent):
    """Ids of the least document of each group, every pair of shingle sets compared."""
    sets = {}
    for row in docs.select("doc_id", "text").collect():
        words = (row.text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall("[^\x20\x09-\x0d]+", words)
        sets[row.doc_id] = {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((root(a), root(b)))
            least[b] = a
    return sorted(i for i in sets if root(i) == i)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: sorted(x.doc_id for x in df.select("doc_id").collect())
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "near_dedup", "decontamination", "pii", "mixing"]
    one = steps["toxicity"](spark, docs, SF)
    assert ids(one) == ids(toxicity.toxicity(docs, labels).filter("predicted = 0"))
    two = steps["near_dedup"](spark, docs, SF)
    assert ids(two) == ids(near_dedup.near_duplicates(docs, percent=80, sketches=15).filter("kept")) == kept_by_force(docs, 80)
    three = steps["decontamination"](spark, docs, SF)
    assert ids(three) == ids(decontaminate.contamination(docs, bench).filter("not contaminated"))
    four = steps["pii"](spark, docs, SF)
    assert ids(four) == ids(docs) and all(not pii.base_spans(x.text) for x in four.collect())
    assert all(df.schema == docs.schema for df in (one, two, three, four))
    five = steps["mixing"](spark, docs, SF)
    assert five.filter("taken <= 0").count() == 0


def test_pipeline_stages_on_edge_rows(spark, edge_docs, no_docs):
    from tests.llm.conftest import edge_rows
    names = ["_near_id", "_near_rows", "_near_any", "_bad_id", "_bad_version", "taken", "passes"]
    odd = edge_docs.select("*", *[F.lit("clash").alias(c) for c in names])
    stages = dict(corpus_pipeline.STAGES)
    for docs in (odd, no_docs):
        for name, stage in stages.items():
            got = stage(spark, docs, SF)
            rows = got.collect()
            if docs is no_docs:
                assert rows == []
            if name != "mixing":
                assert got.schema == docs.schema
            elif docs is odd:
                assert {"text", "lang", "source", "n_chars", "doc_taken", "doc_size", "version"} <= set(got.columns)
                assert {x.doc_passes for x in rows} <= {"clash"} and all(x.taken > 0 for x in rows)
    ids = lambda df: [x.doc_id for x in df.collect()]
    kept = ids(stages["near_dedup"](spark, odd, SF))
    assert len(kept) == len(edge_rows()) - 6 and not {2, 3, 8, 11, 13} & set(kept)  # near, upper-case and repeated copies
    assert len(ids(stages["pii"](spark, odd, SF))) == len(edge_rows())


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_near_dedup_from_four_fifths(spark):
    # 200 different words give 196 shingles; a change in the middle takes 5 of them, one at an end 1.
    words = [f"w{i}" for i in range(200)]

    def text(changed):
        return " ".join("x" + w if i in changed else w for i, w in enumerate(words))

    def alike(a, b):
        sets = [{tuple(t.split()[j:j + 5]) for j in range(196)} for t in (a, b)]
        return len(sets[0] & sets[1]) / len(sets[0] | sets[1])

    base, near, far = text(()), text((30, 70, 110, 150)), text((20, 50, 80, 110, 140))
    assert 0.80 <= alike(base, near) < 0.85 and alike(base, far) < 0.80 and alike(near, far) < 0.80
    docs = spark.createDataFrame([(1, base), (2, near), (3, far)], "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF)
    assert sorted(x.doc_id for x in kept.collect()) == [1, 3]
    assert near_dedup.near_duplicates(docs).filter("kept").count() == 3
