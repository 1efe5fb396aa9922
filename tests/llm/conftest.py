import random

import pytest

#: Extra columns whose names the operators use themselves.
CLASHING = ["version", "term", "k", "n", "size", "order", "words", "d", "v", "id", "rows", "any", "node", "rep", "label", "train", "chunk", "bits", "rank", "shard", "phrase"]
WORDS = [a + b for a in ("ba", "ke", "ti", "mo", "lu", "sa") for b in ("ra", "nel", "so", "vik", "um", "a")]


def sentence(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) for _ in range(n))


def edge_rows():
    """Null, empty, blank, short, very long, repeated and unnamed documents."""
    r = random.Random(4)
    long = sentence(r, 40_000)
    base = sentence(r, 120)
    near = base.replace(base.split()[60], "changed", 1)
    return [(1, base), (2, near), (3, base.upper()), (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, "One two"), (9, "x" * 300_000), (10, long), (11, long + " end"),
            (12, sentence(r, 50)), (12, sentence(r, 60)), (13, base), (13, base), (None, base), (None, None), (14, "é 中文 \U0001F600 ß"), (15, "1234 !!! |||")]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t), *["clash"] * len(CLASHING)) for k, (i, t) in enumerate(edge_rows())]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def small_docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
