"""From raw documents to a training mix, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keyfold.llm import decontaminate, mixing, near_dedup, pii, toxicity
from keyfold.llm._spark import stored, table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject."""
    return toxicity.without_toxic(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def near_dedup_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, 0.8 or
    more alike; a pair of just that is missed with a chance of at most 5e-5."""
    return near_dedup.one_of_each(docs, percent=80, sketches=15)


def decontamination_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages don't contaminate."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs, pii.fit(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, all columns, with how much of each:
    ``passes`` times the whole text and ``words`` words more from word ``first``
    on.  A document column named like one of the mix's becomes ``doc_<name>``."""
    own = {"size", "source_size", "target", "taken", "passes", "first", "words"}
    docs = docs.withColumnsRenamed({c: f"doc_{c}" for c in docs.columns if c in own})
    return mixing.mix(docs, keep=[c for c in docs.columns if c != "doc_id"]).filter("taken > 0")


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup_filter),
    ("decontamination", decontamination_filter),
    ("pii", pii_redaction),
    ("mixing", source_mix),
]

#: Model fitting and seeded choices can't be stated in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again.

    Null, empty, long and repeated texts, null ids, further columns and an empty
    table go through with the results that the stages' operators state.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
