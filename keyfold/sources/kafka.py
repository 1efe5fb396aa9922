"""S3: Kafka topic -> string lines (stream or batch).

Needs the Spark Kafka connector on the classpath (supplied at deployment;
not present in this test image, so only the option building is unit-tested).
The consumer group of the reference becomes the query's checkpoint location:
Spark tracks offsets there, and ``startingOffsets=earliest`` applies only when
the checkpoint is new, which is the reference's ``auto.offset.reset``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                         min_partitions: int | None = None, extra: dict | None = None) -> dict:
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def read_kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str,
                     stream: bool = True, **kw) -> DataFrame:
    """Topic values as a ``value`` string column (null keys are ignored)."""
    opts = kafka_source_options(bootstrap_servers, topic, **kw)
    reader = spark.readStream if stream else spark.read
    if not stream:
        opts.pop("failOnDataLoss", None)
        opts.setdefault("endingOffsets", "latest")
    return reader.format("kafka").options(**opts).load() \
        .select(F.col("value").cast("string").alias("value"))
