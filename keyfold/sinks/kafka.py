"""K3: write lines to a Kafka topic with a null key (distributed: each task
produces its own partition of the lines).  Needs the Spark Kafka connector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_sink_options(bootstrap_servers: str, topic: str, extra: dict | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def write_kafka_lines(lines: DataFrame, bootstrap_servers: str, topic: str, col: str = "value",
                      **kw) -> None:
    (lines.select(F.col(col).cast("string").alias("value"))
     .write.format("kafka").options(**kafka_sink_options(bootstrap_servers, topic, **kw)).save())
