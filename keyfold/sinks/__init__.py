"""Sinks: JDBC upsert (K1) and append (K2), Kafka lines (K3), parquet (K4),
and tables of files upserted by key (K5)."""

from keyfold.sinks.batches import read_upserted, upsert, upsert_sink  # noqa: F401
from keyfold.sinks.files import bucket_sink, read_buckets, upsert_buckets, write_parquet  # noqa: F401
from keyfold.sinks.jdbc import append_jdbc, merge_sql, upsert_jdbc  # noqa: F401
from keyfold.sinks.kafka import write_kafka_lines  # noqa: F401
