"""keyfold: keyed rollups of delimited text, JDBC rows and event streams on Spark.

Every report is a ``DataFrame -> DataFrame`` function (``keyfold.plans``) built
from column functions (``keyfold.functions``) and keyed aggregations
(``keyfold.operators``); the same function serves batch reads
(``keyfold.sources``) and Structured Streaming (``keyfold.streaming``), and its
result is upserted by key into JDBC or file tables (``keyfold.sinks``).

Entry points: ``keyfold.plans.run_report`` (lines -> result table),
``keyfold.plans.running.running_report`` (per-row running form, on a stream
``running_report_sink``), ``keyfold.plans.reports.booking_reports`` (five
reports from one scan), ``keyfold.plans.checked.checked_report`` (a report, its
rejected lines and why), ``keyfold.streaming.run_report_stream`` (continuous
upsert), and the job runner ``python -m keyfold`` (report / running / bookings
/ generate / lines-to-kafka).
"""

__version__ = "0.1.0"
