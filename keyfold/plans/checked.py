"""A report, its rejected lines and why, from one pass over the lines.

The lines are parsed once: each row's needed fields and reasons are written,
good and bad rows apart, and counted while they pass (``Observation``).  The
report reads the good rows' narrow columns, the rejects the bad lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from keyfold.operators.parse import MISSING, UNREADABLE, with_reasons
from keyfold.plans.reports import REPORTS
from keyfold.session import ensure_checkpoint_dir, fresh_path


@dataclass(frozen=True)
class Checked:
    result: DataFrame              # the report over the good lines
    rejects: DataFrame             # value, reasons: the lines left out, as written
    lines: int                     # lines read, headers aside
    rejected: int                  # lines left out
    reasons: dict[str, int]        # lines by reason (a line may have several)


def checked_report(table: str, lines: DataFrame, path: str | None = None, **parse_opts) -> Checked:
    """Report ``table`` over the lines whose needed fields can be read.

    ``path`` is a new folder for the parsed rows (left out, one under the
    shared folder).  The counts are exact: a metric that a retried task reports
    again counts once.
    """
    report, spark = REPORTS[table], lines.sparkSession
    ensure_checkpoint_dir(spark)
    path = path or fresh_path(spark, "checked", table)
    needed = list(report.needed) or ["title"]
    rows = with_reasons(lines, report.kind, needed, **parse_opts)
    reasons = [f"{why}:{n}" for n in needed for why in (MISSING, UNREADABLE)]
    seen = Observation(f"{table}-lines")
    rows = rows.withColumn("bad", F.size("reasons") > 0).observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count_if("bad").alias("rejected"),
        *[F.count_if(F.array_contains("reasons", r)).alias(r) for r in reasons])
    rows.write.partitionBy("bad").parquet(path)
    counts = seen.get
    stored = spark.read.schema(rows.schema).parquet(path)
    return Checked(report.build(stored.filter("not bad").select(*needed)), stored.filter("bad").select("value", "reasons"),
                   counts["lines"], counts["rejected"], {r: counts[r] for r in reasons if counts[r]})
