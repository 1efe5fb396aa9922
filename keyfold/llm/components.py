"""Connected components of a table of links, by alternating star steps.

Every round replaces links by links to smaller ids (large star, then small
star) until nothing changes: O(log n) rounds in practice, long chains
included.  Only links are shuffled; nothing is collected but one row of
counts a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm._spark import stored


def _least(links: DataFrame) -> DataFrame:
    """Each link with the least id that its ``u`` is linked with.

    The least of a hub is combined before the shuffle, and a join, unlike a
    window, can have a hub's links split over several tasks.
    """
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    near = _least(links)  # here u > v always
    moved = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every id in a link between two different ids.

    ``component`` is the least id reachable.  Null ends and links of an id to
    itself say nothing and are ignored; repeated links count once; no links
    give no rows.
    """
    links = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct())
    links = stored(links, "links")
    state = None
    for _ in range(max_rounds):
        links = stored(_small_star(_large_star(links)), "links")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    found = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())
