"""Mixing sources to target weights by Sainte-Laguë apportionment.

Words are counted once; all words of a source lie in a line of shards, each a
line of equal blocks of words.  Highest quotients (target / (2 * seats + 1))
give every source an integer quota of blocks, and again every shard of a
source its part.  A shard takes all its blocks ``quota // blocks`` times, and
a run of the rest from a seeded block on; documents stand in a seeded order,
so a run is a random choice that leaves nearly all documents whole.

A source has as many shards as its words and rows need; they get their seats in
two steps, by groups of shards and within a group, so no task holds a source or
all its shards.  A row a source goes to the driver (checked against
``max_sources``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm._spark import stored

_SPACES = r"[\x20\x09-\x0D]+"
#: Shards that get their seats together.
GROUP = 1024


def targets(sizes: Sequence[int], weights: Sequence[float], limit: float = 3.0) -> np.ndarray:
    """Shares of all sizes by weight; none above ``limit`` times its size, the
    excess shared again by weight among the others."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), bool), sizes.sum()
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share > limit * sizes)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = limit * sizes[over]
        left -= out[over].sum()
        free &= ~over
    return out


def sainte_lague(votes: Sequence[float], seats: int, most: Sequence[int]) -> np.ndarray:
    """``seats`` by the highest quotients votes / (2 * seats so far + 1), none
    above ``most``; equal quotients go to the earlier entry."""
    votes, most = np.asarray(votes, float), np.asarray(most, np.int64)
    seats = int(min(seats, most[votes > 0].sum()))

    def at(divisor: float) -> np.ndarray:
        return np.minimum(np.floor(votes / divisor + 0.5).astype(np.int64), most)

    got = np.zeros(len(votes), np.int64)
    if seats <= 0:
        return got
    high = 4.0 * votes.max()  # no seats at all
    low = votes.max() / (2.0 * seats + 2)
    while at(low).sum() < seats:
        low /= 2
    for _ in range(200):  # the largest divisor that gives at least the seats
        mid = (low + high) / 2
        if at(mid).sum() >= seats:
            low = mid
        else:
            high = mid
    got = at(high)
    while got.sum() < seats:  # ties at the last divisor
        quotient = np.where(got < most, votes / (2 * got + 1), -1.0)
        got[int(np.argmax(quotient))] += 1
    return got


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: Sequence[float] = (1, 2, 3),
        limit: int = 3, seed: int = 7, shard_words: int = 500_000, shard_rows: int = 20_000, max_block: int = 1024,
        max_sources: int = 100_000, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, source_size, target, taken, passes, first, words``, a row per input row.

    ``taken`` = ``passes * size + words``: the document is taken whole
    ``passes`` times, and ``words`` words from word ``first`` on (0-based; on
    past the end from the start of the document) once more.  ``weights`` repeat
    over the sources by code point, null last.  A block is at most ``max_block``
    words and at most 1/256 of the smallest source that has words.

    Null and wordless texts have size 0 and nothing is taken of them; a source
    without words has target 0.  Repeated rows count and are taken as rows of
    their own.  Null ids are kept.  No rows give no rows.  ``keep`` names
    columns of ``docs`` to carry on; others are ignored.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                      F.size(F.array_remove(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _SPACES), "")).cast("long").alias("size"),
                      F.xxhash64(F.lit(seed), id_col, text_col).alias("order"), *[F.col(c).alias(f"kept_{c}") for c in keep])
    base = stored(own.select("doc_id", "source", "size", "order"), "sizes")

    sums = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")).limit(max_sources + 1).toPandas()
    if len(sums) > max_sources:
        raise ValueError(f"more than {max_sources} sources; group them first")
    named = sorted((x for x in sums["source"] if not pd.isna(x)))
    place = {x: i for i, x in enumerate(named)}
    sums["rank"] = [len(named) if pd.isna(x) else place[x] for x in sums["source"]]
    sums = sums.sort_values("rank", ignore_index=True)
    total = sums["source_size"].astype("int64").to_numpy()
    goal = targets(total, [weights[i % len(weights)] for i in range(len(sums))], limit)
    some = total[total > 0]
    block = int(max(1, min(max_block, some.min() // 256))) if len(some) else 1
    shards = np.maximum(-(-total // shard_words), -(-sums["rows"].astype("int64").to_numpy() // shard_rows))
    seats = int(round(goal.sum() / block))
    quota = sainte_lague(goal, seats, limit * (-(-total // block)))
    plan = pd.DataFrame({"rank": np.arange(len(sums)), "source": [None if pd.isna(x) else x for x in sums["source"]], "source_size": total,
                         "target": goal, "quota": quota, "shards": shards})
    schema = "rank long, source string, source_size long, target double, quota long, shards long"
    spark = docs.sparkSession
    # At most max_sources rows, as checked above.
    plan = F.broadcast(spark.createDataFrame(plan, schema) if len(plan) else spark.createDataFrame([], schema))

    def sharded(rows: DataFrame) -> DataFrame:
        return (rows.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
                .withColumn("shard", F.pmod(F.col("order"), F.col("shards"))))

    def deal(part: pd.DataFrame) -> pd.DataFrame:
        """The seats of ``quota`` by shard (or group of shards)."""
        part = part.sort_values("shard", ignore_index=True)
        got = sainte_lague(part["words"], int(part["quota"].iloc[0]), limit * part["blocks"])
        return part[["rank", "shard", "words", "blocks"]].assign(got=got)

    shape = "rank long, shard long, words long, blocks long, got long"
    sized = (sharded(base).groupBy("rank", "shard", "quota").agg(F.sum("size").alias("words"))
             .withColumn("blocks", F.ceil(F.col("words") / block).cast("long")).withColumn("group", F.floor(F.col("shard") / GROUP)))
    groups = sized.groupBy("rank", F.col("group").alias("shard"), "quota").agg(F.sum("words").alias("words"), F.sum("blocks").alias("blocks"))
    groups = stored(groups.groupBy("rank").applyInPandas(deal, shape), "groups").select("rank", F.col("shard").alias("group"), F.col("got").alias("quota"))
    dealt = stored(sized.drop("quota").join(groups, ["rank", "group"]).groupBy("rank", "group").applyInPandas(deal, shape), "shards")

    line = Window.partitionBy("rank", "shard").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    # Kept columns (texts, say) are read again rather than stored twice.
    placed = (sharded(own if keep else base).withColumn("start", F.coalesce(F.sum("size").over(line), F.lit(0)))
              .join(dealt, ["rank", "shard"]).withColumn("passes", F.when(F.col("blocks") > 0, F.floor(F.col("got") / F.col("blocks"))).otherwise(0).cast("long"))
              .withColumn("run", F.when(F.col("blocks") > 0, F.col("got") % F.col("blocks")).otherwise(0)))
    # The run: blocks first .. first + run - 1 round the shard's line, as up to two word ranges [a, b) and [0, c).
    first = F.when(F.col("blocks") > 0, F.pmod(F.xxhash64(F.lit(seed), "rank", "shard"), F.col("blocks"))).otherwise(0)
    placed = placed.withColumn("a", first * block).withColumn("past", F.greatest(first + F.col("run") - F.col("blocks"), F.lit(0)) * block)
    placed = placed.withColumn("b", F.least(F.col("a") + F.col("run") * block, "words"))
    stop = F.col("start") + F.col("size")
    placed = (placed.withColumn("one", F.greatest(F.lit(0), F.least(stop, F.col("b")) - F.greatest("start", "a")))
              .withColumn("two", F.greatest(F.lit(0), F.least(stop, F.col("past")) - F.col("start")))
              .withColumn("first", F.when(F.col("one") > 0, F.greatest("a", "start") - F.col("start")).otherwise(0)))
    extra = F.col("one") + F.col("two")
    return placed.select("doc_id", "size", "source_size", "target", (F.col("passes") * F.col("size") + extra).cast("long").alias("taken"),
                         "passes", F.col("first").cast("long").alias("first"), extra.cast("long").alias("words"),
                         *[F.col(f"kept_{c}").alias(c) for c in keep])
