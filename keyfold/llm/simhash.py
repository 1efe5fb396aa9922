"""SimHash fingerprints and the search of all within a Hamming radius.

A text's terms are its distinct words as written; each votes with its length
(at most 16) for or against every one of the 64 bits of its md5.  Longer words
are rarer, so their votes tell texts apart without a pass over the corpus.

The votes are plain sums: a long holds the votes of two bits, 32 sums serve 64
bits, and they combine in the task that has the text.  DataFrame functions
only.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm._spark import stored

_SPACES = r"[\x20\x09-\x0D]+"
_TWO = (1 << 32) + 1
BITS = 64


def _terms(text: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(text, _SPACES), ""))


def fingerprints(texts: DataFrame, key: list[str], text_col: str = "text") -> DataFrame:
    """``*key, bits`` (a long) for each distinct ``key``; null and wordless
    texts have no votes and the fingerprint 0."""
    words = texts.select(*key, F.explode_outer(_terms(F.coalesce(F.col(text_col), F.lit("")))).alias("term"))
    hashed = words.select(*key, F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 16), 16, -10).cast("long").alias("h"),
                          F.least(F.char_length("term"), F.lit(16)).cast("long").alias("w"))
    votes = hashed.groupBy(*key).agg(F.sum("w").alias("all"), *[F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(_TWO)) * F.col("w")).alias(f"v{j}") for j in range(32)])
    bits = F.lit(0).cast("long")
    for j in range(32):
        low, high = F.col(f"v{j}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"v{j}", 32)
        bits = bits.bitwiseOR(F.when(2 * low > F.col("all"), F.lit(1 << j)).otherwise(F.lit(0).cast("long")))
        top = (1 << (j + 32)) - ((1 << 64) if j == 31 else 0)
        bits = bits.bitwiseOR(F.when(2 * high > F.col("all"), F.lit(top)).otherwise(F.lit(0).cast("long")))
    return votes.select(*key, bits.alias("bits"))


def as_text(bits: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """1 minus the share of bits that differ."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def within(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``query, bits, distance`` for all distinct ``bits`` of ``prints`` at most
    ``radius`` from each distinct ``bits`` of ``queries`` (itself included, if there).

    Of ``blocks`` blocks at least ``blocks - radius`` agree: for every choice
    of so many, a table is keyed by their bits.  More blocks make longer keys
    and more tables; 6 blocks give 32-bit keys at radius 3.
    """
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in itertools.combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    tables = F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("t", "mask")

    def keyed(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.col("bits").alias(name)).distinct().select(name, tables).select(name, F.xxhash64("t", F.col(name).bitwiseAND(F.col("mask"))).alias("key"))

    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("bits")))
    return (keyed(queries, "query").join(keyed(prints, "bits"), "key").withColumn("distance", distance)
            .filter(F.col("distance") <= radius).select("query", "bits", "distance").distinct())


def _followers(ids: DataFrame) -> DataFrame:
    """``k, n, next_k`` of rows ``doc_id, k, n``: the next by id, after the last the first.

    Ids are range-partitioned; a partition's last row finds the next
    partition's first, of which the driver sees one row a partition.
    """
    spark = ids.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(ids.repartitionByRange(parts, "doc_id", "k").withColumn("part", F.spark_partition_id()), "ids")
    firsts = ranged.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "k"))["k"].alias("first")).orderBy("part").collect()
    after = [(firsts[i].part, firsts[(i + 1) % len(firsts)].first) for i in range(len(firsts))]
    ends = F.broadcast(spark.createDataFrame(after, "part int, after string"))
    line = Window.partitionBy("part").orderBy("doc_id", "k")
    return (ranged.withColumn("lead", F.lead("k").over(line)).join(ends, "part")
            .select("k", "n", F.coalesce("lead", "after").alias("next_k")))


def document_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_within, next_id``, a row per distinct (id, text).

    A null text is the empty one.  Rows that repeat an id and its text give one
    row; different texts of an id stand next to each other in a fixed order; a
    null id comes first.  A single document is followed by itself.
    ``n_within``: documents within ``radius`` of those whose id is divisible by
    100 (itself left out), -1 for others.  Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.xxhash64(text)).alias("k"), text.alias("text"))
    order = _followers(base.select("doc_id", "k", F.char_length("text").cast("long").alias("n")).distinct())
    order = stored(order, "order")
    quarter = F.floor(F.col("n") / 4).cast("int")
    # Both joins need the same columns of base, so they share its one exchange.
    heads = (base.join(order.select(F.col("next_k").alias("k"), F.col("k").alias("for_k"), quarter.alias("q")), "k")
             .select(F.col("for_k").alias("k"), F.col("doc_id").alias("next_id"), F.left("text", F.col("q")).alias("head")))
    both = (base.join(order, "k").join(heads, "k")
            .withColumn("edited", F.concat(F.left("text", (F.col("n") - quarter).cast("int")), F.col("head"))))
    rows = both.select("k", "doc_id", "n", "next_k", "next_id", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("x"))
    rows = rows.select("k", "doc_id", "n", "next_k", "next_id", "edited_sha256", "x.which", F.col("x.t").alias("text"))
    own = ["k", "doc_id", "n", "next_k", "next_id", "edited_sha256"]
    prints = (fingerprints(rows, [*own, "which"]).groupBy(*own)
              .agg(F.max(F.when(F.col("which") == 0, F.col("bits"))).alias("bits"), F.max(F.when(F.col("which") == 1, F.col("bits"))).alias("edited_bits")))
    prints = stored(prints, "prints")
    found = within(prints.filter("doc_id % 100 = 0"), prints, radius)
    many = prints.groupBy("bits").agg(F.count("*").alias("docs"))
    counted = found.join(many, "bits").groupBy("query").agg((F.sum("docs") - 1).alias("near"))
    out = prints.join(prints.select(F.col("k").alias("next_k"), F.col("bits").alias("next_bits")), "next_k")
    out = out.join(counted.withColumnRenamed("query", "bits"), "bits", "left")
    return out.select("doc_id", F.col("n").alias("n_chars"), "edited_sha256", as_text(F.col("bits")).alias("fingerprint"), as_text(F.col("edited_bits")).alias("edited_fingerprint"),
                      likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"), likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
                      F.coalesce(F.when(F.expr("doc_id % 100 = 0"), F.col("near")), F.lit(-1)).cast("long").alias("n_within"), "next_id")


#: DuckDB SQL for the same rows.
PRINTS_SQL = r"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
line AS (
  SELECT doc_id, text, n, coalesce(lead(text) OVER w, first_value(text) OVER (ORDER BY doc_id)) AS next_text,
         coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id
  FROM base WINDOW w AS (ORDER BY doc_id)),
both_texts AS (SELECT doc_id, n, next_id, text, left(text, n - n // 4) || left(next_text, n // 4) AS edited FROM line),
terms AS (
  SELECT doc_id, which, term, least(length(term), 16) AS w, CAST('0x' || left(md5(term), 16) AS UBIGINT) AS h
  FROM (SELECT DISTINCT doc_id, which, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS term
        FROM (SELECT doc_id, 0 AS which, text AS t FROM both_texts UNION ALL SELECT doc_id, 1, edited FROM both_texts))),
votes AS (
  SELECT doc_id, which, j, CAST(2 * sum(CASE WHEN (h >> j) & 1 = 1 THEN w ELSE 0 END) > sum(w) AS UBIGINT) AS bit
  FROM terms, (SELECT CAST(unnest(range(64)) AS UBIGINT) AS j) GROUP BY 1, 2, 3),
found AS (SELECT doc_id, which, bit_or(bit << j) AS bits FROM votes GROUP BY 1, 2),
prints AS (
  SELECT b.*, coalesce(f.bits, 0::UBIGINT) AS bits, coalesce(e.bits, 0::UBIGINT) AS edited_bits
  FROM both_texts b LEFT JOIN found f ON f.doc_id = b.doc_id AND f.which = 0 LEFT JOIN found e ON e.doc_id = b.doc_id AND e.which = 1),
near AS (
  SELECT q.doc_id, count(*) - 1 AS near FROM prints q JOIN prints p ON bit_count(xor(q.bits, p.bits)) <= 3 WHERE q.doc_id % 100 = 0 GROUP BY 1)
SELECT p.doc_id, CAST(p.n AS BIGINT) AS n_chars, sha256(p.edited) AS edited_sha256, lpad(lower(to_hex(p.bits)), 16, '0') AS fingerprint,
       lpad(lower(to_hex(p.edited_bits)), 16, '0') AS edited_fingerprint,
       1 - bit_count(xor(p.bits, p.edited_bits)) / 64.0::DOUBLE AS near_edited, 1 - bit_count(xor(p.bits, x.bits)) / 64.0::DOUBLE AS near_next,
       CAST(coalesce(near.near, -1) AS BIGINT) AS n_within, p.next_id
FROM prints p JOIN prints x ON x.doc_id = p.next_id LEFT JOIN near ON near.doc_id = p.doc_id
"""
