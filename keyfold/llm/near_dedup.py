"""MinHash near-duplicates with tensored banding, verified on full sets.

Tensored banding: two small collections of ``m`` sketches, each of ``h``
minhashes, give ``m * m`` table keys by combining sketch ``i`` of the first
with sketch ``j`` of the second; 2*m*h minhashes serve where separate keys of
as many rows take 2*m*m*h.  A pair of similarity J shares a table unless one
collection has no equal sketch: it is missed with a chance of at most
2 * (1 - J**h) ** m, which is 6e-5 at J = 0.85 for the defaults.

Steps (ids and sketches move, texts only where a table key was shared):

1. sketch every whole text; equal shingle sets become one class,
2. combine the sketches that class representatives share into table keys;
   those in a table join one candidate cluster (no pairs are emitted),
3. texts of clustered representatives go to tasks by (cluster, size class,
   block pair); each verifies on full sets and returns links that connect,
4. connected components of the verified links, spread to all class members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm._spark import stored
from keyfold.llm._words import mix, shingle_hashes, slices, text_bytes, word_hashes
from keyfold.llm.components import components

SKETCH = "doc_id long, n_shingles long, sig_a long, sig_b long, left array<long>, right array<long>"


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the distinct shingles of each text, sorted within it."""
    words, of, _, _ = word_hashes(data, offsets)
    h, t = shingle_hashes(words, of, len(offsets) - 1, k)
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return h[new], t[new]


def _signature(shingles: np.ndarray) -> int:
    """The first signature of one set, as a signed 64-bit integer."""
    return int(np.add.reduce(mix(shingles)).view(np.int64))


def _sketcher(k: int, h: int, m: int, seed: int):
    rng = np.random.default_rng(seed)
    mul = rng.integers(0, 1 << 63, 2 * m * h, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, 2 * m * h, dtype=np.uint64)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets):
                x, t = _sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                n = np.bincount(t, minlength=j - i)
                full = np.flatnonzero(n)
                starts = np.cumsum(n)[full] - n[full]
                sides = np.zeros((len(full), 2 * m), np.uint64)
                sigs = np.zeros((2, j - i), np.uint64)
                with np.errstate(over="ignore"):
                    if len(full):
                        for c in range(2 * m):
                            for r in range(c * h, c * h + h):
                                low = np.minimum.reduceat(x * mul[r] + add[r], starts)
                                sides[:, c] = mix(sides[:, c] * np.uint64(0x9E3779B97F4A7C15) + low)
                        sigs[0, full] = np.add.reduceat(mix(x), starts)
                        sigs[1, full] = np.add.reduceat(mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
                ends = np.concatenate([[0], np.cumsum((n > 0) * m)]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(s).view(np.int64).ravel())) for s in (sides[:, :m], sides[:, m:])]
                yield pa.record_batch([batch.column(0)[i:j].cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(sigs[0].view(np.int64)), pa.array(sigs[1].view(np.int64)), *lists],
                                      names=["doc_id", "n_shingles", "sig_a", "sig_b", "left", "right"])
    return sketch


def _verifier(k: int, percent: int):
    """Links of one group of texts, a spanning forest of them: checks every
    pair that could reach the threshold unless links already connect it."""

    def verify(table: pa.Table) -> pa.Table:
        nodes, own, inner, block = (table.column(c).to_pylist() for c in ("node", "own", "inner", "block"))
        data, offsets = text_bytes(table.column("text"))
        x, t = _sets(data, offsets, k)
        sizes = np.bincount(t, minlength=len(nodes))
        start = np.concatenate([[0], np.cumsum(sizes)])
        # An id that has several texts brings them all: only the node's own counts.
        asked = [bool(sizes[i]) and _signature(x[start[i]:start[i + 1]]) == nodes[i] for i in range(len(nodes))]
        # Shingles as ranks, rarest in this group first: a pair over the
        # threshold shares one of either's first n - ceil(threshold * n) + 1.
        _, inverse, times = np.unique(x, return_inverse=True, return_counts=True)
        rank = np.empty(len(times), np.int64)
        rank[np.argsort(times, kind="stable")] = np.arange(len(times))
        x = rank[inverse]
        x = x[np.lexsort((x, t))]
        prefix = sizes - -(-percent * sizes // 100) + 1
        chosen = np.arange(len(x)) - np.repeat(start[:-1], sizes) < np.repeat(prefix, sizes)
        token, doc = x[chosen], t[chosen]
        order = np.lexsort((sizes[doc], token))
        token, doc = token[order], doc[order]
        bounds = np.flatnonzero(np.diff(token, prepend=-1, append=-1)) if len(token) else np.zeros(0, np.int64)
        parent, n = list(range(len(nodes))), sizes.tolist()

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        seen, links = set(), []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            group = [d for d in doc[lo:hi].tolist() if asked[d]]
            for p, a in enumerate(group):
                most = 100 * n[a] // percent
                for b in group[p + 1:]:
                    if n[b] > most:
                        break  # sorted by size: the rest is larger still
                    pair = (a, b) if a < b else (b, a)
                    if pair in seen or not (own[a] or own[b]) or block[a] == block[b] and not inner[a]:
                        continue
                    seen.add(pair)
                    ra, rb = root(a), root(b)
                    if ra == rb:
                        continue
                    both = len(np.intersect1d(x[start[a]:start[a + 1]], x[start[b]:start[b + 1]], assume_unique=True))
                    if 100 * both >= percent * (n[a] + n[b] - both):
                        parent[ra] = rb
                        links.append((nodes[a], nodes[b]))
        found = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})
    return verify


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 85, shingle: int = 5,
                    rows: int = 3, sketches: int = 11, seed: int = 17, block_docs: int = 256, block_shingles: int = 1_000_000) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per input row.

    Links hold where 100 * |intersection| >= percent * |union| of the distinct
    ``shingle``-word sets.  A null or wordless text has an empty set and is
    its own component.  A row with a null id can't be named: it is linked with
    nothing, its component is null and ``kept`` is true.  Rows that repeat an
    id with the same text share the component and the flag; rows that repeat
    an id with different texts each get the component of their own text.
    An empty table gives no rows.  Other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = stored(texts.mapInArrow(_sketcher(shingle, rows, sketches, seed), SKETCH), "sketches")
    linkable = sketch.filter("n_shingles > 0 and doc_id is not null")

    # Equal sets: one class, a node named by its signature.
    same = ["sig_a", "sig_b", "n_shingles"]
    classes = stored(linkable.groupBy(*same).agg(F.min(F.struct("doc_id", "left", "right")).alias("first"))
                     .select(*same, F.col("sig_a").alias("node"), F.col("first.doc_id").alias("rep"), "first.left", "first.right"), "classes")

    # A table key is shared only where both its sketches are: sketches of one
    # class alone, nearly all, are left out before they are combined.
    mark = F.xxhash64("i", "sketch").bitwiseAND(F.lit(-2)).bitwiseOR(F.col("side")).alias("mark")
    marks = (classes.select("node", F.posexplode(F.array("left", "right")).alias("side", "of"))
             .select("node", "side", F.posexplode("of").alias("i", "sketch")).select("node", mark))
    often = marks.groupBy("mark").agg(F.count("*").alias("classes")).filter("classes > 1").select("mark")
    sides = stored(marks.join(often, "mark", "left_semi").groupBy("node").agg(F.collect_list("mark").alias("marks")), "marks")
    keys = (sides.select("node", F.explode("marks").alias("l"), "marks").filter("l % 2 = 0")
            .select("node", "l", F.explode("marks").alias("r")).filter("r % 2 <> 0").select("node", F.xxhash64("l", "r").alias("key")))
    # Everyone in a table is tied to its least: combined before the shuffle, and
    # a join, unlike a window, can have a hot table split over tasks.
    first = keys.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most").select("key", "least")
    star = keys.join(first, "key").filter("node > least").select("node", "least").distinct()
    clusters = components(star, "node", "least")

    # Size classes: linked sizes differ by less than a class, so a pair lies in
    # one class or in two neighbours; each text goes to its own and the next.
    members = classes.select("node", "rep", "n_shingles").join(clusters.withColumnRenamed("id", "node"), "node")
    own = F.floor(F.log(F.col("n_shingles").cast("double")) / (1.001 * math.log(100 / percent))).cast("int")
    placed = members.withColumn("class", own).withColumn("at", F.explode(F.array("class", F.col("class") + 1))).withColumn("own", F.expr("class = at"))
    group = Window.partitionBy("component", "at")
    placed = (placed.withColumns({"docs": F.count("*").over(group), "owned": F.sum(F.col("own").cast("int")).over(group),
                                  "most": F.max("n_shingles").over(group), "nth": F.row_number().over(group.orderBy("node"))})
              .filter("docs > 1 and owned > 0"))
    # Blocks bound a task's group; every pair of blocks meets, and pairs
    # within a block are checked where it meets its neighbour.
    per_block = F.greatest(F.lit(1), F.least(F.lit(block_docs), F.floor(F.lit(block_shingles) / F.col("most"))))
    placed = placed.withColumns({"last": (F.ceil(F.col("docs") / per_block) - 1).cast("int"), "block": F.floor((F.col("nth") - 1) / per_block).cast("int")})
    others = F.when(F.col("last") == 0, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("last")), lambda o: o != F.col("block")))
    placed = placed.withColumn("other", F.explode(others)).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    placed = placed.select("node", "rep", "component", "at", "own", "block", "lo", "hi",
                           F.expr("lo = hi or other = block + 1 or (block = last and other = block - 1)").alias("inner"))
    found = (placed.join(texts.withColumnRenamed("doc_id", "rep"), "rep")
             .groupBy("component", "at", "lo", "hi").applyInArrow(_verifier(shingle, percent), "a long, b long"))
    parts = components(found, "a", "b").withColumnRenamed("id", "node")

    grouped = classes.select(*same, "node", "rep").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = grouped.join(least, "component").select(*same, "component_id")
    linked = sketch.join(named, same, "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return (linked.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns, with one document of each group of near-duplicates.

    Rows with a null id stay (one of those with the same text), and so does one
    of the rows that repeat an id and its text.
    """
    near = stored(near_duplicates(docs, **options), "near")
    ids = near.groupBy("doc_id").agg(F.count("*").alias("rows"), F.bool_or("kept").alias("any"))
    # Aliases: the documents may have columns of these names.
    same, own = F.col("own.doc_id").eqNullSafe(F.col("found.doc_id")), docs.alias("own")
    once = own.join(ids.filter("rows > 1 or not any").alias("found"), same, "left_anti")
    return once.unionByName(own.join(ids.filter("rows > 1 and any").alias("found"), same, "left_semi").dropDuplicates(["doc_id", "text"]))


#: DuckDB SQL for the rows of ``near_duplicates`` on documents with unique ids.
NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, w.y FROM reach r JOIN ways w ON w.x = r.other)
SELECT doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
