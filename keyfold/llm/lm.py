"""Language-model scoring: a log-bilinear model over exact corpus counts.

Every word that the training texts have ``floor`` times is in the vocabulary,
which grows with the corpus; words below it are one word together.  The context
vector is the sum of the vectors of the two words before, each transformed by
the matrix of its place.  Words lie in classes of about equal frequency, and
neighbouring classes in groups: P(word | context) is a softmax over groups,
times one over the classes of the group, times one over the words of the class,
all of the context vector's products, so probabilities add up to one.  A word
of probability p has about p**(-1/3) choices at each.  All are trained in numpy with noise-contrastive estimation: a first pass
on a sample fixes the space, then every shard of the corpus goes over all its
training tokens from there, frequent words sampled and weighted, and the
shards' changes are averaged.  A word below the floor gets its share of the
discounted counts of those, and an unseen word the discounts' sum.

Exact counts of all words need one exchange.  Texts are cut in chunks of some
megabytes; each chunk sends its distinct word hashes, split by ranges of the
hash, with their training counts; each range adds up and answers every chunk.
What is sent grows with the chunks' distinct words, a frequent word counts
once a chunk, and no group has more than one entry a chunk and word.

Vocabulary and parameters are tables of blocks in the shared folder.  They are
made and averaged by tasks; the driver hands them on as broadcasts, three files of
some blocks (about 4 MB) at a time, and keeps none.  A Python worker maps the
broadcasts' files, so a machine's workers share their pages and no task loads
the model: one that scores takes rows from where they are, and one that learns
first draws its shard's noise words, copies the rows that the shard will change,
about 200 bytes each, and compares them at the end.  So a worker's memory grows
with its shard and not with the vocabulary, but for some bytes a word that say
which rows it has, and tasks of the model run on every core.  There are at
most ``most_words`` words.  A shard's changes are sent once: each task averages
those of some rows of a block, of fewer rows the more shards there are; of many
shards, some learn at a time and only the sums of their changes are kept.  Texts are dealt to shards by a
hash, so shards, and with them the scores, don't depend on the cluster.
"""

from __future__ import annotations

import bisect
import math
import mmap
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, SparkConf, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold import fs
from keyfold.llm._spark import crc_mod, stored
from keyfold.llm._words import mix, slices, text_bytes, word_hashes

#: The token after a text's last word (no word hashes to it but by chance).
END = mix(np.array([0x1234567], np.uint64))[0]
CHUNK_BYTES = 4 << 20
#: Distinct words of one range that all chunks send together.
RANGE_ENTRIES = 3_000_000
#: A chunk's lists of numbers are bytes: ``tok`` and ``cnt`` packed, ``uniq`` as 64 bits.
_CHUNK = "chunk long, doc_ids array<{kind}>, train array<boolean>, n_tokens array<int>, tok binary, uniq binary, n_uniq long, cnt binary"


#: Shuffle files of a run go when it ends, not when the driver collects its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Rows of megabytes go to Python a few at a time.
FEW = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@contextmanager
def _with(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the runs herein."""
    was = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in was.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: A Python worker that holds the model: its memory without words, and a word's.
WORKER_BYTES, WORD_BYTES = 150 << 20, 280


def cores_a_task(conf: SparkConf, words: int) -> int:
    """How many of an executor's cores a task that holds ``words`` words should
    take, so that such workers together have about a quarter of its heap's
    size beside it; 1 where the cores aren't known.  No task of this module
    holds all words any more, so each takes the usual one."""
    cluster = re.fullmatch(r"local-cluster\[\s*\d+\s*,\s*(\d+)\s*,\s*\d+\s*\]", conf.get("spark.master", ""))
    cores = 1 if conf.get("spark.master", "").startswith("local[") else int(cluster[1] if cluster else conf.get("spark.executor.cores", "1"))
    number, unit = re.match(r"(\d+)\s*([a-z]?)", conf.get("spark.executor.memory", "1g").lower()).groups()
    heap = int(number) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(unit, 0)
    usual = int(conf.get("spark.task.cpus", "1"))
    return min(max(usual, math.ceil((WORKER_BYTES + WORD_BYTES * words) * cores * 4 / heap)), max(cores, usual))


def _list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One row that is the list of all values."""
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as bytes: how many, 16 bits each, then the larger ones."""
    small = np.minimum(values, 0xFFFF).astype(np.uint16)
    return np.int64(len(values)).tobytes() + small.tobytes() + values[small == 0xFFFF].astype(np.int64).tobytes()


def _unpacked(data, kind=np.int64) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    small = np.frombuffer(data, np.uint16, n, 8)
    values = small.astype(kind)
    values[small == 0xFFFF] = np.frombuffer(bytes(memoryview(data)[8 + 2 * n:]), np.int64)
    return values


def _bytes(*values: bytes) -> pa.Array:
    return pa.array(values, pa.binary())


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
        for i, j in slices(offsets, CHUNK_BYTES):
            h, of, _, _ = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            words = np.bincount(of, minlength=j - i)
            h = np.insert(h, np.cumsum(words), END)
            n = words + 1
            uniq, tok = np.unique(h, return_inverse=True)
            counts = np.bincount(tok, np.repeat(train[i:j], n), len(uniq)).astype(np.int64)
            # Frequent words first: their numbers are short.
            order = np.argsort(-np.bincount(tok, minlength=len(uniq)), kind="stable")
            number_of = np.empty(len(uniq), np.int32)
            number_of[order] = np.arange(len(uniq), dtype=np.int32)
            yield pa.record_batch([pa.array([number], pa.int64()), _list(batch.column("doc_id")[i:j], None), _list(train[i:j], pa.bool_()), _list(n, pa.int32()),
                                   _bytes(_packed(number_of[tok])), _bytes(uniq[order].tobytes()), pa.array([len(uniq)], pa.int64()), _bytes(_packed(counts[order]))],
                                  names=["chunk", "doc_ids", "train", "n_tokens", "tok", "uniq", "n_uniq", "cnt"])
            number += 1


def _flat(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def _words_of(batch: pa.RecordBatch, row: int) -> np.ndarray:
    """The hashes of a chunk's distinct words."""
    return np.frombuffer(batch.column("uniq")[row].as_buffer(), np.uint64)


def _requests(bits: int):
    """``r, chunk, h, n``: a chunk's distinct words by the top ``bits`` of their hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                h, n = _words_of(batch, row), _unpacked(batch.column("cnt")[row].as_buffer())
                order = np.argsort(h)
                h, n = h[order], n[order]
                r = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
                at = np.concatenate([np.flatnonzero(np.diff(r, prepend=-1)), [len(r)]])
                k = len(at) - 1
                yield pa.record_batch([pa.array(r[at[:-1]]), pa.array(np.full(k, batch.column("chunk")[row].as_py(), np.int64)),
                                       _bytes(*(h[i:j].tobytes() for i, j in zip(at, at[1:], strict=False))), _bytes(*(_packed(n[i:j]) for i, j in zip(at, at[1:], strict=False)))], names=["r", "chunk", "h", "n"])
    return run


def _answer(floor: int):
    """``chunk, r, c``: the corpus counts of each chunk's words of one range;
    and one row of chunk -1 with the range's sums and its words of ``floor`` or more."""
    def run(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("h")]
        ends = np.cumsum([0, *map(len, sent)])
        h, place = np.unique(np.concatenate(sent), return_inverse=True)
        c = np.bincount(place, np.concatenate([_unpacked(x.as_buffer()) for x in table.column("n")]), len(h)).astype(np.int64)
        seen = c[c > 0]
        sums = [len(seen), seen.sum(), (seen == 1).sum(), (seen == 2).sum()]
        best = np.flatnonzero(c >= floor)
        rows = table.num_rows
        empty = [[]] * rows
        return pa.table({"chunk": pa.array(np.append(table.column("chunk").to_numpy(), -1)), "r": pa.array(np.append(table.column("r").to_numpy(), table.column("r")[0].as_py())),
                         "c": _bytes(*(_packed(c[place[i:j]]) for i, j in zip(ends, ends[1:], strict=False)), _packed(c[best])),
                         "sums": pa.array([*empty, [int(x) for x in sums]], pa.list_(pa.int64())), "h": _bytes(*[b""] * rows, h[best].tobytes())})
    return run


def _contexts(cls: np.ndarray, n: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(word two before, word before) of each token; ``start`` before a text's first."""
    first = np.cumsum(n) - n
    one = np.roll(cls, 1)
    one[first] = start
    two = np.roll(one, 1)
    two[first] = start
    return two, one


def _trigrams(batch: pa.RecordBatch, row: int, v: Vocabulary) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """(two before, one before, word) of a chunk's training tokens, as word numbers, and the words' smoothed counts."""
    n = _flat(batch, "n_tokens", row).astype(np.int64)
    ids, tok = v.ids_of(_words_of(batch, row)), _unpacked(batch.column("tok")[row].as_buffer(), np.int32)
    w = ids.astype(np.int32)[tok]
    two, one = _contexts(w, n, v.words + 1)
    learns = np.repeat(_flat(batch, "train", row).astype(bool), n)
    return (two[learns], one[learns], w[learns]), v.times_of(ids)[tok[learns]]


# -- vocabulary -----------------------------------------------------------------
def bucket(c: np.ndarray) -> np.ndarray:
    """Counts to buckets of about equal counts: below 64 each its own, then 16 to a doubling."""
    power = np.frexp(np.maximum(c, 1).astype(float))[1] - 1
    return np.where(c < 64, c, 64 + (power - 6) * 16 + ((c >> np.maximum(power - 4, 0)) & 15))


@dataclass
class Classes:
    """How words become classes and blocks, from how many words and tokens each bucket has."""

    lowest: int  # least bucket of the vocabulary
    first: np.ndarray  # per bucket: its first class
    many: np.ndarray  # and its classes
    block: np.ndarray  # per class

    @classmethod
    def planned(cls, words: dict[int, int], tokens: dict[int, int], total: int, most_words: int, block_words: int = 1 << 13) -> Classes:
        kept, held = [], 0
        for b in sorted(words, reverse=True):  # frequent words first
            held += words[b]
            if held > most_words:
                break
            kept.append(b)
        size = max(words, default=0) + 1
        first, many, sizes = np.zeros(size, np.int64), np.ones(size, np.int64), []
        for b in kept:
            n = max(1, round(words[b] * (tokens[b] / words[b] / max(total, 1)) ** (1 / 3)))
            first[b], many[b] = len(sizes), n
            sizes += [words[b] / n] * n
        return cls(kept[-1] if kept else size, first, many, (np.cumsum(sizes) // block_words).astype(np.int64))

    def of(self, h: np.ndarray, c: np.ndarray) -> np.ndarray:
        b = bucket(c)
        return self.first[b] + (mix(h ^ np.uint64(0x5BD1E995)) % self.many[b].astype(np.uint64)).astype(np.int64)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``bucket, words, tokens`` of each batch of ``h, c`` lists."""
    for batch in batches:
        c = np.concatenate([_unpacked(x.as_buffer()) for x in batch.column("c")])
        b, at = np.unique(bucket(c), return_inverse=True)
        yield pa.record_batch([pa.array(b.astype(np.int64)), pa.array(np.bincount(at, minlength=len(b)).astype(np.int64)), pa.array(np.bincount(at, c, len(b)).astype(np.int64))], names=["bucket", "words", "tokens"])


def _placed(classes: Classes):
    """``block, cls, h, c`` of the words in the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("h")])
            c = np.concatenate([_unpacked(x.as_buffer()) for x in batch.column("c")])
            inside = bucket(c) >= classes.lowest
            cls = classes.of(h[inside], c[inside])
            yield pa.record_batch([pa.array(classes.block[cls]), pa.array(cls), pa.array(h[inside].view(np.int64)), pa.array(c[inside])], names=["block", "cls", "h", "c"])
    return run


def _block_row(table: pa.Table) -> pa.Table:
    """One row of bytes for a block of the vocabulary: ``block, part, data`` with classes, hashes and counts."""
    cls, h, c = (table.column(x).to_numpy() for x in ("cls", "h", "c"))
    order = np.lexsort((h.view(np.uint64), cls))
    data = np.stack([cls[order], h[order], c[order]]).tobytes()
    return pa.table({"block": table.column("block")[:1], "part": pa.array([VOCABULARY], pa.int32()), "data": pa.array([data], pa.binary())})


def _by_hash(first: dict[int, int], bits: int):
    """``r, h, id``: a block's hashes and word numbers by the top ``bits`` of the hash; ``first`` has each block's first number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                h = np.frombuffer(batch.column("data")[row].as_buffer(), np.int64).reshape(3, -1)[1].view(np.uint64)
                order = np.argsort(h)
                h, ids = h[order], (first[batch.column("block")[row].as_py()] + order).astype(np.int32)
                r = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
                at = np.concatenate([np.flatnonzero(np.diff(r, prepend=-1)), [len(r)]])
                yield pa.record_batch([pa.array(r[at[:-1]]), _bytes(*(h[i:j].tobytes() for i, j in zip(at, at[1:], strict=False))),
                                       _bytes(*(ids[i:j].tobytes() for i, j in zip(at, at[1:], strict=False)))], names=["r", "h", "id"])
    return run


def _lookup_row(table: pa.Table) -> pa.Table:
    """One row of bytes for a range of hashes: these in order, then their word numbers."""
    h, ids = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]) for name, kind in (("h", np.uint64), ("id", np.int32)))
    order = np.argsort(h)
    return pa.table({"block": table.column("r")[:1], "part": pa.array([LOOKUP], pa.int32()), "data": _bytes(h[order].tobytes() + ids[order].tobytes())})


#: What a block's bytes are: words of the vocabulary, context vectors, target vectors; the rest has block -1; word numbers by hash, a range a block.
VOCABULARY, WORDS, TARGETS, REST, LOOKUP = range(5)
_BLOCKS = "block long, part int, data binary"
#: Blocks (of about 0.6 MB) that a file has at most, and files that the driver hands on at once.
BLOCK_ROWS, FILES_AT_ONCE = 8, 3


#: How a pickled ``bytes`` value begins, up to its length.
_PICKLED = re.compile(rb"\x80.(?:\x95.{8})?(?:C(.)|B(.{4})|\x8e(.{8}))", re.DOTALL)


def _read(block: Broadcast):
    """A broadcast's bytes.  A worker maps them from its file: they take none of
    its memory, and it keeps nothing while it waits for further tasks, and after."""
    path = getattr(block, "_path", None)
    if path is None or hasattr(block, "_value"):
        return block.value
    with open(path, "rb") as file:
        begin = _PICKLED.match(head := file.read(32))
        n = int.from_bytes(begin[begin.lastindex], "little") if begin else 0
        # After the value only some bytes that end the file, the last of them a full stop.
        if n and 0 < (size := file.seek(0, 2)) - begin.end() - n < 32 and head:
            mapped = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
            if mapped[size - 1] == 0x2E:
                return memoryview(mapped)[begin.end():begin.end() + n]
    return block.load_from_path(path)


def _remove(rows: DataFrame) -> None:
    """Deletes the files of stored rows."""
    for folder in {x.rpartition("/")[0] for x in rows.inputFiles()}:
        fs.delete(rows.sparkSession, folder)


@dataclass
class Shared:
    """Blocks of bytes by (part, block), each a broadcast."""

    blocks: dict[tuple[int, int], Broadcast] = field(default_factory=dict)

    def add(self, spark: SparkSession, rows: DataFrame) -> Shared:
        """With the blocks of ``block, part, data`` rows; of stored rows, some files (of about 4 MB) are brought over at a time."""
        found = dict(self.blocks)

        def bring(some: DataFrame) -> None:
            for row in some.select("block", "part", "data").toArrow().to_pylist():
                found[row["part"], row["block"]] = spark.sparkContext.broadcast(row["data"])

        files = sorted(rows.inputFiles())
        # A file takes little but waiting.
        with ThreadPoolExecutor(FILES_AT_ONCE) as pool:
            for _ in pool.map(bring, [spark.read.schema(rows.schema).parquet(x) for x in files] if files else [rows]):
                pass
        return Shared(found)

    def taken(self, spark: SparkSession, rows: DataFrame) -> Shared:
        """``add`` of stored rows, whose files then go: the broadcasts have them."""
        found = self.add(spark, rows)
        _remove(rows)
        return found

    def arrays(self, part: int) -> Iterator[bytes | memoryview]:
        return (_read(self.blocks[key]) for key in sorted(self.blocks) if key[0] == part)


class Vocabulary:
    """Hashes, counts and classes of the words, by number; where its blocks are."""

    def __init__(self, shared: Shared, rest_tokens: float):
        found = [np.frombuffer(x, np.int64).reshape(3, -1) for x in shared.arrays(VOCABULARY)]
        self.sizes = [x.shape[1] for x in found]
        self.words = sum(self.sizes)
        # Classes without words aren't counted; the words below the floor, together, are the last.
        bounds, mass, lo, last = [], [0.0], 0, -1
        for cls, _, c in found:
            first = np.flatnonzero(np.diff(cls, prepend=last))
            bounds.append(first + lo)
            if cls[0] == last:  # a class that began in the block before
                mass[-1] += (c[:first[0] if len(first) else None] + 0.5).sum()
            mass += list(np.add.reduceat(c + 0.5, first)) if len(first) else []
            lo, last = lo + len(cls), cls[-1]
        self.bounds = np.concatenate([*bounds, [lo, lo + 1]]).astype(np.int64)
        #: How often words of each class are there, and of each word, smoothed.
        self.mass = np.array([*mass[1:], rest_tokens + 0.5])
        self.counts = Blocks([*(x[2] for x in found), np.array([rest_tokens])])
        self.lookup = []
        for x in shared.arrays(LOOKUP):
            n = len(x) // 12
            self.lookup.append((np.frombuffer(x, np.uint64, n), np.frombuffer(x, np.int32, n, 8 * n)))
        if found and not self.lookup:
            h = np.concatenate([x[1] for x in found]).view(np.uint64)
            ids = np.argsort(h).astype(np.int32)
            self.lookup = [(h[ids], ids)]

    def ids_of(self, h: np.ndarray) -> np.ndarray:
        """The word number of each hash, ``words`` of one that isn't in the vocabulary."""
        out, order = np.full(len(h), self.words, np.int64), np.argsort(h)
        h = h[order]
        for hashes, ids in self.lookup:
            i, j = np.searchsorted(h, hashes[0]), np.searchsorted(h, hashes[-1], "right")
            at = np.searchsorted(hashes, h[i:j])
            there = np.flatnonzero(hashes[at] == h[i:j])
            out[order[i:j][there]] = ids[at[there]]
        return out

    def times_of(self, ids: np.ndarray) -> np.ndarray:
        """The smoothed count of each word."""
        some, at = np.unique(ids, return_inverse=True)
        return (self.counts[some].astype(float) + 0.5)[at]


def _sample(shared: Shared, rest: float, rate: float):
    """``two, one, w``: a part ``rate`` of the training trigrams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(shared, rest)
        for batch in batches:
            for row in range(batch.num_rows):
                grams, _ = _trigrams(batch, row, v)
                rng = np.random.default_rng(batch.column("chunk")[row].as_py())
                pick = rng.random(len(grams[0])) < rate
                yield pa.record_batch([pa.array(g[pick].astype(np.int32)) for g in grams], names=["two", "one", "w"])
    return run


#: Words of one range of hashes.
LOOKUP_WORDS = 1 << 16


def _vocabulary(blocks: DataFrame) -> Shared:
    """The stored blocks of the vocabulary, and word numbers by hash."""
    spark, first, words = blocks.sparkSession, {}, 0
    for x in blocks.select("block", (F.octet_length("data") / 24).cast("long").alias("n")).sort("block").collect():  # 16 bytes a block
        first[x.block] = words
        words += x.n
    bits = max(0, math.ceil(math.log2(max(words, 1) / LOOKUP_WORDS)))
    lookup = blocks.mapInArrow(_by_hash(first, bits), "r long, h binary, id binary").groupBy("r").applyInArrow(_lookup_row, _BLOCKS)
    return Shared().taken(spark, stored(lookup, "lookup", BLOCK_ROWS)).taken(spark, blocks)


# -- the model --------------------------------------------------------------------
def _cuts(sizes: np.ndarray) -> np.ndarray:
    """First entries of runs whose ``sizes`` add up to about 1, and their number."""
    place = np.cumsum(sizes).astype(np.int64)
    return np.append(np.flatnonzero(np.diff(place, prepend=-1)), len(sizes))


def class_bounds(times: np.ndarray) -> np.ndarray:
    """First words of the classes of words by falling counts, and their number;
    the last word, all words below the floor, is a class."""
    p = times[:-1] / max(times.sum(), 1)
    return np.append(_cuts(np.cbrt(p)), len(times)) if len(p) else np.array([0, 1])


def _order(index: np.ndarray) -> np.ndarray:
    """A stable order of numbers of up to 43 bits; that of numbers of 16 bits is found faster."""
    if not len(index) or index.max() < 1 << 16:
        return np.argsort(index.astype(np.uint16), kind="stable")
    if len(index) > 1 << 20:
        return np.argsort(index, kind="stable")
    # Numbers with their places sort faster than places by numbers.
    return np.sort((index.astype(np.int64) << 20) | np.arange(len(index))) & ((1 << 20) - 1)


def _grouped(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of ``index`` and the sums of their rows of ``values``."""
    order = _order(index)
    at = index[order]
    new = np.diff(at, prepend=-1) != 0
    starts = np.flatnonzero(new)
    if 4 * len(starts) < len(index):
        return at[starts], np.add.reduceat(values.take(order, 0), starts)
    # Most numbers are there once: only the others' rows are added, in the same order as above.
    sums, size = values.take(order[starts], 0), np.diff(starts, append=len(order))
    which = np.cumsum(new) - 1
    more = np.flatnonzero(~new & (size < 3)[which])
    np.add.at(sums, which[more], values.take(order[more], 0))
    many = np.flatnonzero(size >= 3)
    if len(many):
        sums[many] = np.add.reduceat(values.take(order[(size >= 3)[which]], 0), np.cumsum(size[many]) - size[many])
    return at[starts], sums


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def group_bounds(mass: np.ndarray) -> np.ndarray:
    """First classes of the groups, and their number."""
    return _cuts(np.sqrt(mass / mass.sum()))


def _run_of(edges: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The run between ``edges`` that each number lies in."""
    return np.searchsorted(edges, numbers, "right") - 1


def _within(q: np.ndarray, at: np.ndarray, chosen: np.ndarray, run: np.ndarray, edges: np.ndarray, table, out: np.ndarray) -> None:
    """Adds ln P(chosen | its run) to ``out``: a softmax over the run between ``edges`` that it lies in."""
    order = _order(run)
    cuts = np.searchsorted(run[order], np.arange(len(edges)))
    at, place = at[order], (chosen - edges[run])[order]
    mine, total = np.zeros(len(at), np.float32), np.ones(len(at), np.float32)
    size, ones, count = np.diff(edges), np.ones(np.diff(edges).max(), np.float32), np.arange(len(at))
    runs = np.flatnonzero((np.diff(cuts) > 0) & (size > 1))
    # The loop is short: there are thousands of runs.
    for first, last, lo, n in zip(*(x.tolist() for x in (cuts[runs], cuts[runs + 1], edges[runs], size[runs])), strict=True):
        step, own = max(1, (1 << 17) // n), table[lo:lo + n].T
        for i in range(first, last, step):
            j = min(i + step, last)
            z = q.take(at[i:j], 0) @ own
            mine[i:j] = z[count[:j - i], place[i:j]]
            with np.errstate(over="ignore"):
                np.dot(np.exp(z, out=z), ones[:n], out=total[i:j])
    # Where sums aren't of a float's range, the largest product is taken from all.
    for i in np.flatnonzero(~((total > 1e-30) & (total < 1e30))):
        lo = edges[run[order[i]]]
        z = table[lo:edges[run[order[i]] + 1]] @ q[at[i]]
        mine[i], total[i] = z[place[i]] - z.max(), np.exp(z - z.max()).sum()
    out[order] += mine - np.log(total)


class Blocks:
    """Rows that lie in blocks, as one table of which slices of a block and rising rows are taken."""

    def __init__(self, parts: list[np.ndarray]):
        self.parts = parts
        self.first = np.cumsum([0, *map(len, parts)])
        self.starts = self.first.tolist()

    def __len__(self) -> int:
        return int(self.first[-1])

    def __getitem__(self, rows):
        if isinstance(rows, slice):
            b = bisect.bisect_right(self.starts, rows.start) - 1
            return self.parts[b][rows.start - self.starts[b]:rows.stop - self.starts[b]]
        cuts = np.searchsorted(rows, self.first)
        return np.concatenate([x[rows[i:j] - lo] for x, i, j, lo in zip(self.parts, cuts, cuts[1:], self.first, strict=False)])


@dataclass
class LogBilinear:
    words: np.ndarray  # (k + 1) x d, the last is a text's start
    places: np.ndarray  # 2 x d x d
    targets: np.ndarray  # k x (d + 1), the last column is the bias
    classes: np.ndarray  # classes x (d + 1)
    groups: np.ndarray  # groups x (d + 1)
    bounds: np.ndarray  # first words of the classes, and k
    over: np.ndarray  # first classes of the groups, and their number
    mass: np.ndarray  # training counts of the classes
    squares: list[np.ndarray]  # Adagrad: a row of words, places, a row of targets, classes and groups
    rows: tuple[np.ndarray, ...]  # what all these are views of: words' rows, targets' rows, the state of training last in each, and all other numbers

    @classmethod
    def of_rows(cls, words: np.ndarray, targets: np.ndarray, others: np.ndarray, bounds: np.ndarray, over: np.ndarray, mass: np.ndarray) -> LogBilinear:
        """All parameters as views of the arrays given, which may have some words' and targets' rows only."""
        d, c, g = words.shape[1] - 1, len(bounds) - 1, len(over) - 1
        sizes = [c * (d + 1), c, g * (d + 1), g, 2 * d * d, 2 * d * d]
        classes, class_state, groups, group_state, places, place_state = np.split(others, np.cumsum(sizes)[:-1])
        return cls(words[:, :d], places.reshape(2, d, d), targets[:, :d + 1], classes.reshape(c, d + 1), groups.reshape(g, d + 1), bounds, over, mass,
                   [words[:, d], place_state.reshape(2, d, d), targets[:, d + 1], class_state, group_state], (words, targets, others))

    @classmethod
    def start(cls, times: np.ndarray, d: int, seed: int) -> LogBilinear:
        bounds = class_bounds(times + 0.5)
        mass = np.add.reduceat(times + 0.5, bounds[:-1])
        everything = {WORDS: np.ones(len(times) + 1, bool), TARGETS: np.ones(len(times), bool)}
        return cls.of_some(_started(times, mass, group_bounds(mass), d, seed), everything, d, bounds, group_bounds(mass), mass)

    @classmethod
    def of_some(cls, parts: Iterator[tuple[int, int, np.ndarray]], seen: dict[int, np.ndarray], d: int, bounds: np.ndarray, over: np.ndarray, mass: np.ndarray) -> LogBilinear:
        """Of the rows of words and targets that are ``seen``, in order; ``parts`` are (part, first row, rows)."""
        held = {part: np.empty((np.count_nonzero(seen[part]), d + width), np.float32) for part, width in ((WORDS, 1), (TARGETS, 2))}
        at = dict.fromkeys(held, 0)
        for part, lo, rows in parts:
            if part == REST:
                others = rows.copy()
                continue
            wanted = np.flatnonzero(seen[part][lo:lo + len(rows)])
            held[part][at[part]:at[part] + len(wanted)] = rows[wanted]
            at[part] += len(wanted)
        return cls.of_rows(held[WORDS], held[TARGETS], others, bounds, over, mass)

    def states(self) -> list[slice]:
        """Where the state of training lies in the third array of ``rows``."""
        ends = np.cumsum([x.size for x in (self.classes, self.squares[3], self.groups, self.squares[4], self.places, self.squares[1])])
        return [slice(ends[i], ends[i + 1]) for i in (0, 2, 4)]

    def learn(self, grams: tuple[np.ndarray, ...], weights: np.ndarray, rng: np.random.Generator, numbers: dict[int, np.ndarray] | None = None, rate: float = 0.1) -> None:
        """One pass: groups against groups drawn by frequency, classes against
        some of their group, words against some of their class.  ``numbers``:
        the rows that words have among those held here."""
        d = self.places.shape[1]
        words_rows, target_rows, _ = self.rows
        sums = np.concatenate([[0.0], np.cumsum(self.mass)])[self.over]
        group_p = np.log(np.diff(sums) / sums[-1]).astype(np.float32)
        lo = 0
        for two, one, g, drawn, levels in _drawn(self.bounds, self.over, self.mass, grams, rng):
            n = len(g)
            weight = weights[lo:lo + n, None].astype(np.float32, copy=False)
            lo += n
            if numbers is not None:
                two, one = numbers[WORDS][two], numbers[WORDS][one]
            # Whole rows, with the state, are faster to take.
            xa, xb = (np.ascontiguousarray(words_rows.take(x, 0)[:, :d]) for x in (two, one))
            q = np.ones((n, d + 1), np.float32)
            q[:, :d] = xa @ self.places[0] + xb @ self.places[1]
            own, others = self.groups[g], self.groups[drawn]
            shift = math.log(len(drawn))
            g_own = (_logistic(np.einsum("nd,nd->n", q, own) - group_p[g] - shift)[:, None] - 1) * weight
            g_others = _logistic(q @ others.T - group_p[drawn] - shift) * weight
            dq = g_own * own + g_others @ others
            found = [_grouped(np.concatenate([g, drawn]), np.concatenate([g_own * q, g_others.T @ q]))]
            for level, table in zip(levels, (self.classes, target_rows), strict=True):
                if level is None:
                    found.append(None)
                    continue
                many, which, size = level
                if table is target_rows and numbers is not None:
                    which = numbers[TARGETS][which]
                rows, mine = np.ascontiguousarray(table.take(which, 0)[:, :, :d + 1]), q[many]
                grad = _logistic(np.matmul(rows, mine[:, :, None])[:, :, 0] + np.log(size / (which.shape[1] - 1)).astype(np.float32)[:, None])
                grad[:, 0] -= 1
                grad *= weight[many]
                dq[many] += np.matmul(grad[:, None, :], rows)[:, 0]
                found.append(_grouped(which.ravel(), np.einsum("nk,nd->nkd", grad, mine).reshape(-1, d + 1)))
            dq = dq[:, :d]
            words = _grouped(np.concatenate([two, one]), np.concatenate([dq @ self.places[0].T, dq @ self.places[1].T]))
            places = np.stack([xa.T @ dq, xb.T @ dq])
            self.squares[1] += places * places
            self.places -= 0.1 * rate * places / np.sqrt(self.squares[1])
            for p, s, change in ((self.groups, self.squares[4], found[0]), (self.classes, self.squares[3], found[1])):
                if change is not None:
                    at, grad = change
                    s[at] += (grad * grad).mean(1)
                    p[at] -= rate * grad / np.sqrt(s[at])[:, None]
            for table, change in ((words_rows, words), (target_rows, found[2])):
                if change is not None:
                    at, grad = change
                    rows = table.take(at, 0)
                    rows[:, -1] += (grad * grad).mean(1)
                    rows[:, :-1] -= rate * grad / np.sqrt(rows[:, -1:])
                    table[at] = rows

    def log_probability(self, grams: tuple[np.ndarray, ...]) -> np.ndarray:
        """log10 P(word | two before, one before) of each trigram, normalised; equal ones once."""
        k, d = len(self.targets), self.places.shape[1]
        two, one, w = (x.astype(np.int64) for x in grams)  # a context's number has more than 32 bits
        seen, at = np.unique(two * (k + 1) + one, return_inverse=True)
        pairs, back = np.unique(at * k + w, return_inverse=True)
        at, w = np.divmod(pairs, k)
        two, one = np.divmod(seen, k + 1)
        there = np.zeros(k + 1, bool)
        there[two] = there[one] = there[w] = True
        row_of, here = np.cumsum(there, dtype=np.int32) - 1, np.flatnonzero(there)
        words = self.words[here]
        q = np.ones((len(seen), d + 1), np.float32)
        q[:, :d] = (words @ self.places[0]).take(row_of[two], 0)
        q[:, :d] += (words @ self.places[1]).take(row_of[one], 0)
        c = _run_of(self.bounds, here)[row_of[w]]
        del seen, two, one, pairs, row_of, there
        g = _run_of(self.over, c)
        out = np.zeros(len(w), np.float32)
        for chosen, run, edges, table in ((g, np.zeros(len(g), np.int64), np.array([0, len(self.groups)]), self.groups), (c, g, self.over, self.classes), (w, c, self.bounds, self.targets)):
            _within(q, at, chosen, run, edges, table, out)
        return (out / np.float32(math.log(10)))[back]

    def log_probabilities(self) -> np.ndarray:
        """log10 P(word | two before, one before), all contexts (of a small vocabulary)."""
        k = len(self.targets)
        two, one, w = (x.ravel() for x in np.meshgrid(np.arange(k + 1), np.arange(k + 1), np.arange(k), indexing="ij"))
        return self.log_probability((two, one, w)).reshape(k + 1, k + 1, k)


def _drawn(bounds: np.ndarray, over: np.ndarray, mass: np.ndarray, grams: tuple[np.ndarray, ...], rng: np.random.Generator, batch: int = 4096, group_noise: int = 16, noise: int = 4) -> Iterator[tuple]:
    """For each batch: words two and one before, groups, noise groups, and at
    the levels of classes and of words (those that have a choice, they and their
    noise, the choices there); no row of the model is needed for it."""
    sums = np.concatenate([[0.0], np.cumsum(mass)])[over]
    choices = {id(x): np.diff(x) for x in (over, bounds)}
    for lo in range(0, len(grams[0]), batch):
        two, one, w = (g[lo:lo + batch] for g in grams)
        c = _run_of(bounds, w)
        g = _run_of(over, c)
        drawn = np.minimum(np.searchsorted(sums, rng.random(group_noise) * sums[-1], "right") - 1, len(over) - 2)
        levels = []
        for chosen, parent, edges in ((c, g, over), (w, c, bounds)):
            # Children of one parent are about equally frequent: noise is drawn evenly.  A parent of one child has nothing to learn.
            size = choices[id(edges)][parent]
            many = np.flatnonzero(size > 1)
            if not len(many):
                levels.append(None)
                continue
            size = size[many]
            which = np.empty((len(many), 1 + noise), np.int64)
            which[:, 0] = chosen[many]
            which[:, 1:] = edges[parent[many], None] + (rng.random((len(many), noise), np.float32) * size[:, None]).astype(np.int64)
            levels.append((many, which, size))
        yield two, one, g, drawn, levels


def train(codes: np.ndarray, times: np.ndarray, k: int, d: int = 16, steps: int = 250, batch: int = 4096, seed: int = 13) -> LogBilinear:
    """A model of the trigrams ``codes``, drawn in proportion to their ``times``."""
    model = LogBilinear.start(np.bincount(codes % k, times, k), d, seed)
    rng = np.random.default_rng(seed)
    if len(codes):
        drawn = rng.choice(codes, steps * batch, p=times / times.sum())
        model.learn((drawn // k // (k + 1), drawn // k % (k + 1), drawn % k), np.ones(len(drawn)), rng)
    return model


# -- its blocks, and learning by shards ---------------------------------------------
#: Rows that are drawn at once.
DRAWN_ROWS = 1 << 14


def _started(times, mass: np.ndarray, over: np.ndarray, d: int, seed: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(part, first row, rows) of a new model for words so often there: some rows of
    words, then of targets, at a time, and all other numbers; drawn at double precision."""
    k, rng, total = len(times), np.random.default_rng(seed), mass.sum()
    for part, n, width in ((WORDS, k + 1, d + 1), (TARGETS, k, d + 2)):
        for lo in range(0, n, DRAWN_ROWS):
            rows = np.full((min(DRAWN_ROWS, n - lo), width), 0.1, np.float32)  # the state of training is last
            rows[:, :d] = rng.normal(0, 0.1, (len(rows), d))
            if part == TARGETS:
                rows[:, d] = np.log((times[np.arange(lo, lo + len(rows))] + 0.5) / total)
            yield part, lo, rows
    rest = []
    for x in (mass, np.add.reduceat(mass, over[:-1])):
        table = np.empty((len(x), d + 1), np.float32)
        for lo in range(0, len(x), DRAWN_ROWS):
            table[lo:lo + DRAWN_ROWS, :d] = rng.normal(0, 0.1, (min(DRAWN_ROWS, len(x) - lo), d))
        table[:, d] = np.log(x / total)
        rest += [table, np.full(len(x), 0.1)]
    yield REST, 0, np.concatenate([x.ravel() for x in (*rest, np.eye(d) * 0.5, np.eye(d) * 0.5, np.full(2 * d * d, 0.1))]).astype(np.float32)


def _blocks_of(shared: Shared, v: Vocabulary, d: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(block, first word, words' rows, targets' rows), not copied."""
    lo = 0
    for block, (n, words, targets) in enumerate(zip(v.sizes, shared.arrays(WORDS), shared.arrays(TARGETS), strict=True)):
        yield block, lo, np.frombuffer(words, np.float32).reshape(n, d + 1), np.frombuffer(targets, np.float32).reshape(n, d + 2)
        lo += n


def _last(shared: Shared, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The last rows of the words and of the targets, and all other numbers, not copied."""
    words, targets, others = np.split(np.frombuffer(next(shared.arrays(REST)), np.float32), [2 * (d + 1), 3 * d + 4])
    return words.reshape(2, d + 1), targets.reshape(1, d + 2), others


def _parts_of(shared: Shared, v: Vocabulary, d: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(part, first row, rows) of shared blocks, not copied; the last rows are in the rest."""
    for _, lo, words, targets in _blocks_of(shared, v, d):
        yield WORDS, lo, words
        yield TARGETS, lo, targets
    yield from zip((WORDS, TARGETS, REST), (v.words, v.words, 0), _last(shared, d), strict=True)


def _seen(v: Vocabulary) -> dict[int, np.ndarray]:
    """Which rows of words and of targets a task needs: at first the last, which aren't in blocks."""
    seen = {WORDS: np.zeros(v.words + 2, bool), TARGETS: np.zeros(v.words + 1, bool)}
    seen[WORDS][-2:] = seen[TARGETS][-1:] = True
    return seen


def _see(seen: dict[int, np.ndarray], v: Vocabulary, over: np.ndarray, grams: tuple[np.ndarray, ...], rng: np.random.Generator) -> None:
    """Adds the rows that learning from ``grams`` needs; moves ``rng`` on as that does."""
    for two, one, _, _, (_, level) in _drawn(v.bounds, over, v.mass, grams, rng):
        seen[WORDS][two] = seen[WORDS][one] = True
        if level is not None:
            seen[TARGETS][level[1]] = True


def _numbers(seen: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The rows that words have among those seen."""
    found = {part: np.cumsum(x, dtype=np.int32) for part, x in seen.items()}
    for x in found.values():
        x -= 1
    return found


def _fitted(shared: Shared, v: Vocabulary, d: int) -> LogBilinear:
    """The model of shared blocks, for scoring: words and targets stay where they are."""
    *last, others = _last(shared, d)
    model = LogBilinear.of_rows(*last, others, v.bounds, group_bounds(v.mass), v.mass)
    found = list(_blocks_of(shared, v, d))
    model.words = Blocks([*(x[:, :d] for _, _, x, _ in found), model.words])
    model.targets = Blocks([*(x[:, :d + 1] for *_, x in found), model.targets])
    return model


def _first(shared: Shared, rest: float, d: int, first: int, seed: int):
    """The blocks of a model trained on a sample of trigrams, in one task (rows with ``w`` -1 say nothing).
    It holds the rows that these need; the others are drawn anew and sent on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(shared, rest)
        rows = [np.stack([b.column(x).to_numpy() for x in ("two", "one", "w")]) for b in batches]
        grams = np.concatenate(rows, 1).astype(np.int64) if rows else np.zeros((3, 0), np.int64)
        grams = grams[:, grams[2] >= 0]
        n, rng = grams.shape[1], np.random.default_rng(seed)
        order = rng.permutation(n) if n >= first // 2 else rng.integers(0, max(n, 1), min(first, 20 * n))  # a small table several times
        grams, over, seen, state = tuple(grams[:, order]), group_bounds(v.mass), _seen(v), rng.bit_generator.state
        _see(seen, v, over, grams, rng)
        rng.bit_generator.state = state
        model = LogBilinear.of_some(_started(v.counts, v.mass, over, d, seed), seen, d, v.bounds, over, v.mass)
        model.learn(grams, np.ones(len(order)), rng, _numbers(seen))

        def blocks() -> Iterator[tuple[int, int, np.ndarray]]:
            held, ends = dict(zip((WORDS, TARGETS), model.rows, strict=False)), np.cumsum([0, *v.sizes])
            at, block, waiting, rest = dict.fromkeys(held, 0), dict.fromkeys(held, 0), {x: [] for x in held}, []
            for part, lo, rows in _started(v.counts, v.mass, over, d, seed):
                if part == REST:
                    break
                mine = np.flatnonzero(seen[part][lo:lo + len(rows)])
                rows[mine] = held[part][at[part]:at[part] + len(mine)]
                at[part] += len(mine)
                while len(rows) and block[part] < len(v.sizes):
                    have = sum(map(len, waiting[part]))
                    take = ends[block[part] + 1] - ends[block[part]] - have
                    waiting[part].append(rows[:take])
                    if len(rows) < take:
                        rows = rows[:0]
                        continue
                    yield block[part], part, np.concatenate(waiting[part])
                    rows, waiting[part] = rows[take:], []
                    block[part] += 1
                rest.append(rows.flatten())  # beyond the blocks
            yield -1, REST, np.concatenate([*rest, model.rows[2]])

        for block, part, data in blocks():
            yield pa.record_batch([pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([data.tobytes()], pa.binary())], names=["block", "part", "data"])
    return run


_CHANGES = "block long, part int, piece int, shard long, rows binary, change binary"
#: Shards whose changes of one whole block a task averages; with more, it does so for a piece of the block.
SHARDS_A_BLOCK = 32
#: Shards that learn before their changes are added up, so that not all changes are on disk at once.
SHARDS_AT_ONCE = 96


def _changed(model: LogBilinear, seen: dict[int, np.ndarray], shared: Shared, v: Vocabulary, d: int, shard: int, pieces: int) -> Iterator[pa.RecordBatch]:
    """A shard's changes by block, of the rows that it changed (half precision); the state of training stays as it was."""
    words, targets, others = model.rows
    at = {WORDS: 0, TARGETS: 0}
    for block, lo, *old in _blocks_of(shared, v, d):
        for part, new, was in zip((WORDS, TARGETS), (words, targets), old, strict=True):
            rows = np.flatnonzero(seen[part][lo:lo + len(was)])
            mine = new[at[part]:at[part] + len(rows)]
            at[part] += len(rows)
            yield from _change_rows(block, part, shard, mine[:, :-1] - was[rows, :-1], pieces, rows, len(was))
    last = _last(shared, d)
    rest = [words[-2:] - last[0], targets[-1:] - last[1], others - last[2]]
    rest[0][:, -1] = rest[1][:, -1] = 0
    for x in model.states():
        rest[2][x] = 0
    yield from _change_rows(-1, REST, shard, np.concatenate([x.ravel() for x in rest]).reshape(1, -1), pieces)


def _edges(shape: tuple[int, int], pieces: int) -> np.ndarray:
    """Where pieces of about equal size of a block begin, and its end: rows, or the columns of one row."""
    return np.linspace(0, max(shape) if shape[0] == 1 else shape[0], pieces + 1).astype(np.int64)


def _piece(table: np.ndarray, piece: int, pieces: int) -> np.ndarray:
    lo, hi = _edges(table.shape, pieces)[piece:piece + 2]
    return table[:, lo:hi] if len(table) == 1 else table[lo:hi]


def _change_rows(block: int, part: int, shard: int, change: np.ndarray, pieces: int, at: np.ndarray | None = None, n: int = 0) -> Iterator[pa.RecordBatch]:
    """``change`` by pieces of a block: of the block's rows, or of its rows ``at``, rising, of ``n``."""
    at = np.arange(len(change)) if at is None else at
    edges = _edges((n or len(change), change.shape[1]), pieces)
    cuts = np.searchsorted(at, edges)
    for piece in range(pieces):
        own = _piece(change, piece, pieces) if part == REST else change[cuts[piece]:cuts[piece + 1]]
        moved = np.zeros(1, np.int64) if part == REST else np.flatnonzero(own.any(1))
        rows = moved if part == REST else at[cuts[piece] + moved] - edges[piece]
        yield pa.record_batch([pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([piece], pa.int32()), pa.array([shard], pa.int64()),
                               _bytes(rows.astype(np.int32).tobytes()), _bytes(np.ascontiguousarray(own[moved], np.float16).tobytes())], names=["block", "part", "piece", "shard", "rows", "change"])


def _learner(words: Shared, rest: float, shared: Shared, d: int, often: float, seed: int, pieces: int = 1):
    """How each shard's training tokens change the model.  A word of more than
    ``often`` tokens has part of them drawn, which then count as many times as
    they stand for.  A shard's chunks lie in one file and come together: first
    the rows that all of them need are found, then the model of these learns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = next(batches := iter(batches), None)
        if begin is None:  # a file of shards that learn at another time
            return
        v = Vocabulary(words, rest)
        over = group_bounds(v.mass)
        shard, held, seen, rng = None, [], None, None

        def learned() -> Iterator[pa.RecordBatch]:
            mine, numbers = LogBilinear.of_some(_parts_of(shared, v, d), seen, d, v.bounds, over, v.mass), _numbers(seen)
            for grams, weights, state in held:
                rng.bit_generator.state = state
                mine.learn(grams, weights, rng, numbers)
            held.clear()
            del numbers
            yield from _changed(mine, seen, shared, v, d, shard, pieces)

        for batch in chain([begin], batches):
            for row in range(batch.num_rows):
                now = batch.column("chunk")[row].as_py() >> 32
                if now != shard:
                    if held:
                        yield from learned()
                    shard, seen, rng = now, _seen(v), np.random.default_rng([seed, now])
                grams, times = _trigrams(batch, row, v)
                keep = np.minimum(1.0, np.sqrt(often / times))
                pick = np.flatnonzero(rng.random(len(grams[0])) < keep)
                rng.shuffle(pick)
                grams = tuple(g[pick] for g in grams)
                held.append((grams, (1 / keep[pick]).astype(np.float32), rng.bit_generator.state))
                _see(seen, v, over, grams, rng)
        if held:
            yield from learned()
    return run


def _added(table: pa.Table, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of the changes of a piece's rows, by shards in order, and how many shards changed each row."""
    total, count = np.zeros(shape, np.float32), np.zeros(shape[0], np.int32)
    shards = table.column("shard").to_numpy()
    for i in np.argsort(shards, kind="stable"):
        rows, change = (np.frombuffer(table.column(name)[int(i)].as_buffer(), kind) for name, kind in (("rows", np.int32), ("change", np.float16 if shards[i] >= 0 else np.float32)))
        if shards[i] >= 0:
            total[rows] += change.reshape(len(rows), shape[1])
            count[rows] += 1
        else:  # the sums of shards before, and their numbers
            total[rows] = change[:len(rows) * shape[1]].reshape(len(rows), shape[1])
            count[rows] = change[len(rows) * shape[1]:].view(np.int32)
    return total, count


def _key(table: pa.Table) -> tuple[int, int, int]:
    return tuple(table.column(x)[0].as_py() for x in ("block", "part", "piece"))


def _piece_of(shared: Shared, d: int, pieces: int, block: int, part: int, piece: int) -> np.ndarray:
    was = np.frombuffer(_read(shared.blocks[part, block]), np.float32)
    return _piece(was.reshape(1, -1) if part == REST else was.reshape(-1, d + 1 if part == WORDS else d + 2), piece, pieces)


def _summed(shared: Shared, d: int, pieces: int):
    """The sums of the changes so far of a piece of a block, as the change of a shard -1."""
    def run(table: pa.Table) -> pa.Table:
        block, part, piece = _key(table)
        n, width = _piece_of(shared, d, pieces, block, part, piece).shape
        total, count = _added(table, (n, width - (part != REST)))
        rows = np.flatnonzero(count)
        return pa.table({"block": table.column("block")[:1], "part": table.column("part")[:1], "piece": table.column("piece")[:1], "shard": pa.array([-1], pa.int64()),
                         "rows": _bytes(rows.astype(np.int32).tobytes()), "change": _bytes(total[rows].tobytes() + count[rows].tobytes())})
    return run


def _averaged(shared: Shared, d: int, pieces: int):
    """New parameters of a piece of a block: each row moved by the mean of the shards that changed it."""
    def run(table: pa.Table) -> pa.Table:
        block, part, piece = _key(table)
        data = _piece_of(shared, d, pieces, block, part, piece).copy()
        moved = data if part == REST else data[:, :-1]  # all but the state of training
        total, count = _added(table, moved.shape)
        moved += total / np.maximum(count, 1)[:, None]
        return pa.table({"block": table.column("block")[:1], "part": table.column("part")[:1], "piece": table.column("piece")[:1], "data": _bytes(data.tobytes())})
    return run


def _whole(table: pa.Table) -> pa.Table:
    """A block of its pieces."""
    order = np.argsort(table.column("piece").to_numpy())
    return pa.table({"block": table.column("block")[:1], "part": table.column("part")[:1], "data": _bytes(b"".join(table.column("data")[int(i)].as_py() for i in order))})


def fit(chunks: DataFrame, words: Shared, rest: float, tokens: float, shards: int, d: int = 16, first: int = 1_000_000, seed: int = 13) -> Shared:
    """Blocks of a model trained on all training tokens of ``chunks``, which are of so many ``shards``; about ``first`` tokens fix the space."""
    spark = chunks.sparkSession
    texts = chunks.select("chunk", "uniq", "tok", "n_tokens", "train")
    some = texts.mapInArrow(_sample(words, rest, min(1.0, first / max(tokens, 1))), "two int, one int, w int")
    some = some.unionByName(spark.createDataFrame([(-1, -1, -1)], some.schema))
    # A bounded sample, in an order of its own.
    begun = some.repartition(1).sortWithinPartitions("two", "one", "w").mapInArrow(_first(words, rest, d, first, seed), _BLOCKS)
    model = Shared().taken(spark, stored(begun, "model", BLOCK_ROWS))
    pieces = math.ceil(shards / SHARDS_A_BLOCK)
    learner, before = _learner(words, rest, model, d, max(3e-6 * tokens, 100.0), seed, pieces), None
    for lo in range(0, shards, SHARDS_AT_ONCE):
        hi = lo + SHARDS_AT_ONCE
        some = texts.filter(F.col("chunk") >= lo << 32) if lo else texts
        some = some.filter(F.col("chunk") < hi << 32) if hi < shards else some
        changes = some.mapInArrow(learner, _CHANGES)
        changes = (changes.unionByName(before) if before is not None else changes).groupBy("block", "part", "piece")
        if hi < shards:
            was, before = before, stored(changes.applyInArrow(_summed(model, d, pieces), _CHANGES), "changes", BLOCK_ROWS * pieces)
            if was is not None:
                _remove(was)
    learned = changes.applyInArrow(_averaged(model, d, pieces), "block long, part int, piece int, data binary")
    if pieces > 1:
        learned = learned.groupBy("block", "part").applyInArrow(_whole, _BLOCKS)
    learned = stored(learned.select("block", "part", "data"), "model", BLOCK_ROWS)
    if before is not None:
        _remove(before)
    changed = {(x.part, x.block) for x in learned.select("part", "block").collect()}  # 16 bytes a block
    for key in changed:
        model.blocks[key].destroy()
    return Shared({key: block for key, block in model.blocks.items() if key not in changed}).taken(spark, learned)


def _scores(vocabulary: Shared, shared: Shared, d: int, total: int, types: int, rest: tuple[float, float, float]):
    """``doc_id, train, n_tokens, n_known, base_score, score`` of the chunks joined with their answers."""
    discount, rest_total, rest_types = rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(vocabulary, rest_total)
        model = _fitted(shared, v, d)
        k = len(model.targets)
        for batch in batches:
            for row in range(batch.num_rows):
                parts = batch.column("answers")[row].values
                order = np.argsort(parts.field("r").to_numpy(), kind="stable")
                lists, uniq = parts.field("c"), _words_of(batch, row)
                c = np.empty(len(uniq), np.int64)
                c[np.argsort(uniq)] = np.concatenate([_unpacked(lists[int(x)].as_buffer()) for x in order])
                word_of = v.ids_of(uniq)  # k - 1 below the floor
                base_of = np.log10((c + 1.0) / (total + types + 1))
                # The share of the words below the floor: 1 for one of the vocabulary.
                with np.errstate(divide="ignore"):
                    unseen = discount * rest_types / rest_total if rest_types else 1.0
                    own = np.where(c > 0, np.log10(np.maximum(c - discount, 1e-9) / max(rest_total, 1)), math.log10(unseen))
                own[word_of < k - 1] = 0.0
                tok, n = _unpacked(batch.column("tok")[row].as_buffer(), np.int32), _flat(batch, "n_tokens", row).astype(np.int64)
                words = word_of[tok]
                score = model.log_probability((*_contexts(words, n, k), words)) + own[tok]
                first = np.cumsum(n) - n
                yield pa.record_batch([batch.column("doc_ids")[row].values, batch.column("train")[row].values, pa.array(n), pa.array(np.add.reduceat((c > 0)[tok].astype(np.int64), first)),
                                       pa.array(np.add.reduceat(base_of[tok], first)), pa.array(np.add.reduceat(score, first))], names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])
    return run


def score(docs: DataFrame, train_col, floor: int = 5, most_words: int = 8_000_000, shard_bytes: int = 32 << 20, d: int = 16) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score``, a row per input row.

    Learns from the rows where ``train_col`` holds (null: it doesn't).  A null
    text is empty and has the end token alone.  Repeated rows count and are
    scored each; null ids are kept; other columns are ignored.  If more than
    ``most_words`` words reach the floor, it rises for the rarest of them,
    which then get their shares of the counts like those below it.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(train_col, F.lit(False)).alias("train"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    # Dealt by a hash of the row, in its order: the same shards on any cluster.
    dealt = (texts.withColumn("by", F.xxhash64("doc_id", "text")).repartition(shards, "by")
             .sortWithinPartitions("by").drop("by"))
    with _with(spark, TIDY):
        chunks = stored(dealt.mapInArrow(_chunks, _CHUNK.format(kind=kind)), "chunks", compression="zstd")
    with _with(spark, TIDY | FEW):
        return _of_chunks(chunks, kind, shards, floor, most_words, d)


def _of_chunks(chunks: DataFrame, kind: str, shards: int, floor: int, most_words: int, d: int) -> DataFrame:
    spark = chunks.sparkSession
    entries = chunks.agg(F.sum("n_uniq")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(entries, 1) / RANGE_ENTRIES)))
    answers = stored(chunks.select("chunk", "uniq", "cnt").mapInArrow(_requests(bits), "r long, chunk long, h binary, n binary")
                     .groupBy("r").applyInArrow(_answer(floor), "chunk long, r long, c binary, sums array<long>, h binary"), "answers")
    sums = answers.filter("chunk < 0")
    types, total, once, twice = (int(x or 0) for x in sums.agg(*[F.sum(F.get("sums", F.lit(i))) for i in range(4)]).first())
    frequent = sums.select("h", "c")
    buckets = (frequent.mapInArrow(_buckets, "bucket long, words long, tokens long").groupBy("bucket")
               .agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).collect())  # a row a bucket, under 1,100 for any counts
    classes = Classes.planned({x.bucket: x.words for x in buckets}, {x.bucket: x.tokens for x in buckets}, total, most_words)
    placed = frequent.mapInArrow(_placed(classes), "block long, cls long, h long, c long")
    words = _vocabulary(stored(placed.groupBy("block").applyInArrow(_block_row, _BLOCKS), "vocabulary", BLOCK_ROWS))
    # The words below the floor: their tokens, their types, and the discount that unseen words share.
    kept = [x for x in buckets if x.bucket >= classes.lowest]
    known = sum(x.words for x in kept)
    rest_total, rest_types = total - sum(x.tokens for x in kept), types - known
    discount = min(0.9, max(0.1, once / max(once + 2 * twice, 1))) if rest_types else 0.0
    model = fit(chunks, words, rest_total, total, shards, d)
    replies = answers.filter("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("r", "c")).alias("answers"))
    rows = chunks.select("chunk", "doc_ids", "train", "n_tokens", "tok", "uniq").join(replies, "chunk")
    scored = rows.mapInArrow(_scores(words, model, d, total, types, (discount, rest_total, rest_types)), f"doc_id {kind}, train boolean, n_tokens long, n_known long, base_score double, score double")
    return stored(scored, "scores").withColumn("train_tokens", F.lit(total).cast("long"))


def lm_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``:
    learns where crc32(id) mod 7 is not 2 (a null id teaches, too)."""
    held_out = crc_mod("doc_id", 7) == 2
    return score(docs, ~held_out).select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
