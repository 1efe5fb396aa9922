"""Quality by histogram gradient-boosted trees over document statistics.

Statistics of whole texts are array sums over a batch's bytes, words and
lines.  Trees of fixed depth are grown in numpy on binned statistics and
flattened: node ``i`` of a tree has its children at ``2i + 1`` and ``2i + 2``,
so a batch walks all levels by array indexing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm._spark import crc_mod
from keyfold.llm._words import shingle_hashes, slices, text_bytes, word_hashes
from keyfold.llm.toxicity import labelled_sample

_LINE = np.zeros(256, bool)
_LINE[10] = True


def _class(*chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    for c in chars:
        out[list(c)] = True
    return out


#: Byte classes whose shares are statistics.
_CLASSES = [_class(bytes(range(97, 123))), _class(bytes(range(65, 91))), _class(b"0123456789"), _class(b" \t\r\f\v"), _class(b"\n"), _class(b".,;:?'\"()-"),
            _class(b"!"), _class(b"|"), _class(b"#$%&*@^~<>=+/\\_`{}[]"), _class(bytes(range(128, 256)))]
NAMES = ["log_bytes", "lower", "upper", "digit", "space", "newline", "punctuation", "shout", "bar", "symbol", "non_ascii",
         "log_words", "word_bytes", "long_words", "short_words", "distinct_words", "distinct_shingles", "distinct_lines", "line_words"]


def _distinct(h: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(all, distinct) hashes of each text."""
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    return np.bincount(of, minlength=n), np.bincount(of[new], minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, statistics) in the order of ``NAMES``; an empty text has zeros."""
    n, size = len(offsets) - 1, np.diff(offsets)
    one = np.maximum(size, 1)
    # counts of each byte value, text by text, without a copy per class
    table = np.zeros((n, 256))
    for t in range(n):
        table[t] = np.bincount(data[offsets[t]:offsets[t + 1]], minlength=256)
    out = [np.log1p(size), *[table[:, c].sum(1) / one for c in _CLASSES]]
    h, of, s, e = word_hashes(data, offsets)
    words, kinds = _distinct(h, of, n)
    some = np.maximum(words, 1)
    length = e - s
    out += [np.log1p(words), np.bincount(of, length, n) / some, np.bincount(of, length > 12, n) / some, np.bincount(of, length <= 3, n) / some, kinds / some]
    runs, run_kinds = _distinct(*shingle_hashes(h, of, n), n)
    lines, line_kinds = _distinct(*word_hashes(data, offsets, _LINE)[:2], n)
    out += [run_kinds / np.maximum(runs, 1), line_kinds / np.maximum(lines, 1), np.log1p(words / np.maximum(lines, 1))]
    return np.column_stack(out)


@dataclass
class Forest:
    """Flattened trees: (trees, nodes) of statistics and limits, (trees, leaves) of values."""

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    start: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        depth = (self.value.shape[1] - 1).bit_length()
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - (len(value) - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0, least: float = 3.0) -> Forest:
    """Second-order boosting of the logistic loss; a node without a split sends
    all rows left.  Without both labels the forest has no tree."""
    rate0 = (y.sum() + 0.5) / (len(y) + 1)
    start, nodes, leaves = float(np.log(rate0 / (1 - rate0))), 2 ** depth - 1, 2 ** depth
    features, limits, values = [], [], []
    if len(np.unique(y)) > 1:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
        total = np.full(len(y), start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            g, h = p - y, p * (1 - p)
            node, feature, limit = np.zeros(len(y), np.int64), np.zeros(nodes, np.int64), np.full(nodes, np.inf)
            for level in range(depth):
                first, width = 2 ** level - 1, 2 ** level
                at = node - first
                gain, which, cut_at = np.zeros(width), np.zeros(width, np.int64), np.full(width, -1)
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    cell = at * bins + binned[f]
                    sg = np.bincount(cell, g, width * bins).reshape(width, bins).cumsum(1)
                    sh = np.bincount(cell, h, width * bins).reshape(width, bins).cumsum(1)
                    tg, th = sg[:, -1:], sh[:, -1:]
                    score = sg ** 2 / (sh + ridge) + (tg - sg) ** 2 / (th - sh + ridge) - tg ** 2 / (th + ridge)
                    score[(sh < least) | (th - sh < least)] = 0
                    score = score[:, :len(c)]
                    top = score.argmax(1)
                    better = score[np.arange(width), top] > gain + 1e-9
                    gain[better], which[better], cut_at[better] = score[np.arange(width), top][better], f, top[better]
                for k in np.flatnonzero(cut_at >= 0):
                    feature[first + k], limit[first + k] = which[k], cuts[which[k]][cut_at[k]]
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > limit[node])
            leaf = node - nodes
            value = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
            total += value[leaf]
            features.append(feature)
            limits.append(limit)
            values.append(value)
    shape = (len(features), -1)
    return Forest(np.array(features, np.int64).reshape(*shape) if features else np.zeros((0, nodes), np.int64),
                  np.array(limits).reshape(*shape) if features else np.zeros((0, nodes)), np.array(values).reshape(*shape) if features else np.zeros((0, leaves)), start)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for i, j in slices(offsets):
            x = statistics(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.record_batch([batch.column("label")[i:j].cast(pa.int32()), pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))], names=["label", "x"])


def fit(sample: DataFrame) -> Forest:
    """From ``text, label`` rows (a bounded sample); their statistics alone reach the driver."""
    rows = sample.select("text", "label").mapInArrow(_measured, "label int, x array<double>").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(NAMES))
    order = np.lexsort(x.T)  # the same trees whatever order the rows come in
    return grow(x[order], rows["label"].to_numpy(float)[order])


def score(docs: DataFrame, forest: Forest, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted``, a row per input row.

    Null and empty texts have statistics of zero.  Null and repeated ids are
    kept; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets):
                p = forest.probability(statistics(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
                yield pa.record_batch([batch.column("doc_id")[i:j], pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> DataFrame:
    """``doc_id, held_out, score, predicted``: fitted on about ``max_rows``
    labelled rows with crc32(id) mod 4 not 2."""
    forest = fit(labelled_sample(docs, labels, "quality", crc_mod("doc_id", 4).isin(0, 1, 3), max_rows))
    return score(docs, forest).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
