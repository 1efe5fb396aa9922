"""Language identification by a byte convolutional network.

Filters of several widths slide over the bytes of fixed-length windows; the
largest response of each filter in a window (max pooling) goes through a
linear layer and a softmax.  A filter over one-hot bytes is a table per place,
so convolution is adding table rows; at prediction two places share a table of
byte pairs.  A document's distribution is the mean of its windows', weighted
by their lengths; every byte of the text is read.

Trained in numpy with Adam on a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm._spark import bounded_sample, crc_mod
from keyfold.llm._words import text_bytes

LENGTH = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass
class ByteCNN:
    languages: list[str]
    tables: list[np.ndarray]  # per width: places x 256 x filters
    shift: np.ndarray  # per filter, all widths
    out: np.ndarray
    bias: np.ndarray

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest response, its place) of windows ``x`` (n, LENGTH) of bytes."""
        best, place = [], []
        for width, table in zip(WIDTHS, self.tables, strict=True):
            n = x.shape[1] - width + 1
            pre = table[0][x[:, :n]]
            for j in range(1, width):
                pre = pre + table[j][x[:, j:j + n]]
            place.append(pre.argmax(1))
            best.append(pre.max(1))
        return np.concatenate(best, 1) + self.shift, np.concatenate(place, 1)

    def pairs(self) -> list[list[np.ndarray]]:
        """The tables by byte pairs, an odd last place by its byte."""
        return [[(t[j][:, None] + t[j + 1][None]).reshape(65536, -1) if j + 1 < len(t) else t[j] for j in range(0, len(t), 2)] for t in self.tables]

    def probabilities(self, x: np.ndarray, pairs: list[list[np.ndarray]]) -> np.ndarray:
        codes = (x[:, :-1].astype(np.int64) << 8) | x[:, 1:]
        best = []
        for width, tables in zip(WIDTHS, pairs, strict=True):
            n = x.shape[1] - width + 1
            pre = None
            for j, table in enumerate(tables):
                part = table.take(codes[:, 2 * j:2 * j + n] if len(table) > 256 else x[:, 2 * j:2 * j + n], axis=0)
                pre = part if pre is None else np.add(pre, part, out=pre)
            best.append(pre.max(1))
        z = np.maximum(np.concatenate(best, 1) + self.shift, 0) @ self.out + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train(windows: np.ndarray, target: np.ndarray, languages: list[str], steps: int = 400, batch: int = 192, rate: float = 0.02, seed: int = 11) -> ByteCNN:
    rng = np.random.default_rng(seed)
    m = FILTERS * len(WIDTHS)
    model = ByteCNN(languages, [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS], np.zeros(m, np.float32),
                    rng.normal(0, m ** -0.5, (m, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    for t in model.tables:
        t[:, 0] = 0  # padding
    params = [*model.tables, model.shift, model.out, model.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    groups = [np.flatnonzero(target == c) for c in range(len(languages))]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(g, max(1, batch // len(groups))) for g in groups if len(g)])
        x, y = windows[pick], target[pick]
        best, place = model.pooled(x)
        act = np.maximum(best, 0)
        z = act @ model.out + model.bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        d = (p @ model.out.T) * (best > 0)
        grads = []
        for k, (width, table) in enumerate(zip(WIDTHS, model.tables, strict=True)):
            g, cols = np.zeros_like(table), slice(k * FILTERS, (k + 1) * FILTERS)
            filters = np.broadcast_to(np.arange(FILTERS), (len(y), FILTERS))
            for j in range(width):  # the gradient reaches the pooled place alone
                np.add.at(g[j], (x[np.arange(len(y))[:, None], place[:, cols] + j], filters), d[:, cols])
            g[:, 0] = 0
            grads.append(g + 1e-5 * table)
        grads += [d.sum(0), act.T @ p + 1e-4 * model.out, p.sum(0)]
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, a, b in zip(params, grads, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return model


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, their text, their bytes): each text in pieces of ``LENGTH``, the last padded with 0."""
    n = np.diff(offsets)
    pieces = -(-n // LENGTH)
    of = np.repeat(np.arange(len(n)), pieces)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    length = np.minimum(n[of] - nth * LENGTH, LENGTH)
    at = (offsets[of] + nth * LENGTH)[:, None] + np.arange(LENGTH)
    inside = np.arange(LENGTH) < length[:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))], 0) if len(of) else np.zeros((0, LENGTH), np.uint8), of, length


def fit(docs: DataFrame, train_col, max_rows: int = 4000, max_bytes: int = 16 << 20) -> ByteCNN | None:
    """From ``text, lang`` of a bounded sample of the labelled rows where
    ``train_col`` holds, whole texts, copies counted once; None without any.

    Languages share the bounds equally: one with few rows keeps them all.
    """
    known = docs.filter(F.col("lang").isNotNull() & train_col & (F.length("text") > 0)).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = bounded_sample(known, ["text", "lang"], max_rows, max_bytes, by="lang").distinct().toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["lang", "text"], ignore_index=True)
    languages = sorted(rows["lang"].unique())
    data, offsets = text_bytes(pa.array(rows["text"], pa.large_string()))
    x, of, length = cut(data, offsets)
    keep = length >= min(32, int(length.max()))
    target = rows["lang"].map({c: i for i, c in enumerate(languages)}).to_numpy()[of]
    return train(x[keep], target[keep], languages)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_LETTER[data])])
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    for t in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[t] = any(map(str.isalpha, data[offsets[t]:offsets[t + 1]].tobytes().decode("utf-8", "replace")))
    return found


def predict(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """``doc_id, lang_pred, score``, a row per input row.

    ``und`` with score 0 if the text is null, has no letter, or nothing was
    learned.  Null and repeated ids are kept; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = model.pairs() if model else []
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            n = batch.num_rows
            names, scores = np.array(["und"] * n, object), np.zeros(n)
            if model:
                sums, weight = np.zeros((n, len(model.languages))), np.zeros(n)
                # Pieces of at most 8 MB, cut at windows' ends.
                starts, ends, texts = offsets[:-1], offsets[1:], np.arange(n)
                lo = 0
                while lo < n:
                    hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 23), "right")) - 1)
                    for at in range(int(starts[lo]), max(int(ends[hi - 1]), int(starts[lo]) + 1), 1 << 23):
                        part = np.clip(offsets[lo:hi + 1], at, at + (1 << 23))
                        x, of, length = cut(data[at:at + (1 << 23)], part - at)
                        for k in range(0, len(x), 512):
                            p = model.probabilities(x[k:k + 512], pairs) * length[k:k + 512, None]
                            np.add.at(sums, texts[lo:hi][of[k:k + 512]], p)
                            np.add.at(weight, texts[lo:hi][of[k:k + 512]], length[k:k + 512])
                    lo = hi
                own = _has_letter(data, offsets)
                best = sums.argmax(1)
                names[own] = np.array(model.languages, object)[best[own]]
                scores[own] = (sums[np.arange(n), best] / np.maximum(weight, 1))[own]
            yield pa.record_batch([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.clip(scores, 0, 1))], names=["doc_id", "lang_pred", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned where crc32(id) mod 4 is not 2."""
    model = fit(docs, crc_mod("doc_id", 4).isin(0, 1, 3))
    return predict(docs, model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
