"""Toxicity by maximum-scoring segments of token log-odds.

* A token is a word or one of its first 4, 5 or 6 bytes (stems).  Its score is
  the log-odds of toxic against clean documents under a Dirichlet prior
  proportional to its overall frequency; tokens whose log-odds are
  significantly positive form the lexicon, every other word costs ``BETA``.
* One linear scan per text finds all maximal-scoring segments (passages).
* Extreme-value statistics of the scores of clean text, lambda and K, turn a
  segment's score into the number of equally good segments expected by chance
  in a clean text of that length; significances add up to the document's
  evidence, which a two-weight logistic curve maps to a probability.

The model is fitted on a bounded sample of labelled rows (``max_rows``) and
has at most ``max_terms`` entries, whatever the corpus size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm._spark import crc_mod, stored
from keyfold.llm._words import PUNCT, slices, text_bytes, word_hashes

PREFIXES = (4, 5, 6)
#: What a word outside the lexicon costs a passage.
BETA = 0.05


@dataclass(frozen=True)
class ToxicityModel:
    terms: np.ndarray  # sorted hashes
    scores: np.ndarray
    lam: float
    k: float
    weights: np.ndarray  # bias, best significance, total significance

    def probability(self, best: np.ndarray, total: np.ndarray) -> np.ndarray:
        x = self.weights[0] + self.weights[1] * best + self.weights[2] * total
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _tokens(data: np.ndarray, offsets: np.ndarray):
    h, of, s, e, *short = word_hashes(data, offsets, PUNCT, PREFIXES)
    return np.stack([h, *short]), of, s, e


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, max_rows: int) -> DataFrame:
    """``doc_id, text, label`` of about ``max_rows`` labelled rows (all, if there
    are fewer), chosen by a hash of the id among those where ``train`` holds.

    Rows with a null id, null text or a label other than 0 and 1 teach nothing
    and are left out; rows that repeat an id, text and label count once; other
    columns are ignored.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & train)
    n = known.count()
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < math.ceil(min(1.0, max_rows / max(n, 1)) * (1 << 30)))
    return docs.select("doc_id", "text").filter("text is not null").join(known, "doc_id").dropDuplicates(["doc_id", "text", "label"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``token, toxic, clean``: texts of either label that have the token."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        labels = batch.column("label").to_numpy()
        for i, j in slices(offsets):
            tokens, of, _, _ = _tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            flat, texts = tokens.ravel(), np.tile(of, len(tokens))
            order = np.lexsort((texts, flat))
            flat, texts = flat[order], texts[order]
            once = np.ones(len(flat), bool)
            once[1:] = (flat[1:] != flat[:-1]) | (texts[1:] != texts[:-1])
            once &= flat != 0
            token, inverse = np.unique(flat[once], return_inverse=True)
            toxic = np.bincount(inverse, labels[i:j][texts[once]], len(token))
            n = np.bincount(inverse, minlength=len(token))
            yield pa.record_batch([pa.array(token.view(np.int64)), pa.array(toxic.astype(np.int64)), pa.array((n - toxic).astype(np.int64))], names=["token", "toxic", "clean"])


def _lexicon(toxic: np.ndarray, clean: np.ndarray, prior: float, z_min: float) -> tuple[np.ndarray, np.ndarray]:
    """(chosen, log-odds) under a Dirichlet prior of ``prior`` times all counts."""
    n1, n0 = toxic.sum(), clean.sum()
    alpha = prior * (toxic + clean)
    prior = alpha.sum()
    with np.errstate(divide="ignore", invalid="ignore"):  # tokens that nothing has
        odds = (np.log((toxic + alpha) / (n1 + prior - toxic - alpha)) - np.log((clean + alpha) / (n0 + prior - clean - alpha)))
        z = odds / np.sqrt(1 / (toxic + alpha) + 1 / (clean + alpha))
    return z >= z_min, odds


def segments(at: list[int], score: list[float], n: int) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(first, last, score)`` of a text of ``n``
    words, given its positive words; linear in their number."""
    total, stack = 0.0, []  # of (first, last, sum before it, sum to its end, last smaller)
    before = -1
    for i, s in zip(at, score, strict=True):
        total -= BETA * (i - before - 1)
        before = i
        left, total = total, total + s
        first, last, right = i, i, total
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((first, last, left, right, j))
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, r - le) for a, b, le, r, _ in stack]


def _hits(model: ToxicityModel, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, score) of the words that have a lexicon entry."""
    if not len(model.terms):
        return np.zeros(0, np.int64), np.zeros(0)
    mask = np.uint64((1 << 20) - 1)
    sieve = np.zeros(1 << 20, bool)
    sieve[(model.terms & mask).astype(np.int64)] = True
    best = np.zeros(tokens.shape[1])
    for row in tokens:
        may = np.flatnonzero(sieve[(row & mask).astype(np.int64)])
        place = np.minimum(np.searchsorted(model.terms, row[may]), len(model.terms) - 1)
        yes = model.terms[place] == row[may]
        best[may[yes]] = np.maximum(best[may[yes]], model.scores[place[yes]])
    at = np.flatnonzero(best)
    return at, best[at]


def _scan(model: ToxicityModel, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, list]]:
    """(text number, its words, its segments with first and end byte) where a word scores."""
    tokens, of, s, e = _tokens(data, offsets)
    at, score = _hits(model, tokens)
    counts = np.bincount(of, minlength=len(offsets) - 1)
    start = np.cumsum(counts) - counts
    text = of[at]
    bounds = np.flatnonzero(np.diff(text, prepend=-1, append=-1))
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        t = int(text[lo])
        found = segments((at[lo:hi] - start[t]).tolist(), score[lo:hi].tolist(), int(counts[t]))
        yield t, int(counts[t]), [(int(s[start[t] + a] - offsets[t]), int(e[start[t] + b] - offsets[t]), x) for a, b, x in found]


def _significance(model: ToxicityModel, score: float, n: int) -> float:
    """-ln of the segments as good that clean text of ``n`` words has by chance, 0 at least."""
    return max(0.0, model.lam * score - math.log(model.k * max(n, 1)))


def _evidence(model: ToxicityModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    best, total, passages = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64)
    for t, n, found in _scan(model, data, offsets):
        each = [_significance(model, x, n) for _, _, x in found]
        best[t], total[t], passages[t] = max(each), math.log1p(sum(each)), sum(x > 0 for x in each)
    return best, total, passages


def _scorer(model: ToxicityModel, threshold: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets):
                best, total, passages = _evidence(model, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                p = model.probability(best, total)
                yield pa.record_batch([batch.column("doc_id")[i:j], pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(passages)],
                                      names=["doc_id", "score", "predicted", "passages"])
    return score


def _chances(model: ToxicityModel, floor: float):
    """Per text: label, words, segments of at least ``floor``, to calibrate."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets):
                own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                n, found = np.bincount(word_hashes(*own, PUNCT)[1], minlength=j - i), np.zeros(j - i, np.int64)
                for t, _, each in _scan(model, *own):
                    found[t] = sum(x >= floor for _, _, x in each)
                yield pa.record_batch([batch.column("label")[i:j].cast(pa.int32()), pa.array(n.astype(np.int64)), pa.array(found)], names=["label", "n", "found"])
    return count


def _weighed(model: ToxicityModel):
    """Per text: label and evidence."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets):
                best, total, _ = _evidence(model, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                yield pa.record_batch([batch.column("label")[i:j].cast(pa.int32()), pa.array(best), pa.array(total)], names=["label", "best", "total"])
    return weigh


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (bias first) by damped Newton steps with a ridge penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - (y * z).sum() + (penalty * w * w).sum() / 2)

    now = loss(w)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > now:
            size /= 2
        w = w + size * step
        before, now = now, loss(w)
        if before - now < 1e-9:
            break
    return w


def fit(sample: DataFrame, max_terms: int = 20_000, min_docs: int = 4, prior: float = 0.05, z_min: float = 3.7, odds_min: float = 3.0) -> ToxicityModel:
    """The model from ``text, label`` rows (a bounded sample).

    Without rows of both labels the lexicon is empty and every text gets the
    rate of label 1 (one half without rows).
    """
    # Exact copies would make the words of one text look frequent.
    # A text with both labels has the more frequent one, 1 in a tie.
    sample = stored(sample.groupBy("text").agg((2 * F.sum("label") >= F.count("label")).cast("int").alias("label")), "labelled")
    counted = sample.mapInArrow(_count, "token long, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # Rare tokens and those never in a toxic text can't enter the lexicon; their mass stays in the totals.
    counted = stored(counted, "tokens")
    n1, n0 = counted.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    rows = counted.filter(F.col("toxic") >= min_docs).toPandas()
    toxic, clean = (np.append(rows[c].to_numpy(np.float64), n) for c, n in (("toxic", max(n1 - rows["toxic"].sum(), 0)), ("clean", max(n0 - rows["clean"].sum(), 0))))
    chosen, odds = _lexicon(toxic, clean, prior, z_min)
    chosen[-1] = False
    chosen &= odds >= odds_min
    if not n1 or not n0:
        chosen[:] = False
    order = np.argsort(-odds[:-1] * np.sqrt(toxic[:-1]), kind="stable")
    keep = order[chosen[:-1][order]][:max_terms]
    terms, scores = rows["token"].to_numpy(np.int64).view(np.uint64)[keep], odds[keep]
    order = np.argsort(terms)
    # lambda: the root of sum(p * exp(lambda * score)) = 1 over a clean word's scores.
    p = (clean[keep] + 0.5) / (clean.sum() + 0.5 * len(keep) + 1)
    rest = max(1 - p.sum(), 1e-6)
    lo, hi = 1e-3, 50.0
    for _ in range(100):
        mid = (lo + hi) / 2
        value = (p * np.exp(np.minimum(mid * scores, 600))).sum() + rest * math.exp(-BETA * mid)
        lo, hi = (mid, hi) if value < 1 else (lo, mid)
    lam = min(max(lo, 0.05), 5.0)
    model = ToxicityModel(terms[order], scores[order], lam, 1.0, np.zeros(3))
    floor = float(scores.min()) if len(scores) else 1.0
    clean_texts = sample.mapInArrow(_chances(model, floor), "label int, n long, found long").filter("label = 0")
    words, chance = (int(x or 0) for x in clean_texts.agg(F.sum("n"), F.sum("found")).first())
    k = (1 + chance) / (1 + words) * math.exp(lam * floor)
    model = ToxicityModel(model.terms, model.scores, lam, k, model.weights)
    rows = sample.mapInArrow(_weighed(model), "label int, best double, total double").toPandas()
    weights = _logistic(rows[["best", "total"]].to_numpy(np.float64), rows["label"].to_numpy(np.float64)) if len(rows) else np.zeros(3)
    return ToxicityModel(model.terms, model.scores, lam, k, weights)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``doc_id, score, predicted, passages`` (significant ones), a row per input row.

    A null or empty text has no passage and gets the score of one without.
    Null and repeated ids are kept as they are; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_scorer(model, threshold), f"doc_id {kind}, score double, predicted int, passages long")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``docs``, all columns, without the rows whose score reaches the threshold."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets):
                best, total, _ = _evidence(model, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                yield batch.slice(i, j - i).filter(pa.array(model.probability(best, total) < threshold))
    return docs.mapInArrow(keep, docs.schema)


def toxic_passages(docs: DataFrame, model: ToxicityModel, significance: float = 3.0) -> DataFrame:
    """``doc_id, first, end, passage, score, significance``: every passage with
    at least that significance; ``first`` and ``end`` are UTF-8 byte places."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets):
                own, ends = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                out: list[list] = [[], [], [], [], [], []]
                for t, n, found in _scan(model, own, ends):
                    for a, b, x in found:
                        if (sig := _significance(model, x, n)) >= significance:
                            for column, v in zip(out, (batch.column("doc_id")[i + t].as_py(), a, b, own[ends[t] + a:ends[t] + b].tobytes().decode(), x, sig), strict=True):
                                column.append(v)
                yield pa.record_batch([pa.array(out[0], batch.schema.field("doc_id").type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                       pa.array(out[3], pa.string()), pa.array(out[4], pa.float64()), pa.array(out[5], pa.float64())],
                                      names=["doc_id", "first", "end", "passage", "score", "significance"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(find, f"doc_id {kind}, first long, end long, passage string, score double, significance double")


def trained(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> ToxicityModel:
    """Fitted on labelled rows with crc32(id) mod 5 not 0."""
    return fit(labelled_sample(docs, labels, "toxic", crc_mod("doc_id", 5) > 0, max_rows))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> DataFrame:
    """``doc_id, held_out, score, predicted, passages``: fitted on labelled rows
    with crc32(id) mod 5 not 0, applied to all documents."""
    return score(docs, trained(docs, labels, max_rows)).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "passages")
