"""Best-fit packing of tokenized documents by bin completion.

A packing depends on the pieces' lengths alone, so the search works on counts
of lengths: at most ``capacity`` numbers, however large the corpus.  A run of
equal sequences is one entry of the plan (a filling and how many times it is
used), and every step of the search uses a filling as often as the counts
allow, so plans stay small too.

The search enumerates undominated fillings around the largest piece left.  It
starts from best-fit decreasing, completes every partial plan by best-fit as a
new incumbent, and leaves out what the waste bound shows to be no better.

Pieces are then numbered within their length (ranges of equal size, so that a
length that a third of all pieces has is spread over tasks), and the n-th piece
of a length takes the n-th place that the plan has for it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm._spark import stored
from keyfold.llm._words import slices, text_bytes, word_hashes
from keyfold.operators.running import running_by

#: Sizes from large to small with how often each occurs, e.g. ((3000, 1), (500, 2)).
Filling = tuple[tuple[int, int], ...]


# -- the plan: which lengths share a sequence --------------------------------
def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, by the waste that large sizes force.

    For each k: sizes above capacity - k are alone, those above half a sequence
    are each in one of their own, and sizes from k on fill what these leave.
    """
    size = np.arange(capacity + 1)
    n, total = np.cumsum(counts), np.cumsum(counts * size)
    k = np.arange(capacity // 2 + 1)
    half = capacity // 2
    large = n[capacity] - n[capacity - k]
    middle, held = n[capacity - k] - n[half], total[capacity - k] - total[half]
    small = total[half] - np.where(k > 0, total[k - 1], 0)
    return int((large + middle + np.maximum(0, -(-(small - (middle * capacity - held)) // capacity))).max())


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing over counts of sizes: each piece into the fullest sequence that has room."""
    open_: dict[int, list[tuple[Filling, int]]] = {}
    rooms, full = 0, []  # bit r: some sequence has room r

    def put(room: int, filling: Filling, times: int) -> None:
        nonlocal rooms
        if room:
            open_.setdefault(room, []).append((filling, times))
            rooms |= 1 << room
        else:
            full.append((filling, times))

    for size in map(int, np.flatnonzero(counts)[::-1]):
        left = int(counts[size])
        while left:
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                filling, times = open_[room].pop()
                if not open_[room]:
                    rooms &= ~(1 << room)
            else:  # as many new sequences as the rest needs
                room, filling = capacity, ()
                times = -(-left // (capacity // size))
            each = room // size
            whole = min(times, left // each)
            if whole:
                put(room - each * size, (*filling, (size, each)), whole)
            left -= whole * each
            times -= whole
            if times and 0 < left < each:
                put(room - left * size, (*filling, (size, left)), 1)
                left, times = 0, times - 1
            if times and filling:
                put(room, filling, times)
    return full + [x for group in open_.values() for x in group]


def _widened(bits: int, most: int) -> int:
    """Bits s to s + ``most`` for every bit s."""
    done = 0
    while done < most:
        step = min(done + 1, most - done)
        bits |= bits << step
        done += step
    return bits


def _undominated(sizes: Sequence[int], slack: int, others: int) -> bool:
    """Whether no excluded size can take the place of some of ``sizes``.

    ``others`` has a bit for every size left outside.  Several chosen sizes
    with sum s are dominated by a size from s to s + slack, a single one by a
    larger one up to there: what goes out fits wherever that size would have gone.
    """
    several, singles = 0, 0  # bit s: a set of two or more, or of one, has sum s
    for x in sizes:
        several |= (several << x) | (singles << x)
        singles |= 1 << x
    better = _widened(several, slack) | (_widened(singles << 1, slack - 1) if slack else 0)
    return not better & others


def fillings(room: int, counts: np.ndarray, spend: list[int] | None = None) -> Iterator[tuple[list[int], int]]:
    """(sizes, what stays empty) of every undominated filling of ``room``, larger
    sizes first; ``spend`` holds how many fillings may still be looked at."""
    spend = [-1] if spend is None else spend
    sizes = [int(s) for s in np.flatnonzero(counts[:room + 1])[::-1]]
    left = {s: int(counts[s]) for s in sizes}
    all_bits = sum(1 << s for s in sizes)
    rising = sizes[::-1]

    def more(start: int, room: int, chosen: list[int]) -> Iterator[tuple[list[int], int]]:
        smallest = next((s for s in rising if left[s]), room + 1)
        if smallest > room:  # nothing else fits
            spend[0] -= 1
            gone = sum(1 << s for s in set(chosen) if not left[s])
            if _undominated(chosen, room, all_bits & ~gone):
                yield list(chosen), room
            return
        for i in range(max(start, len(sizes) - bisect_right(rising, room)), len(sizes)):
            if spend[0] == 0:
                return
            s = sizes[i]
            if left[s]:
                left[s] -= 1
                chosen.append(s)
                yield from more(i, room - s, chosen)
                chosen.pop()
                left[s] += 1
                if s == room:  # a size that fills the room dominates all else
                    return

    yield from more(0, room, [])


def _grouped(sizes: Sequence[int]) -> Filling:
    found: dict[int, int] = {}
    for s in sorted(sizes, reverse=True):
        found[s] = found.get(s, 0) + 1
    return tuple(found.items())


def complete_bins(counts: Sequence[int], capacity: int, *, nodes: int = 400, looks: int = 100_000, width: int = 32, one_by_one: int = 200) -> list[tuple[Filling, int]]:
    """A plan ``[(filling, times)]`` that holds ``counts[s]`` pieces of each size s.

    Exact when the search ends within ``nodes`` partial plans and ``looks``
    fillings and at most ``one_by_one`` pieces are there; beyond, a step uses a
    filling as often as it can, and the best plan found is returned: never worse
    than best-fit decreasing, and proven least where it meets :func:`lower_bound`.
    """
    counts = np.asarray(counts, np.int64)
    counts = np.concatenate([counts, np.zeros(capacity + 1 - len(counts), np.int64)])
    if len(counts) > capacity + 1 or counts[0]:
        raise ValueError("sizes must be from 1 to the capacity")
    best = best_fit(counts, capacity)
    fewest, least = sum(t for _, t in best), lower_bound(counts, capacity)

    spend = [looks]

    def options(counts: np.ndarray) -> Iterator[tuple[Filling, int]]:
        largest = int(np.flatnonzero(counts)[-1])
        others = counts.copy()
        others[largest] -= 1
        many = counts.sum() > one_by_one
        found = fillings(capacity - largest, others, spend)
        while some := list(islice(found, width)):
            for sizes, _ in sorted(some, key=lambda x: x[1]):  # least waste first
                filling = _grouped([largest, *sizes])
                yield filling, min(int(counts[s]) // n for s, n in filling) if many else 1

    if not counts.any() or fewest == least:
        return best
    chosen: list[tuple[Filling, int]] = []
    frames = [(counts, 0, options(counts))]
    while frames and fewest > least and nodes > 0 and spend[0] > 0:
        counts, used, tried = frames[-1]
        step = next(tried, None)
        if step is None:
            frames.pop()
            chosen[-1:] = []
            continue
        nodes -= 1
        filling, times = step
        rest = counts.copy()
        for size, n in filling:
            rest[size] -= n * times
        if used + times + lower_bound(rest, capacity) >= fewest:  # too much wasted already
            continue
        tail = best_fit(rest, capacity)
        bins = used + times + sum(t for _, t in tail)
        if bins < fewest:
            best, fewest = [*chosen, step, *tail], bins
        chosen.append(step)
        frames.append((rest, used + times, options(rest) if rest.any() else iter(())))
    return best


def places(plan: Sequence[tuple[Filling, int]]) -> dict[str, np.ndarray]:
    """Runs of places by (size, number within the size): the first number of a
    run, its first sequence, the places a sequence has, and the first offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, times in plan:
        offset = 0
        for size, n in filling:
            rows.append((size, used.get(size, 0), sequence, n, offset))
            used[size] = used.get(size, 0) + n * times
            offset += size * n
        sequence += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(("size", "start", "sequence", "each", "offset"), columns, strict=True))


# -- tokens -------------------------------------------------------------------
class _Encoder:
    """Token ids of whole texts, every distinct word tokenized once.

    The tokenizer drops white space and looks at nothing beyond it, so a text's
    ids are those of its words in order; it also parts a letter or digit from
    the punctuation after it, so words are parted there as well and "so," is
    "so" and ",".  Words are recognised by 64-bit hashes of their lower-cased
    bytes (the tokenizer lower-cases as well); texts that hold the mark of a
    special token go to the tokenizer whole.  New words of letters alone are
    tokenized as one text: each ends with a token that ends a word.
    """

    #: Bytes of letters and digits, and of punctuation that no letter or digit before it joins (an apostrophe may).
    _ALNUM, _MARKS = np.zeros(256, bool), np.zeros(256, bool)
    _ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
    _MARKS[[ord(c) for c in '.,;:!?")]}']] = True

    def __init__(self, path: str | None, most: int = 1 << 22):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())), sizes

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_batch`, of words of letters alone."""
        flat = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends[flat])
        if len(last) != len(words):  # a tokenizer that marks the ends of words otherwise
            return self._batch(words)
        return flat, np.diff(last, prepend=-1)

    @staticmethod
    def _letters(data: np.ndarray) -> np.ndarray:
        """Bytes of the letters A-Z, a-z and U+00C0 to U+00FF."""
        letter = (data | 0x20) - np.uint8(0x61) < 26
        lead = np.append(data[1:] >= 0x80, False) & (data == 0xC3)
        trail = np.append(False, data[:-1] == 0xC3) & (data >= 0x80) & (data != 0x97) & (data != 0xB7)
        return letter | lead | trail

    def _learn(self, hashes: np.ndarray, words: list[str], plain: np.ndarray) -> None:
        groups = [([w for w, x in zip(words, plain.tolist(), strict=True) if x is want], encode) for want, encode in ((True, self._words), (False, self._batch))]
        done = [encode(some) for some, encode in groups if some]
        flat, sizes = (np.concatenate(x) for x in zip(*done, strict=True))
        hashes = np.concatenate([hashes[plain], hashes[~plain]])
        at = len(self.flat) + np.cumsum(sizes) - sizes
        order = np.argsort(hashes)
        where = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, where, hashes[order])
        self.at, self.size = np.insert(self.at, where, at[order]), np.insert(self.size, where, sizes[order])
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each), ``end`` after each text."""
        parted = np.flatnonzero(self._ALNUM[data[:-1]] & self._MARKS[data[1:]]) + 1
        data, offsets = np.insert(data, parted, 0x20), offsets + np.searchsorted(parted, offsets)
        h, of, first, stop = word_hashes(data, offsets)
        uniq, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.flat) > self.most:
            self._forget()
        place = np.searchsorted(self.known, uniq)
        new = np.ones(len(uniq), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != uniq[inside]
        if new.any():
            a, b = first[at[new]], stop[at[new]]
            raw, others = data.tobytes(), np.concatenate([[0], np.cumsum(~self._letters(data))])
            self._learn(uniq[new], [raw[i:j].decode() for i, j in zip(a.tolist(), b.tolist(), strict=True)], others[a] == others[b])
            place = np.searchsorted(self.known, uniq)
        words = place[back]
        sizes = self.size[words]
        n = len(offsets) - 1
        counts = np.bincount(of, sizes, n).astype(np.int64) + 1
        from_ = np.repeat(self.at[words] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        ids = np.insert(self.flat[from_], np.cumsum(counts - 1), np.uint32(end))
        return ids, counts

    def whole(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = self._batch(texts)
        return np.insert(flat, np.cumsum(sizes), np.uint32(end)), sizes + 1


def _pieces(path: str | None, capacity: int, end: int, keep_ids: bool):
    """``doc_id, piece, start, length, ids_crc32[, ids]`` of each piece of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(path)
        for batch in batches:
            marked = pc.fill_null(pc.match_substring(batch.column("text"), "<|"), False)
            for rows, whole in ((batch.filter(pc.invert(marked)), False), (batch.filter(marked), True)):
                data, offsets = text_bytes(rows.column("text"))
                for i, j in slices(offsets):
                    if whole:
                        ids, counts = encoder.whole(rows.column("text")[i:j].to_pylist(), end)
                    else:
                        ids, counts = encoder.encode(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], end)
                    yield _cut(rows.column("doc_id")[i:j], ids, counts, capacity, keep_ids)
    return run


def _cut(doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray, capacity: int, keep_ids: bool) -> pa.RecordBatch:
    pieces = -(-counts // capacity)
    of = np.repeat(np.arange(len(counts)), pieces)
    piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = piece * capacity
    length = np.minimum(capacity, counts[of] - start)
    stop = np.cumsum(length)
    raw = memoryview(ids.astype("<u4").tobytes())
    crc = np.fromiter((zlib.crc32(raw[4 * (b - n):4 * b]) for b, n in zip(stop.tolist(), length.tolist(), strict=True)), np.int64, len(of))
    columns = {"doc_id": doc_ids.take(pa.array(of)), "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc)}
    if keep_ids:
        columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, stop).astype(np.int32)), pa.array(ids.astype(np.int32)))
    return pa.RecordBatch.from_pydict(columns)


def _placer(plan: dict[str, np.ndarray]):
    """``nth`` piece of its length -> ``sequence_id, offset``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (plan["size"].astype(np.uint64) << np.uint64(48)) | plan["start"].astype(np.uint64)
        for batch in batches:
            length, nth = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "nth"))
            run_ = np.searchsorted(key, (length.astype(np.uint64) << np.uint64(48)) | (nth - 1).astype(np.uint64), "right") - 1
            past, slot = np.divmod(nth - 1 - plan["start"][run_], plan["each"][run_])
            columns = {f.name: batch.column(f.name) for f in batch.schema if f.name != "nth"}
            columns["sequence_id"] = pa.array(plan["sequence"][run_] + past)
            columns["offset"] = pa.array(plan["offset"][run_] + slot * length)
            yield pa.RecordBatch.from_pydict(columns)
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str | None = None, capacity: int = 4096, end: int = 1,
         keep_ids: bool = False, nodes: int = 400) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, a row per piece.

    A document is its token ids, then ``end``; only one of more than
    ``capacity`` ids is cut, into pieces of ``capacity`` and a last one.  The
    pieces of a sequence lie one after another from offset 0 and are at most
    ``capacity`` ids together.  ``tokenizer`` is the path of a tokenizer file
    that drops white space and lower-cases (left out, that of
    ``word_bpe_49k.json``); a text that holds a special token's mark gets the
    special token's id, as the tokenizer has it.  ``keep_ids`` adds the ids.

    A null, empty or blank text has the end token alone.  Repeated rows are
    documents of their own; null ids are kept; equal lengths are taken by id,
    then piece; sequences are numbered from 0.  No rows give no rows.  Other
    columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    pieces = stored(texts.mapInArrow(_pieces(tokenizer, capacity, end, keep_ids), schema), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").agg(F.count("*")).collect():  # a row for each length, at most ``capacity``
        counts[length] = n
    plan = places(complete_bins(counts, capacity, nodes=nodes))
    numbered = running_by(pieces, "length", "doc_id", count="nth", tiebreak=["piece"])
    return numbered.mapInArrow(_placer(plan), schema + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, starts``: the ids of each sequence of ``pack(..., keep_ids=True)``
    and where its pieces begin; a sequence's group has at most ``capacity`` ids."""
    each = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    held = packed.groupBy("sequence_id").agg(each.alias("each"))
    return held.select("sequence_id", F.flatten(F.transform("each", lambda x: x["ids"])).alias("ids"), F.transform("each", lambda x: x["offset"]).alias("starts"))
