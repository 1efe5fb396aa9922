"""Fill-in-middle transformation by content-defined chunk memoization.

A text's units are runs of letters A-Z, a-z and single other code points.  To
find where a unit begins, a text is cut into chunks where a rolling hash of its
last 16 bytes says so, so that passages which texts share fall into the same
chunks.  A chunk's summary (code points, units, whether a letter stands at its
first and last place) is kept by its content: a chunk seen before is looked up,
compared byte for byte, and not read again.  Two neighbouring chunks have one
unit less together where a run of letters crosses their border, so running
sums of the summaries give the chunk that a cut lies in, and only that chunk is
read.

Each task keeps its own summaries, at most ``_KEPT`` bytes of chunks; results
don't depend on what is kept.  Memory follows the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm._words import slices, text_bytes

MARKS = ("<P>", "<S>", "<M>")
#: Bytes that the rolling hash sees; a chunk ends where its upper bits are 0, after 4096 bytes at most.
WINDOW, CHUNK_BITS, MOST = 16, 9, 4096
_KEPT = 64 << 20
_GEAR = np.random.default_rng(20240512).integers(0, 1 << 16, 256, dtype=np.uint16)
#: Bytes of a text as units see them: letters, others, and bytes that only continue a code point.
_LETTERS = bytes([*range(65, 91), *range(97, 123)])
_KIND = bytes(97 if b in _LETTERS else 46 for b in range(256))
_CONTINUES = bytes(range(0x80, 0xC0))


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of the chunks of all texts, in order; an empty text has none.

    A border depends on the text's bytes alone, never on its neighbours', and
    lies between code points.
    """
    rolled = _GEAR[data]
    for shift in (1, 2, 4, 8):  # doubles the window: 16 bytes
        earlier = rolled[:-shift] << np.uint16(shift)
        rolled[shift:] += earlier
    whole = np.ones(len(data) + 1, bool)  # a code point may begin here
    whole[:-1] = (data & 0xC0) != 0x80
    cut = np.flatnonzero(rolled >> np.uint16(16 - CHUNK_BITS) == 0) + 1
    cut = cut[whole[cut]]
    start = offsets[np.searchsorted(offsets, cut - 1, "right") - 1]
    cut = cut[cut - start >= WINDOW]
    ends = np.union1d(cut, offsets)
    gaps = np.diff(ends)
    long = np.flatnonzero(gaps > MOST)
    if len(long):
        times = -(-gaps[long] // MOST) - 1
        more = np.repeat(ends[long], times) + MOST * (np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + 1)
        for _ in range(3):  # back to the start of the code point
            more -= ~whole[more]
        ends = np.union1d(ends, more)
    return ends[ends > 0]


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """(code points, units, first is a letter, last is a letter) of a chunk."""
    kinds = chunk.translate(_KIND, _CONTINUES)
    first, last = kinds[:1] == b"a", kinds[-1:] == b"a"
    return len(kinds), kinds.count(b".") + kinds.count(b".a") + first, first, last


class Summaries:
    """Summaries by content, at most ``most`` bytes of it; all forgotten when full."""

    def __init__(self, most: int = _KEPT):
        self.most, self.held, self.seen, self.read = most, 0, {}, 0

    def of(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self.seen.get(chunk)
        if found is None:
            found = summary(chunk)
            self.read += 1
            if self.held > self.most:
                self.seen, self.held = {}, 0
            self.seen[chunk] = found
            self.held += len(chunk) + 100
        return found


def unit_start(chunk: bytes, joined: bool, nth: int) -> tuple[int, int]:
    """(code points, bytes) before the chunk's ``nth`` unit start; a first run of letters starts none if ``joined`` with the chunk before."""
    kinds = np.frombuffer(chunk.translate(_KIND, _CONTINUES), np.uint8)
    starts = kinds == 46
    starts[1:] |= starts[:-1].copy()
    starts[0] |= not joined
    points = int(np.flatnonzero(starts)[nth])
    return points, int(np.flatnonzero((np.frombuffer(chunk, np.uint8) & 0xC0) != 0x80)[points])


def _draws(doc_id: object, seed: int) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k:k + 8], 16) for k in range(0, 32, 8))


def _transform(seed: int, plain: int, spm: int):
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Summaries()
        for batch in batches:
            texts = batch.column("text").fill_null("")
            marked = np.zeros(len(texts), bool)
            for mark in MARKS:
                marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(texts)
            ids = batch.column("doc_id")
            for i, j in slices(offsets):
                rows = _part(kept, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], [_draws(x, seed) for x in ids[i:j].to_pylist()], marked[i:j], plain, spm)
                yield pa.RecordBatch.from_arrays([ids[i:j], *rows], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def _part(kept: Summaries, data: np.ndarray, offsets: np.ndarray, draws: list[tuple], marked: np.ndarray, plain: int, spm: int) -> list[pa.Array]:
    raw = data.tobytes()
    ends = chunk_ends(data, offsets) if len(data) else np.zeros(0, np.int64)
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    chunks = [raw[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
    found = np.array([kept.of(c) for c in chunks], np.int64).reshape(-1, 4)
    own = np.searchsorted(begins, offsets)  # first chunk of each text
    joined = np.zeros(len(chunks), bool)
    joined[1:] = (found[1:, 2] & found[:-1, 3]).astype(bool)
    joined[own[:-1][own[:-1] < len(chunks)]] = False
    points, units = (np.concatenate([[0], np.cumsum(x)]) for x in (found[:, 0], found[:, 1] - joined))
    n = units[own[1:]] - units[own[:-1]]

    def cut(t: int, nth: int) -> tuple[int, int]:
        """(code points of text t, bytes of the run) before its ``nth`` unit."""
        if nth == n[t]:
            return int(points[own[t + 1]] - points[own[t]]), int(offsets[t + 1])
        target = units[own[t]] + nth
        c = int(np.searchsorted(units, target, "right")) - 1
        inside, byte = unit_start(chunks[c], bool(joined[c]), int(target - units[c]))
        return int(points[c] - points[own[t]]) + inside, int(begins[c]) + byte

    forms, prefixes, middles, outputs = [], [], [], []
    for t, (h1, h2, h3, h4) in enumerate(draws):
        lo, hi = int(offsets[t]), int(offsets[t + 1])
        if lo == hi or marked[t] or h3 % 100 >= plain:
            forms.append("plain")
            prefixes.append(None)
            middles.append(None)
            outputs.append(raw[lo:hi])
            continue
        units_ = int(n[t]) + 1
        (p, a), (m, b) = (cut(t, x) for x in sorted((h1 % units_, h2 % units_)))
        prefix, middle, suffix = raw[lo:a], raw[a:b], raw[b:hi]
        form = "spm" if h4 % 100 < spm else "psm"
        forms.append(form)
        prefixes.append(p)
        middles.append(m - p)
        outputs.append(b"<S>" + suffix + b"<P>" + prefix + b"<M>" + middle if form == "spm" else b"<P>" + prefix + b"<S>" + suffix + b"<M>" + middle)
    return [pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``, a row per input row.

    The cuts stand before the units that the first two 8-digit groups of the
    sha256 of ``seed:doc_id`` name, mod n + 1; the third, mod 100, leaves the
    text plain from ``plain_from`` on; the fourth, mod 100, puts the suffix
    first below ``spm_below``.  A text that is null, empty or holds a mark is
    plain; plain texts have null lengths.  Repeated rows are cut alike; a null
    id is hashed as an empty one and kept.  No rows give no rows.  Other
    columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_transform(seed, plain_from, spm_below), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column | str, form: Column | str) -> Column:
    """The text again, from a transformed text and its form alone.

    A text with a mark in it is plain, and no mark can begin inside another,
    so each mark stands in the output once.
    """
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    after = lambda c, mark: F.split_part(c, F.lit(mark), F.lit(2))
    before = lambda c, mark: F.split_part(c, F.lit(mark), F.lit(1))
    middle = after(output, "<M>")
    psm = F.concat(before(after(output, "<P>"), "<S>"), middle, before(after(output, "<S>"), "<M>"))
    spm = F.concat(before(after(output, "<P>"), "<M>"), middle, before(after(output, "<S>"), "<P>"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """:func:`fill_in_middle` with digests in place of the texts."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                                       digest(restored("output", "form")).alias("restored_sha256"))


#: DuckDB SQL for the same rows.
INFILL_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]', 0, 's') AS units FROM d),
g AS (SELECT *, CAST(len(units) AS BIGINT) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
