"""Words of whole Arrow text columns as 64-bit hashes, without a Python loop.

A batch's texts lie in one byte buffer; word limits, lower-casing of A-Z and
hashing are array operations over segments of at most about ``SEGMENT`` bytes
(cut between words), so memory does not grow with the length of a text.

A word's hash is a polynomial in a random odd base over random byte values,
mod 2**64, then mixed: two different words agree with a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Bytes that separate words: white space, or whatever isn't a letter, digit or non-ASCII byte.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
PUNCT = np.ones(256, bool)
PUNCT[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**i mod 2**64 for i < n at least."""
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.full(max(n, SEGMENT + 4096), base, np.uint64)
            have[0] = 1
            have = np.cumprod(have, dtype=np.uint64)
        _powers[key] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):  # no chunk at all
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _segments(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> Iterator[tuple[int, int]]:
    lo, n = 0, len(data)
    while lo < n:
        hi = min(lo + SEGMENT, n)
        if hi < n:
            inside = offsets[np.searchsorted(offsets, hi, "right") - 1]
            if inside > lo:
                hi = int(inside)
            else:  # within one long text: after its last separator, or else after its next one
                cut = np.flatnonzero(separator[data[lo:hi]])
                while not len(cut) and hi < n:
                    far = min(hi + SEGMENT, n)
                    cut = np.flatnonzero(separator[data[hi:far]]) + (hi - lo)
                    cut, hi = cut[:1], far
                hi = lo + int(cut[-1]) + 1 if len(cut) else n
                inside = offsets[np.searchsorted(offsets, lo, "right")] if lo < n else n
                hi = min(hi, int(inside)) if inside > lo else hi
        yield lo, hi
        lo = hi


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """(hash, text number, first byte, byte after the last) of each word, in
    order; then, for each of ``prefixes``, the hash of the word's first so many
    bytes, 0 where it has no more than those."""
    found = [[] for _ in range(4 + len(prefixes))]
    for lo, hi in _segments(data, offsets, separator):
        part = data[lo:hi]
        word = ~separator[part]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        a, b = np.searchsorted(offsets, (lo, hi))
        inner = offsets[a:b] - lo  # a text's end parts words as well
        first[inner] |= word[inner]
        inner = inner[inner > 0] - 1
        last[inner] |= word[inner]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        if not len(s):
            continue
        with np.errstate(over="ignore"):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * _power(_BASE, len(part))[:len(part)], out=sums[1:])
            back = _power(_INVERSE, len(part))[s]
            h = mix((sums[e] - sums[s]) * back + (e - s).astype(np.uint64))
            for k, n in enumerate(prefixes):
                short = mix((sums[np.minimum(s + n, e)] - sums[s]) * back + np.uint64(n << 32))
                found[4 + k].append(np.where(e - s > n, short, np.uint64(0)))
        s += lo
        found[0].append(h)
        found[1].append(np.searchsorted(offsets, s, "right") - 1)
        found[2].append(s)
        found[3].append(e + lo)
    kinds = (np.uint64, np.int64, np.int64, np.int64, *[np.uint64] * len(prefixes))
    return tuple(np.concatenate(x).astype(k, copy=False) if x else np.zeros(0, k) for x, k in zip(found, kinds, strict=True))


def shingle_hashes(words: np.ndarray, of: np.ndarray, n_texts: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each run of ``k`` words of one text, repeats too;
    a text of fewer words, but not none, has the whole sequence as its one."""
    counts = np.bincount(of, minlength=n_texts)
    with np.errstate(over="ignore"):
        n = max(len(words) - k + 1, 0)
        total = np.full(n, k, np.uint64)
        for j in range(k):
            total = total * np.uint64(0xD6E8FEB86659FD93) + words[j:j + n]
    full = of[:n] == of[len(of) - n:] if n else np.zeros(0, bool)
    hashes, texts = total[full], of[:n][full]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        at = np.searchsorted(of, short)
        own = []
        with np.errstate(over="ignore"):
            for i, t in zip(at, short, strict=True):
                x = np.uint64(counts[t])
                for w in words[i:i + counts[t]]:
                    x = x * np.uint64(0xD6E8FEB86659FD93) + w
                own.append(x)
        hashes, texts = np.concatenate([hashes, np.array(own, np.uint64)]), np.concatenate([texts, short])
        order = np.argsort(texts, kind="stable")
        hashes, texts = hashes[order], texts[order]
    return mix(hashes), texts


def slices(offsets: np.ndarray, most: int = 4 * SEGMENT) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes together; a longer text is a run of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
