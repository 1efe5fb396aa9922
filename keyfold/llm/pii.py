"""Personal data: fixed patterns plus a character BiLSTM with a CRF.

The patterns (email, ip, card, phone) give the base spans.  A bidirectional
LSTM over characters, whose tag scores a linear-chain CRF decodes, adds spans
in other spellings.  It is trained in numpy from labelled spans: windows of a
bounded sample of texts carry the base spans of their own and planted ones in
varied spellings.

Texts are read whole.  Every span of the four kinds holds a digit, an ``@`` or
a bracketed ``at``; windows of ``WINDOW`` characters every ``STEP`` that hold
one are decoded, so each span of at most ``WINDOW - STEP`` characters, the
longest added e-mail, lies whole in one, and the spans are reconciled over the
text: of overlapping ones the span farther from its window's edges stays, of
equally far ones with the same start the longer.  Added spans must pass the kind's own checks and must
not touch a base span.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm._spark import bounded_sample

KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP = 96, 16
_TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
_GATE = re.compile(r"[0-9@]|[(\[]at[)\]]", re.IGNORECASE)
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # kind, start, end in code points


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, in linear time."""
    out: list[Span] = []
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
            past = found.end()
        at = text.find("@", max(at + 1, past))
    if not _DIGITS.search(text):
        return out
    chain: list[re.Match] = []
    for run in _DIGITS.finditer(text):
        linked = chain and run.start() == chain[-1].end() + 1 and text[chain[-1].end()] == "."
        chain = [*chain, run] if linked else [run]
        if len(chain) == 4:
            if all(len(m[0].lstrip("0")) <= 3 and int(m[0].lstrip("0") or 0) <= 255 for m in chain):
                out.append((1, chain[0].start(), run.end()))
            chain = []
    for m in _CARD.finditer(text):
        if len(m[0]) <= 40 and 13 <= len(digits := _only_digits(m[0])) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_only_digits(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def _plausible(kind: int, text: str) -> bool:
    """Whether an added span passes the checks of its kind."""
    if kind == 0:
        return bool(re.search(r"[A-Za-z0-9]\s?(@|[(\[]at[)\]])\s?[A-Za-z0-9].*(\.|[(\[]dot[)\]])\s?[A-Za-z0-9]+$", text, re.IGNORECASE)) and len(text) <= 80
    digits = _only_digits(text)
    if kind == 1:
        parts = _DIGITS.findall(text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and len(text) <= 27
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search("[A-Za-z]", text)
    return 9 <= len(digits) <= 15 and len(re.findall(r"[ ().+/-]", text)) >= 2 and not re.search("[A-Za-z]", text)


# --- the model ---------------------------------------------------------------

_CODE = np.zeros(128, np.int64)
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _CODE[ord(_c)], _CODE[ord(_c) - 32] = 2 + _i, 28
for _i, _c in enumerate("0123456789"):
    _CODE[ord(_c)] = 29
for _i, _c in enumerate(" \n\t!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    _CODE[ord(_c)] = 30 + _i
_CODES = 30 + 36
_PAST_END = 1  # also the code of padding; 0 is any other character


def encode(text: str) -> np.ndarray:
    """Codes of one window, padded to its full length."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full(WINDOW, _PAST_END, np.int64)
    out[:len(points)] = np.where(points < 128, _CODE[np.minimum(points, 127)], 0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Tagger:
    """Parameters; the first axis of the recurrent ones is the direction."""

    embed: np.ndarray  # codes x d
    w: np.ndarray  # 2 x d x 4h
    u: np.ndarray  # 2 x h x 4h
    b: np.ndarray  # 2 x 1 x 4h
    out: np.ndarray  # 2h x tags
    bias: np.ndarray  # tags
    trans: np.ndarray  # tags x tags

    @staticmethod
    def start(rng: np.random.Generator, d: int = 12, h: int = 16) -> Tagger:
        draw = lambda *s: rng.normal(0, s[-2] ** -0.5, s).astype(np.float32)
        b = np.zeros((2, 1, 4 * h), np.float32)
        b[..., h:2 * h] = 1.0
        return Tagger(rng.normal(0, 0.5, (_CODES, d)).astype(np.float32), draw(2, d, 4 * h), draw(2, h, 4 * h), b, draw(2 * h, _TAGS),
                      np.zeros(_TAGS, np.float32), np.zeros((_TAGS, _TAGS), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.w, self.u, self.b, self.out, self.bias, self.trans]

    def states(self, x: np.ndarray, keep: bool = False):
        """Hidden states (t, batch, 2h) of code windows (batch, t)."""
        n, t = x.shape
        h = self.u.shape[1]
        e = self.embed[x.T]  # t, n, d
        both = np.stack([e, e[::-1]])  # 2, t, n, d
        z_in = np.matmul(both, self.w[:, None]) + self.b[:, None]
        hidden, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        outs, saved = np.empty((2, t, n, h), np.float32), []
        for k in range(t):
            z = z_in[:, k] + np.matmul(hidden, self.u)
            gates = _sigmoid(z[..., :3 * h])
            g = np.tanh(z[..., 3 * h:])
            i, f, o = gates[..., :h], gates[..., h:2 * h], gates[..., 2 * h:]
            before, last = cell, hidden
            cell = f * cell + i * g
            tc = np.tanh(cell)
            hidden = o * tc
            outs[:, k] = hidden
            if keep:
                saved.append((i, f, o, g, before, last, tc))
        return np.concatenate([outs[0], outs[1][::-1]], axis=-1), both, saved

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self.states(x)[0] @ self.out + self.bias

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tag sequences (batch, t) by Viterbi."""
        e = self.emissions(x)
        t, n, k = e.shape
        back, best = np.zeros((t, n, k), np.int8), e[0]
        for i in range(1, t):
            paths = best[:, :, None] + self.trans[None] + _ALLOWED
            back[i] = paths.argmax(1)
            best = paths.max(1) + e[i]
        tags = np.empty((n, t), np.int64)
        tags[:, -1] = best.argmax(1)
        for i in range(t - 1, 0, -1):
            tags[:, i - 1] = back[i, np.arange(n), tags[:, i]]
        return tags


#: An inside tag follows its own begin or inside tag only.
_ALLOWED = np.zeros((_TAGS, _TAGS), np.float32)
for _k in range(len(KINDS)):
    _ALLOWED[:, 2 + 2 * _k] = -1e4
    _ALLOWED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = 0


def _gradients(model: Tagger, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log-likelihood of the tags and its gradients."""
    n, t = x.shape
    h = model.u.shape[1]
    hs, both, saved = model.states(x, keep=True)
    e = hs @ model.out + model.bias
    move = model.trans + _ALLOWED
    forward, backward = np.empty_like(e), np.zeros_like(e)

    def lse(a: np.ndarray, axis: int) -> np.ndarray:
        m = a.max(axis, keepdims=True)
        return (m + np.log(np.exp(a - m).sum(axis, keepdims=True))).squeeze(axis)

    forward[0] = e[0]
    for i in range(1, t):
        forward[i] = lse(forward[i - 1][:, :, None] + move, 1) + e[i]
    for i in range(t - 2, -1, -1):
        backward[i] = lse((backward[i + 1] + e[i + 1])[:, None, :] + move, 2)
    z = lse(forward[-1], 1)
    de = np.exp(forward + backward - z[None, :, None])
    gold = np.arange(t)[:, None], np.arange(n)[None], y.T
    loss = float((z - e[gold].sum(0) - move[y[:, :-1], y[:, 1:]].sum(1)).mean())
    de[gold] -= 1
    de /= n
    dtrans = np.zeros_like(model.trans)
    for i in range(1, t):
        dtrans += np.exp(forward[i - 1][:, :, None] + move + (e[i] + backward[i])[:, None, :] - z[:, None, None]).sum(0)
    np.subtract.at(dtrans, (y[:, :-1], y[:, 1:]), 1)
    dtrans /= n
    dhs = de @ model.out.T
    douts = np.stack([dhs[..., :h], dhs[::-1, :, h:]])  # 2, t, n, h
    dw, du, db = np.zeros_like(model.w), np.zeros_like(model.u), np.zeros_like(model.b)
    dz = np.empty((2, n, 4 * h), np.float32)
    dboth = np.empty_like(both)
    dh, dc = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
    for k in range(t - 1, -1, -1):
        i, f, o, g, before, last, tc = saved[k]
        dh = dh + douts[:, k]
        dc = dc + dh * o * (1 - tc * tc)
        dz[..., :h] = dc * g * i * (1 - i)
        dz[..., h:2 * h] = dc * before * f * (1 - f)
        dz[..., 2 * h:3 * h] = dh * tc * o * (1 - o)
        dz[..., 3 * h:] = dc * i * (1 - g * g)
        dw += np.matmul(both[:, k].transpose(0, 2, 1), dz)
        du += np.matmul(last.transpose(0, 2, 1), dz)
        db += dz.sum(1, keepdims=True)
        dboth[:, k] = np.matmul(dz, model.w.transpose(0, 2, 1))
        dh = np.matmul(dz, model.u.transpose(0, 2, 1))
        dc = dc * f
    dembed = np.zeros_like(model.embed)
    np.add.at(dembed, x.T, dboth[0] + dboth[1][::-1])
    flat = de.reshape(-1, _TAGS)
    return loss, [dembed, dw, du, db, hs.reshape(-1, 2 * h).T @ flat, flat.sum(0), dtrans]


def train(windows: np.ndarray, tags: np.ndarray, steps: int = 260, batch: int = 48, rate: float = 0.02, seed: int = 5) -> Tagger:
    """Adam over random batches of labelled windows."""
    rng = np.random.default_rng(seed)
    model = Tagger.start(rng)
    params = model.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), batch)
        _, grads = _gradients(model, windows[pick], tags[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            g = g * min(1.0, 5 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return model


def _planted(r: random.Random) -> tuple[int, str]:
    """A span in one of many spellings; kind -1 is no personal data."""
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda a, b: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(a, b)))
    kind = r.choice([0, 0, 1, 2, 2, 3, 3, -1, -1])
    if kind == 0:
        at = r.choice(["@", "@", " @ ", "(at)", "[at]", " (at) ", " [at] "])
        dot = "." if "@" in at else r.choice([".", "(dot)", "[dot]"])
        local = word(2, 9) + r.choice(["", "." + word(2, 8), "." + digits(2), "_" + word(1, 5), digits(3)])
        return 0, f"{local}{at}{dot.join([word(3, 9) + r.choice(['', digits(1)]), *r.choice([[], ['example']]), r.choice(['com', 'org', 'net', 'de', 'fr', 'es', 'io'])])}"
    if kind == 1:
        return 1, r.choice([".", ".", "[.]", "(.)", " . "]).join(str(r.randint(0, 255)) for _ in range(4))
    if kind == 2:
        body = r.choice("3456") + digits(r.choice([12, 13, 14, 14, 14, 14, 15]))
        body += next(c for c in "0123456789" if luhn(body + c))
        sep = r.choice(["", "", " ", "-", ".", "/", "  "])
        return 2, sep.join(body[i:i + 4] for i in range(0, len(body), 4))
    if kind == 3:
        a, b, c = digits(3), digits(3), digits(4)
        return 3, r.choice([f"+1 ({a}) {b}-{c}", f"+{r.randint(1, 99)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"00{r.randint(1, 99)} {a} {b} {c}", f"({a}) {b} {c}", f"{a}/{b}-{c}"])
    return -1, r.choice([digits(r.randint(1, 8)), f"{r.randint(1900, 2030)}-{digits(2)}-{digits(2)}", f"{digits(1)}.{digits(1)}.{digits(1)}", f"{digits(2)}.{digits(2)}",
                         "".join(r.choice("0123456789abcdef") for _ in range(r.choice([8, 20, 32, 40]))), f"@{word(3, 8)}", f"{digits(3)},{digits(3)}", f"{digits(2)}:{digits(2)}", f"({digits(1)})", f"{digits(3)} {digits(2)}"])


def labelled_windows(texts: list[str], n: int = 3000, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the texts with tags of their base spans and of planted spans."""
    r = random.Random(seed)
    xs, ys = np.empty((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64)
    texts = [t for t in texts if t] or ["the text of a document, with words."]
    for k in range(n):
        text = r.choice(texts)
        at = r.randrange(max(1, len(text) - WINDOW))
        gates = [m.start() for m in _GATE.finditer(text)] if r.random() < 0.4 else []
        if gates:
            at = max(0, r.choice(gates) - r.randrange(WINDOW))
        part = text[at:at + WINDOW]
        spans = [(kind, max(a - at, 0), min(b - at, WINDOW)) for kind, a, b in base_spans(text[max(0, at - WINDOW):at + 2 * WINDOW])
                 for a, b in [(a + max(0, at - WINDOW), b + max(0, at - WINDOW))] if a < at + WINDOW and b > at]
        if not spans and r.random() < 0.85:
            kind, span = _planted(r)
            start = r.randrange(max(1, len(part)))
            start = part.find(" ", start) + 1 or start
            joined = part[:start] + span + r.choice([" ", " ", ". ", ", ", ""]) + part[start:]
            shift = r.choice([0, 0, 0, r.randrange(-len(span) - 4, 8)])
            joined = joined[-shift:] if shift < 0 else joined
            start += min(shift, 0)
            part = joined[:WINDOW]
            if kind >= 0 and start + len(span) > 0:
                spans = [(kind, max(start, 0), min(start + len(span), WINDOW))]
        xs[k] = encode(part)
        for kind, a, b in spans:
            ys[k, a:b] = 2 + 2 * kind
            if a < WINDOW:
                ys[k, a] = 1 + 2 * kind
    return xs, ys


def model_spans(model: Tagger, texts: list[str], known: list[list[Span]]) -> list[list[Span]]:
    """Added spans of each text, reconciled over its windows."""
    asked: list[tuple[int, int]] = []
    for t, text in enumerate(texts):
        last = -1
        for m in _GATE.finditer(text):
            top = m.start() // STEP
            for w in range(max(top - WINDOW // STEP + 1, 0), top + 1):
                if w > last:
                    asked.append((t, w))
                    last = w
    found: list[list[tuple[int, Span]]] = [[] for _ in texts]
    for lo in range(0, len(asked), 512):
        part = asked[lo:lo + 512]
        tags = model.decode(np.stack([encode(texts[t][w * STEP:w * STEP + WINDOW]) for t, w in part]))
        for (t, w), row in zip(part, tags, strict=True):
            for a in np.flatnonzero((row > 0) & (row % 2 == 1)):
                kind, b = (int(row[a]) - 1) // 2, int(a) + 1
                while b < WINDOW and row[b] == row[a] + 1:
                    b += 1
                end = min(w * STEP + b, len(texts[t]))
                found[t].append((min(int(a), WINDOW - b), (kind, w * STEP + int(a), end)))
    out = []
    for text, spans, base in zip(texts, found, known, strict=True):
        taken = sorted((a, b) for _, a, b in base)
        added: list[Span] = []
        for _, (kind, a, b) in sorted(spans, key=lambda s: (-s[0], *s[1][:2], -s[1][2])):
            while b > a and text[b - 1] in " .,;:\n\t":
                b -= 1
            while a < b and text[a] in " .,;:\n\t":
                a += 1
            whole = not (text[max(a - 1, 0):a].isalnum() or text[b:b + 1].isalnum())
            if a < b and whole and _plausible(kind, text[a:b]) and not any(x < b and a < y for x, y in taken):
                added.append((kind, a, b))
                taken.append((a, b))
        out.append(added)
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _found(model: Tagger, texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(t) if _GATE.search(t) else [] for t in texts]
    return base, model_spans(model, texts, base)


def fit(docs: DataFrame, max_rows: int = 600, window_rows: int = 3000, max_bytes: int = 8 << 20) -> Tagger:
    """Trained on windows of a bounded sample of the texts, whole, copies
    counted once: about ``max_rows`` of about ``max_bytes`` together."""
    known = docs.select(F.col("text").cast("string").alias("text")).filter("text is not null")
    texts = bounded_sample(known, ["text"], max_rows, max_bytes).distinct().toPandas()["text"]
    return train(*labelled_windows(sorted(texts), window_rows))


def find(docs: DataFrame, model: Tagger) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``, a row per input row.

    The counts and the digest are of the base spans; ``spans`` has the added
    ones too.  A null or empty text has no spans.  Null and repeated ids are
    kept; other columns are ignored.
    """
    def spot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                base, added = _found(model, [t or "" for t in part.column("text").to_pylist()])
                counts = [pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64()) for k in range(len(KINDS))]
                yield pa.record_batch([part.column("doc_id"), *counts, pa.array([hashlib.sha256(_joined(s).encode()).hexdigest() for s in base], pa.string()),
                                       pa.array([_joined(a + b) for a, b in zip(base, added, strict=True)], pa.string()), pa.array([len(s) for s in added], pa.int64())],
                                      names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .mapInArrow(spot, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping ones as the first."""
    out, past = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= past:
            out += [text[past:a], f"[{KINDS[kind].upper()}]"]
        past = max(past, b)
    return "".join([*out, text[past:]])


def redact(docs: DataFrame, model: Tagger) -> DataFrame:
    """``docs`` with the spans of ``text`` replaced by their kind in brackets and
    ``n_chars`` (if there is one) counted anew; null texts stay null."""
    names = docs.columns
    schema = docs.schema

    def hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = part.column("text").to_pylist()
                base, added = _found(model, [t or "" for t in texts])
                new = [None if t is None else masked(t, a + b) if a or b else t for t, a, b in zip(texts, base, added, strict=True)]
                columns = []
                for name, column in zip(names, part.columns, strict=True):
                    if name == "text":
                        column = pa.array(new, column.type)
                    elif name == "n_chars":
                        column = pa.array([None if t is None else len(t) if a or b else c for t, a, b, c in zip(new, base, added, column.to_pylist(), strict=True)], column.type)
                    columns.append(column)
                yield pa.record_batch(columns, schema=part.schema)
    return docs.mapInArrow(hide, schema)
