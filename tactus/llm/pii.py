"""Personal data by patterns and a character-level bidirectional LSTM with CRF transitions.

The patterns find emails, IPv4 addresses, payment cards and phone numbers; a match that fails its check is dropped. The
model, trained in numpy on labelled spans, adds spans that the patterns' exact forms miss. It reads windows of ``WIDTH``
characters every ``STEP`` characters around digits, at-signs and "at" written for one (a span of any kind holds one of them, so other text
can't hold one). Windows overlap; where they disagree, a position's emission scores are those of the window in which it lies most
centrally, and one Viterbi pass over each run of windows with the CRF's transitions gives spans for the whole text.
A model's span must hold as many digits as its kind needs (a card must pass Luhn's check) and overlap no pattern's span.

The training sample is at most ``TRAINED`` windows of about ``SAMPLE`` documents with a digit or at-sign and at most ``LONGEST`` characters outside the held-out fold, chosen by a
hash of the id; a part of the labelled spans is rewritten into other written forms (no country code, dots, dashes, "at"). Null and empty texts have no spans. Offsets
count code points, ends are exclusive. Rows keep their multiplicity.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus.llm.common import held_out, sampled
from tactus.llm.tokens import slices

KINDS = ("email", "ip", "card", "phone")
# An email's or address's first run of characters is entered at its start alone: from further in, it would match just as well or badly,
# and trying every place takes the square of a long run's length.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL_START = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL.pattern)
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
#: What any span holds one of: a digit, an at-sign, or "at" by itself as it is written for one.
_WRITTEN = r"[ (\[]at[ )\]]"
_ANCHOR = re.compile("[0-9@]|" + _WRITTEN)

WIDTH, STEP, SAMPLE, LONGEST, TRAINED = 64, 32, 800, 50_000, 5000
#: Windows that are scored, and short runs that are decoded, at a time; positions of a run beyond which it is decoded as it is read; positions of short runs that wait.
WINDOWS, LONG, HELD = 512, 2048, 50_000
HIDDEN, EMBED, EPOCHS, BATCH = 20, 12, 6, 32
#: B and I tags of each kind after O.
TAGS = 1 + 2 * len(KINDS)
#: Characters with a symbol of their own; then letters, upper case, white space, other.
_OWN = "0123456789@.+-()_:/ "


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _octet(digits: str) -> bool:
    """Whether a number is at most 255; leading zeros count for nothing, and one of any length is settled by its digits."""
    own = digits.lstrip("0")
    return len(own) <= 3 and int(own or 0) <= 255


def _valid(kind: str, text: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(map(_octet, text.split(".")))
    digits = digits_of(text)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[re.Match]:
    """Leftmost matches; one that begins right where the last ended has its run's earlier part taken already."""
    found = _EMAIL_START.search(text)
    while found:
        yield found
        found = _EMAIL.match(text, found.end()) or _EMAIL_START.search(text, found.end())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the patterns' spans in order."""
    found = []
    if "@" in text:
        found += [(m.start(), 0, m.end()) for m in _emails(text)]
    if _DIGIT.search(text):
        for k, p in ((1, _IP), (2, _CARD), (3, _PHONE)):
            found += [(m.start(), k, m.end()) for m in p.finditer(text) if _valid(KINDS[k], m[0])]
    return sorted(found)


def _symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = np.full(128, len(_OWN) + 3, np.int8)
    for c in range(128):
        if chr(c).isalpha():
            table[c] = len(_OWN) + (1 if chr(c).isupper() else 0)
        elif chr(c).isspace():
            table[c] = len(_OWN) + 2
    for k, c in enumerate(_OWN):
        table[ord(c)] = k
    return np.where(points < 128, table[np.minimum(points, 127)], len(_OWN)).astype(np.int8)


SYMBOLS = len(_OWN) + 4


@dataclass
class Tagger:
    """Weights of the network: embedding, an LSTM each way, output layer, CRF transitions."""

    w: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)
        make = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        w = {"e": rng.normal(0, 0.5, (SYMBOLS + 1, EMBED)), "o": make(2 * HIDDEN, TAGS), "ob": np.zeros(TAGS), "t": np.zeros((TAGS, TAGS))}
        for d in "fb":
            w[f"{d}x"], w[f"{d}h"], w[f"{d}b"] = make(EMBED, 4 * HIDDEN), make(HIDDEN, 4 * HIDDEN), np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        return cls(w)

    def _lstm(self, x: np.ndarray, d: str, keep: bool = True) -> tuple[np.ndarray, list]:
        """States of each step of (time, batch, input), and what the way back needs if ``keep``; gates in order input, forget, output, candidate."""
        w, steps = self.w, range(len(x))
        h, c = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
        out, kept = np.zeros((*x.shape[:2], HIDDEN)), [None] * len(x)
        z = x @ w[f"{d}x"] + w[f"{d}b"]
        for t in steps if d == "f" else reversed(steps):
            a = z[t] + h @ w[f"{d}h"]
            g = 1 / (1 + np.exp(-a[:, : 3 * HIDDEN]))
            i, f, o, n = g[:, :HIDDEN], g[:, HIDDEN : 2 * HIDDEN], g[:, 2 * HIDDEN :], np.tanh(a[:, 3 * HIDDEN :])
            before, c = c, f * c + i * n
            kept[t] = (h, before, c, i, f, o, n) if keep else None
            h = o * np.tanh(c)
            out[t] = h
        return out, kept

    def _lstm_back(self, x: np.ndarray, d: str, kept: list, grad: np.ndarray, g: dict) -> np.ndarray:
        w, steps = self.w, range(len(x))
        dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
        dz = np.zeros((*x.shape[:2], 4 * HIDDEN))
        for t in reversed(steps) if d == "f" else steps:
            h, before, c, i, f, o, n = kept[t]
            dh = dh + grad[t]
            tc = np.tanh(c)
            dc = dc + dh * o * (1 - tc * tc)
            a = np.concatenate([dc * n * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - n * n)], 1)
            dz[t] = a
            g[f"{d}h"] += h.T @ a
            dh, dc = a @ w[f"{d}h"].T, dc * f
        g[f"{d}x"] += x.reshape(-1, x.shape[2]).T @ dz.reshape(-1, 4 * HIDDEN)
        g[f"{d}b"] += dz.sum((0, 1))
        return dz @ w[f"{d}x"].T

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        """Scores (time, batch, tag) of windows (time, batch)."""
        x = self.w["e"][symbols]
        return np.concatenate([self._lstm(x, "f", False)[0], self._lstm(x, "b", False)[0]], 2) @ self.w["o"] + self.w["ob"]

    def loss(self, symbols: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of tag sequences, and its gradients."""
        w, (steps, n) = self.w, symbols.shape
        x = w["e"][symbols]
        (hf, kf), (hb, kb) = self._lstm(x, "f"), self._lstm(x, "b")
        h = np.concatenate([hf, hb], 2)
        e = h @ w["o"] + w["ob"]
        rows = np.arange(n)
        a, b = np.zeros_like(e), np.zeros_like(e)
        a[0] = e[0]
        for t in range(1, steps):
            a[t] = e[t] + _logsum(a[t - 1][:, :, None] + w["t"], 1)
        for t in range(steps - 2, -1, -1):
            b[t] = _logsum(w["t"] + (e[t + 1] + b[t + 1])[:, None, :], 2)
        total = _logsum(a[-1], 1)
        gold = e[0, rows, tags[0]].copy()
        for t in range(1, steps):
            gold += e[t, rows, tags[t]] + w["t"][tags[t - 1], tags[t]]
        g = {k: np.zeros_like(v) for k, v in w.items()}
        de = np.exp(a + b - total[:, None])
        de[np.arange(steps)[:, None], rows, tags] -= 1
        for t in range(1, steps):
            g["t"] += np.exp(a[t - 1][:, :, None] + w["t"] + (e[t] + b[t])[:, None, :] - total[:, None, None]).sum(0)
            np.subtract.at(g["t"], (tags[t - 1], tags[t]), 1)
        de /= n
        g["t"] /= n
        g["o"], g["ob"] = h.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS), de.sum((0, 1))
        dh = de @ w["o"].T
        dx = self._lstm_back(x, "f", kf, dh[:, :, :HIDDEN], g) + self._lstm_back(x, "b", kb, dh[:, :, HIDDEN:], g)
        np.add.at(g["e"], symbols, dx)
        return float((total - gold).mean()), g

    def train(self, symbols: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 5) -> list[float]:
        """Adam over shuffled batches of windows (rows)."""
        rng, m, v, k, losses = np.random.default_rng(seed), {}, {}, 0, []
        for epoch in range(epochs):
            order, lost = rng.permutation(len(symbols)), 0.0
            for i in range(0, len(order), BATCH):
                at = order[i : i + BATCH]
                value, g = self.loss(symbols[at].T, tags[at].T)
                lost += value * len(at)
                norm = np.sqrt(sum((x * x).sum() for x in g.values()))
                k += 1
                for name, x in g.items():
                    x = x * min(1, 5 / (norm + 1e-9))
                    m[name] = 0.9 * m.get(name, 0) + 0.1 * x
                    v[name] = 0.99 * v.get(name, 0) + 0.01 * x * x
                    self.w[name] = self.w[name] - rate * 0.8**epoch * (m[name] / (1 - 0.9**k)) / (np.sqrt(v[name] / (1 - 0.99**k)) + 1e-8)
            losses.append(lost / max(1, len(order)))
        return losses

    def advance(self, best: np.ndarray | None, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scores of the best ways to each tag after further emissions, and each step's best tag before."""
        back, t = np.zeros((len(e), TAGS), np.int8), self.w["t"]
        for k in range(len(e)):
            if best is None:
                best = e[k]
            else:
                s = best[:, None] + t
                back[k] = s.argmax(0)
                best = s.max(0) + e[k]
        return best, back

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """The model's valid spans of each text, before they are held against the patterns'. Windows are scored some hundreds at a time; a position's scores are used up as soon
        as no further window holds it, so what stays of a run of windows, of any length, is a byte for each tag of a position."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        run, at, short, held = None, -1, [], 0

        def end() -> None:
            nonlocal held
            scores = run.ended(texts[at])
            if scores is None:
                out[at].extend(_decoded(run.tags(), run.first, texts[at]))
            else:
                short.append((at, run.first, scores))
                held += len(scores)

        def settle() -> None:
            nonlocal held
            for (i, first, _), tags in zip(short, self.viterbi_of([x for _, _, x in short]), strict=True):
                out[i].extend(_decoded(tags, first, texts[i]))
            short.clear()
            held = 0

        for part in _batched(texts):
            e = self.emissions(np.concatenate([symbols for _, _, symbols in part]).T)
            for k, (i, s) in enumerate((i, s) for i, starts, _ in part for s in starts.tolist()):
                if run is not None and (i != at or s > run.last + STEP):
                    end()
                    run = None
                run, at = run or _Run(self, s), i
                run.window(s, e[:, k])
            if held > HELD:
                settle()
        if run is not None:
            end()
        settle()
        return [sorted(spans) for spans in out]

    def viterbi_of(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """The best tags of several sequences of emissions at once, those of like length together."""
        out: list = [None] * len(scores)
        order = sorted(range(len(scores)), key=lambda k: len(scores[k]))
        for a in range(0, len(order), WINDOWS):
            part = order[a : a + WINDOWS]
            size = np.array([len(scores[k]) for k in part])
            e, row = np.zeros((size[-1], len(part), TAGS)), np.arange(len(part))
            for r, k in enumerate(part):
                e[: size[r], r] = scores[k]
            best, back = e[0], np.zeros(e.shape, np.int8)
            for t in range(1, len(e)):
                s = best[:, :, None] + self.w["t"]
                back[t] = s.argmax(1)
                best = np.where((t < size)[:, None], s.max(1) + e[t], best)
            tags = np.zeros((len(e), len(part)), np.int8)
            now = best.argmax(1)
            for t in range(len(e) - 1, -1, -1):
                tags[t] = now
                now = np.where(t < size, back[t, row, now], now)
            for r, k in enumerate(part):
                out[k] = tags[: size[r], r]
        return out

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """The best tags of one sequence of emissions."""
        return _traced(*self.advance(None, e))


def _traced(best: np.ndarray, back: np.ndarray) -> np.ndarray:
    tags = np.zeros(len(back), np.int8)
    tags[-1] = best.argmax()
    for t in range(len(back) - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags


def _batched(texts: list[str]) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """Windows of the texts in order, some hundreds at a time: text, starts, symbols (window, character)."""
    held, n = [], 0
    for i, text in enumerate(texts):
        starts = _starts(text)
        if len(starts):
            padded = np.concatenate([_symbols(text), np.full(WIDTH, SYMBOLS, np.int8)])
            for k in range(0, len(starts), WINDOWS):
                part = starts[k : k + WINDOWS]
                held.append((i, part, padded[part[:, None] + np.arange(WIDTH)]))
                n += len(part)
                if n >= WINDOWS:
                    yield held
                    held, n = [], 0
    if held:
        yield held


class _Run:
    """Overlapping windows of one text, read in order: a position takes the scores of the window in which it lies most centrally."""

    CENTRE = np.minimum(np.arange(WIDTH), np.arange(WIDTH)[::-1])

    def __init__(self, tagger: Tagger, first: int):
        self.tagger, self.first, self.last = tagger, first, first
        self.scores, self.depth = np.zeros((0, TAGS)), np.zeros(0, np.int64)  # of positions from ``last`` on
        self.best, self.back, self.short, self.size = None, [], [], 0

    def _use(self, scores: np.ndarray) -> None:
        self.short.append(scores)
        self.size += len(scores)
        if self.size > LONG:  # from here on nothing of it is kept but a byte for each tag
            for x in self.short:
                self.best, back = self.tagger.advance(self.best, x)
                self.back.append(back)
            self.short = []

    def window(self, s: int, e: np.ndarray) -> None:
        done = s - self.last
        self._use(self.scores[:done])
        held, depth = self.scores[done:], self.depth[done:]
        scores, self.depth = e.copy(), self.CENTRE.copy()
        keep = np.flatnonzero(depth >= self.depth[: len(depth)])
        scores[keep], self.depth[keep] = held[keep], depth[keep]
        self.scores, self.last = scores, s

    def ended(self, text: str) -> np.ndarray | None:
        """The scores of a short run; none of a long one, whose ``tags`` are ready."""
        self._use(self.scores[: len(text) - self.last])
        return None if self.back else np.concatenate(self.short)

    def tags(self) -> np.ndarray:
        return _traced(self.best, np.concatenate(self.back))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def _starts(text: str) -> np.ndarray:
    """Starts of the windows that hold a digit, at-sign or written "at", on a grid of ``STEP``."""
    cells = np.unique(np.fromiter((m.start() // STEP for m in _ANCHOR.finditer(text)), np.int64))
    starts = np.unique((cells[:, None] - np.arange(WIDTH // STEP)).ravel())
    return starts[starts >= 0] * STEP


def _decoded(tags: np.ndarray, first: int, text: str) -> list[tuple[int, int, int]]:
    """Spans of B and I tags; kept if they begin and end between words and hold what their kind needs."""
    out, end = [], 0
    for t in np.flatnonzero(tags % 2 == 1).tolist():
        if t >= end:
            kind, end = (tags[t] - 1) // 2, t + 1
            while end < len(tags) and tags[end] == tags[t] + 1:
                end += 1
            span = text[first + t : first + end]
            before, after = text[first + t - 1 : first + t] if first + t else "", text[first + end : first + end + 1]
            if not before.isalnum() and not after.isalnum() and _plausible(KINDS[kind], span):
                out.append((first + t, int(kind), first + end))
    return out


def _plausible(kind: str, span: str) -> bool:
    if kind == "email":
        return ("@" in span or re.search(_WRITTEN, span) is not None) and "." in span + span.replace(" dot ", ".")
    if kind == "ip":
        parts = re.findall("[0-9]+", span)
        return len(parts) == 4 and all(map(_octet, parts))
    if re.search(r"[^\x20().0-9+-]" if kind == "card" else r"[^\x20()./0-9+-]", span):
        return False
    return _valid(kind, span) if kind == "card" else 9 <= len(digits_of(span)) <= 15 and re.search(r"[()./\x20-]", span) is not None


def _rewritten(kind: int, span: str, rng: np.random.Generator) -> str:
    """Another written form of a labelled span."""
    if kind == 0:
        return span.replace("@", rng.choice([" at ", " (at) ", " [at] ", "@ ", " @ "]))
    if kind == 1:
        return span
    digits = digits_of(span)
    if kind == 2:
        mark = rng.choice([" ", "-", ".", ""])
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    own = digits[-10:]
    a, b, c = own[:-7], own[-7:-4], own[-4:]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"({a}) {b} {c}", f"{a}/{b}-{c}"])


def fit(texts: list[str], seed: int = 11) -> Tagger:
    """Train on the patterns' spans of ``texts``, half of them in other written forms."""
    rng, rows = np.random.default_rng(seed), []
    for text in texts:
        every = base_spans(text)
        ends = [0, *itertools.accumulate((e for _, _, e in every), max)]
        spans = [s for s, end in zip(every, ends) if s[0] >= end]
        for rewrite in (False, True):
            out, tags, at = [], [], 0
            for s, kind, e in spans:
                span = _rewritten(kind, text[s:e], rng) if rewrite else text[s:e]
                out += [text[at:s], span]
                tags += [np.zeros(s - at, np.int64), np.array([1 + 2 * kind] + [2 + 2 * kind] * (len(span) - 1))]
                at = e
            out.append(text[at:])
            tags.append(np.zeros(len(text) - at, np.int64))
            whole = "".join(out)
            symbols = np.concatenate([_symbols(whole), np.full(WIDTH, SYMBOLS, np.int8)])
            marks = np.concatenate([*tags, np.zeros(WIDTH, np.int64)])
            rows += [(symbols[i : i + WIDTH], marks[i : i + WIDTH]) for i in _starts(whole)]
    tagger = Tagger.new()
    if rows:
        keep = rng.permutation(len(rows))[:TRAINED]
        tagger.train(np.stack([rows[i][0] for i in keep]), np.stack([rows[i][1] for i in keep]))
    return tagger


def learn(docs: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> Tagger:
    """Fit on a hashed sample of the texts with a digit or at-sign outside the held-out fold."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & (F.length("text") <= longest) & F.col("text").rlike("[0-9@]"))
    n = texts.count()
    rate = min(1.0, sample / max(1, n))
    rows = texts.where(sampled(rate, "doc_id", "pii")).collect()  # bounded by ``sample``
    return fit([r["text"] for r in sorted(rows)])


def apart(more: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans of ``more`` that overlap none of ``base``, which is sorted: of those that begin before a span's end, the greatest end tells."""
    starts, ends = [s for s, _, _ in base], [0, *itertools.accumulate((e for _, _, e in base), max)]
    return [s for s in more if ends[bisect.bisect_left(starts, s[2])] <= s[0]]


def find(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, base and spans as arrays of (kind, start, end)."""
    span = "array<struct<kind:string,start:int,end:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        shown = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]
        for batch in batches:
            for part in slices(batch, 2048):
                texts = [t or "" for t in part["text"].to_pylist()]
                base = [base_spans(t) for t in texts]
                more = tagger.spans(texts)
                every = [sorted([*b, *apart(m, b)]) for b, m in zip(base, more, strict=True)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(map(shown, base), kind), pa.array(map(shown, every), kind)], ["doc_id", "base", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id long, base {span}, spans {span}")


def op9_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find(docs, learn(docs))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(k).eqNullSafe)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
