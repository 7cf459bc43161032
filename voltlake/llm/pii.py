"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF on top.

The patterns give the base spans. The network adds spans that break a pattern in the ways people and scrapers do:
an at sign or dots written in brackets, dots with blanks around them, a card number in other groups or with
a wrong digit, a phone number without its plus sign or with zeros instead. It is trained in numpy on labelled spans: those that
the patterns find in a bounded sample, card numbers there whose check digit is wrong, and copies of those texts in which
all of them are broken in these ways. Windows without a span, as the sample has them, teach what is none. Its tags are outside, and begin and inside for each
kind; transitions between tags are learned, and those that no span can have are forbidden.

Texts are read in windows that overlap by half. Each is decoded by the best tag sequence. What is
found is reconciled over the whole text: spans of one kind that meet become one, of overlapping
spans the longest stays, base spans come before all. An added span has a digit, an at sign or an "at" in
brackets by definition, so windows with none of them need no decoding; this changes no result.

Defined cases: a null text counts as empty and has no spans; texts are read whole, whatever
their length; a null id stays null; extra columns are ignored; without a labelled span in the
sample the network adds nothing.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end

#: The contract's patterns, written so that no position is tried twice (fixed values).
EMAIL = regex.compile(r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]|[(\[]at[)\]]")
#: What every base span has one of.
PATTERNS_NEED = re.compile(r"[0-9@]")

WINDOW, STRIDE = 64, 32
HIDDEN = 16
#: Tags: outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
#: How much likelier than outside a window's best spans must be, as a log ratio.
CAUTION = 3.0


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(n - 9 if n > 9 else n for n in doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, in order of kind and start."""
    if not PATTERNS_NEED.search(text):
        return []
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


# Characters: 0 beyond the text, 1 other, 2 other letter, then printable ASCII.
N_CHARS = 3 + 95


def char_codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where(points >= 0xC0, 2, 1)
    plain = (points >= 32) & (points < 127)
    codes[plain] = points[plain] - 32 + 3
    return codes


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class Tagger:
    """Bidirectional LSTM and linear-chain CRF over windows of character codes."""

    def __init__(self, seed: int = 7, hidden: int = HIDDEN):
        draw, h = np.random.default_rng(seed), hidden
        self.hidden = h
        self.p = {"tag": draw.normal(0, 0.2, (2 * h, TAGS)), "tag_b": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS)), "start": np.zeros(TAGS)}
        for side in "fb":
            self.p[f"x{side}"] = draw.normal(0, 0.3, (N_CHARS, 4 * h))
            self.p[f"x{side}"][:, h : 2 * h] += 1.0  # forget gates start open
            self.p[f"h{side}"] = draw.normal(0, 0.2, (h, 4 * h))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        allowed = np.ones((TAGS, TAGS), bool)
        for kind in range(len(KINDS)):
            inside = 2 + 2 * kind
            allowed[:, inside] = False
            allowed[[inside - 1, inside], inside] = True
        self.forbidden = np.where(allowed, 0.0, -1e4).astype(np.float32)
        self.no_start = np.where([t > 0 and t % 2 == 0 for t in range(TAGS)], -1e4, 0.0).astype(np.float32)

    def _run(self, codes: np.ndarray, side: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states in reading order, and what the way back needs."""
        n, steps = codes.shape
        wh, h = self.p[f"h{side}"], self.hidden
        order = range(steps) if side == "f" else range(steps - 1, -1, -1)
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out, kept = np.empty((n, steps, h), np.float32), []
        for t in order:
            z = self.p[f"x{side}"][codes[:, t]] + state @ wh
            gates, new = sigmoid(z[:, : 3 * h]), np.tanh(z[:, 3 * h :])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            before, previous = cell, state
            cell = f * cell + i * new
            squashed = np.tanh(cell)
            state = o * squashed
            out[:, t] = state
            if keep:
                kept.append((t, i, f, o, new, before, squashed, previous))
        return out, kept

    def emissions(self, codes: np.ndarray, keep: bool = False):
        forward, kf = self._run(codes, "f", keep)
        backward, kb = self._run(codes, "b", keep)
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.p["tag"] + self.p["tag_b"], both, {"f": kf, "b": kb}

    def _marginals(self, scores: np.ndarray):
        """Log likelihood normaliser, tag and transition marginals of each window."""
        n, steps, _ = scores.shape
        move, start = self.p["move"] + self.forbidden, self.p["start"] + self.no_start
        alpha = np.empty_like(scores)
        alpha[:, 0] = scores[:, 0] + start
        for t in range(1, steps):
            alpha[:, t] = _logsum(alpha[:, t - 1, :, None] + move, 1) + scores[:, t]
        total = _logsum(alpha[:, -1], 1)
        beta = np.zeros_like(scores)
        pairs = np.zeros((TAGS, TAGS), np.float32)
        for t in range(steps - 2, -1, -1):
            ahead = scores[:, t + 1] + beta[:, t + 1]
            pairs += np.exp(alpha[:, t, :, None] + move + ahead[:, None, :] - total[:, None, None]).sum(0)
            beta[:, t] = _logsum(move + ahead[:, None, :], 2)
        return np.exp(alpha + beta - total[:, None, None]), pairs

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        n, steps = codes.shape
        scores, both, kept = self.emissions(codes, keep=True)
        marginals, pairs = self._marginals(scores)
        grad_scores = marginals
        grad_scores[np.arange(n)[:, None], np.arange(steps), tags] -= 1.0
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["start"] += grad_scores[:, 0].sum(0)
        np.add.at(pairs, (tags[:, :-1], tags[:, 1:]), -1.0)
        grad["move"] += pairs
        grad["tag"] += np.einsum("nth,ntk->hk", both, grad_scores)
        grad["tag_b"] += grad_scores.sum((0, 1))
        back = grad_scores @ self.p["tag"].T
        h = self.hidden
        for k, side in enumerate("fb"):
            wh = self.p[f"h{side}"]
            d_state, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for t, i, f, o, new, before, squashed, previous in reversed(kept[side]):
                d_state = d_state + back[:, t, k * h : (k + 1) * h]
                d_cell = d_cell + d_state * o * (1 - squashed**2)
                dz = np.concatenate(
                    [d_cell * new * i * (1 - i), d_cell * before * f * (1 - f), d_state * squashed * o * (1 - o), d_cell * i * (1 - new**2)], axis=1
                )
                np.add.at(grad[f"x{side}"], codes[:, t], dz)
                grad[f"h{side}"] += previous.T @ dz
                d_state, d_cell = dz @ wh.T, d_cell * f
        return {name: g / n for name, g in grad.items()}

    def fit(self, codes: np.ndarray, tags: np.ndarray, epochs: int, rate: float = 0.02, seed: int = 7) -> Tagger:
        """Adam over shuffled batches."""
        draw, first, second, step = np.random.default_rng(seed), {}, {}, 0
        size = 64
        for epoch in range(epochs):
            order = draw.permutation(len(codes))
            for at in range(0, len(order), size):
                rows, step = order[at : at + size], step + 1
                pace = rate * (0.5 ** (3.0 * epoch / epochs))
                for k, g in self.gradients(codes[rows], tags[rows]).items():
                    g = np.clip(g, -5, 5)
                    first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                    second[k] = 0.999 * second.get(k, 0) + 0.001 * g * g
                    self.p[k] -= (pace * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def decode(self, codes: np.ndarray, caution: float = CAUTION) -> np.ndarray:
        """The best tag sequence of each window; all outside unless it wins by ``caution``."""
        scores, _, _ = self.emissions(codes)
        move = self.p["move"] + self.forbidden
        n, steps, _ = scores.shape
        best = scores[:, 0] + self.p["start"] + self.no_start
        plain = best[:, 0].copy()
        came = np.empty((n, steps, TAGS), np.int8)
        for t in range(1, steps):
            paths = best[:, :, None] + move
            came[:, t] = paths.argmax(1)
            best = paths.max(1) + scores[:, t]
            plain += move[0, 0] + scores[:, t, 0]
        tags = np.zeros((n, steps), np.int8)
        tags[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = came[np.arange(n), t, tags[:, t]]
        tags[best.max(1) - plain < caution] = 0
        return tags


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def window_starts(text: str) -> list[int]:
    """Starts of the windows, STRIDE apart, in which a mark begins."""
    found: dict[int, None] = {}
    for m in MARK.finditer(text):
        last = m.start() // STRIDE
        for k in range(max(0, last - WINDOW // STRIDE + 1), last + 1):
            found[k * STRIDE] = None
    return sorted(found)


def cut(codes: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.concatenate([codes, np.zeros(WINDOW, np.int64)])
    return padded[np.array(starts, np.int64)[:, None] + np.arange(WINDOW)] if starts else np.zeros((0, WINDOW), np.int64)


def tag_spans(tags: np.ndarray, at: int) -> list[Span]:
    out: list[Span] = []
    begun = None
    for i, tag in enumerate([*tags.tolist(), 0]):
        if begun is not None and (tag == 0 or tag % 2):
            out.append((begun[0], at + begun[1], at + i))
            begun = None
        if tag % 2:
            begun = (tag // 2, i)
    return out


def reconcile(text: str, base: list[Span], found: list[Span]) -> list[Span]:
    """Base spans, and those found that overlap none of them."""
    merged: list[Span] = []
    for kind, start, end in sorted(set(found)):
        if merged and merged[-1][0] == kind and start < merged[-1][2]:
            merged[-1] = (kind, merged[-1][1], max(end, merged[-1][2]))
        else:
            merged.append((kind, start, end))
    out, taken = list(base), sorted((s, e) for _, s, e in base)
    for kind, start, end in sorted(merged, key=lambda s: (s[1] - s[2], s[1], s[0])):
        end = min(end, len(text))
        at = bisect.bisect(taken, (start, -1))
        near = [*taken[max(0, at - len(KINDS)) : at], *taken[at : at + 1]]
        if MARK.search(text, start, end) and not any(s < end and start < e for s, e in near):
            bisect.insort(taken, (start, end))
            out.append((kind, start, end))
    return sorted(out)


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    found: list[list[Span]] = [[] for _ in texts]
    if tagger:
        waiting: list[tuple[int, int]] = []
        rows: list[np.ndarray] = []

        def flush() -> None:
            for (i, start), tags in zip(waiting, tagger.decode(np.concatenate(rows)), strict=True):
                if tags.any():
                    found[i] += tag_spans(tags, start)
            waiting.clear()
            rows.clear()

        for i, text in enumerate(texts):
            starts = window_starts(text)
            codes = char_codes(text) if starts else None
            for at in range(0, len(starts), 2048):
                part = starts[at : at + 2048]
                waiting += [(i, s) for s in part]
                rows.append(cut(codes, part))
                if len(waiting) >= 2048:
                    flush()
        if waiting:
            flush()
    return [(b, reconcile(t, b, f)) for t, b, f in zip(texts, base, found, strict=True)]


class Sample(NamedTuple):
    codes: np.ndarray
    tags: np.ndarray


def mistyped(text: str) -> list[Span]:
    """Numbers with a card's digits whose check digit is wrong: the sample's own broken spans."""
    out = []
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and not luhn(digits):
            out.append((2, *m.span()))
    return out


def broken(kind: int, span: str, draw: np.random.Generator) -> str:
    """A span of a kind as one that its pattern misses, with other digits."""
    pick = lambda *ways: ways[draw.integers(len(ways))]
    other = lambda text: "".join(str(draw.integers(10)) if "0" <= c <= "9" else c for c in text)
    if kind == 0:
        at = pick("(at)", " (at) ", "[at]", " [at] ")
        name, _, host = span.partition("@")
        return other(name) + at + host.replace(".", pick(".", ".", "[.]", " (dot) "))
    if kind == 1:
        return pick("[.]", " . ", "(.)", ". ").join(str(draw.integers(256)) for _ in range(4))
    if kind == 2:
        digits = other("".join(c for c in span if "0" <= c <= "9"))
        if luhn(digits):
            digits = digits[:-1] + str((int(digits[-1]) + draw.integers(1, 10)) % 10)
        gap = pick("", " ", "-", ".", "/", "  ", "_")
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return pick("", "", "00", "00 ", "(0)") + other(span[1:])


def broken_copy(text: str, spans: list[Span], draw: np.random.Generator) -> tuple[str, list[Span]]:
    """The text with its spans broken, and where they are now."""
    parts, marks, at, size = [], [], 0, 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start < at:
            continue
        new = broken(kind, text[start:end], draw)
        parts += [text[at:start], new]
        size += start - at
        marks.append((kind, size, size + len(new)))
        size, at = size + len(new), end
    return "".join([*parts, text[at:]]), marks


def tagged_windows(text: str, marks: list[Span]) -> Sample:
    starts = window_starts(text)
    label = np.zeros(len(text) + WINDOW, np.int64)
    for kind, start, end in reversed(marks):
        label[start] = 1 + 2 * kind
        label[start + 1 : end] = 2 + 2 * kind
    return Sample(cut(char_codes(text), starts), label[np.array(starts, np.int64)[:, None] + np.arange(WINDOW)])


def labelled_windows(texts: list[str], most: int, copies: int = 4) -> Sample:
    """Windows of the texts, and of ``copies`` broken ones of those with spans, with their tags; at most ``most``.

    Windows with a span come first, up to two thirds, so that rare ones are learned.
    """
    draw, found = np.random.default_rng(7), []
    for text in texts:
        base = base_spans(text)
        taken = [(s, e) for _, s, e in base]
        spans = base + [(k, s, e) for k, s, e in mistyped(text) if not any(a < e and s < b for a, b in taken)]
        versions = [(text, spans)]
        if spans:
            versions += [broken_copy(text, spans, draw) for _ in range(copies)]
        found += [tagged_windows(version, marks) for version, marks in versions]
    if not found:
        return Sample(np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64))
    x, y = np.concatenate([s.codes for s in found]), np.concatenate([s.tags for s in found])
    # A window that starts inside a span sees its begin there.
    first = y[:, 0]
    y[:, 0] = np.where((first > 0) & (first % 2 == 0), first - 1, first)
    order = draw.permutation(len(x))
    spanned = order[y[order].any(axis=1)][: 2 * most // 3]
    plain = order[~y[order].any(axis=1)][: most - len(spanned)]
    rows = draw.permutation(np.concatenate([spanned, plain]))
    return Sample(x[rows], y[rows])


def fit_tagger(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows: int = 600, longest: int = 1 << 16, windows: int = 5000, epochs: int = 10
) -> Tagger | None:
    """A tagger from at most ``rows`` texts that have a digit or an at sign and up to ``longest``
    characters, and at most ``windows`` of their windows."""
    marked = docs.where(F.col(text_col).rlike("[0-9@]") & (F.length(text_col) <= longest))
    marked = marked.select(F.col(text_col).alias("t"), F.xxhash64(F.col(id_col), F.col(text_col), F.lit("pii")).alias("o"))
    chosen = [r.o for r in marked.select("o").distinct().orderBy("o").limit(rows).collect()]
    if not chosen:
        return None
    # The chosen texts alone come to the driver; equal rows once.
    texts = [r.t for r in marked.where(F.col("o") <= chosen[-1]).distinct().orderBy("o", "t").collect()]
    sample = labelled_windows(texts, windows)
    return Tagger().fit(*sample, epochs=epochs) if sample.tags.any() else None


def describe(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find_personal_data(
    docs: DataFrame, tagger: Tagger | None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, the number of base spans of each kind, base_sha256 and spans of every whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()
    counts = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = all_spans(batch["text"].to_pylist(), tagger)
            columns = [pa.array([sum(k == kind for k, _, _ in b) for b, _ in found], pa.int64()) for kind in range(len(KINDS))]
            digests = [hashlib.sha256(describe(b).encode()).hexdigest() for b, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *columns, pa.array(digests, pa.string()), pa.array([describe(s) for _, s in found], pa.string())],
                ["id", *counts, "base_sha256", "spans"],
            )

    schema = f"id {id_type}, {', '.join(f'{c} long' for c in counts)}, base_sha256 string, spans string"
    text: Column = F.coalesce(text_col, F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)
