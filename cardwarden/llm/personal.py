"""Personal data: fixed shapes, and a character BiLSTM-CRF trained in numpy on labelled spans.

The network learns what the shapes do not cover: spans of the shapes are given back to their contexts
in other writings (``at`` and ``dot``, brackets, other separators, local telephone numbers), beside the plain
ones and beside numbers that are none.  It reads windows that hold an at-sign, a written-out one, or
enough digits: all the kinds it knows need one of them, so no other window can hold a span.  Windows overlap by half; each is decoded by Viterbi, spans
cut off by a window's edge are left to its neighbour, and the spans of all windows of a text are
reconciled at once, as the non-overlapping set of the largest total confidence.
"""

from __future__ import annotations

import hashlib
import heapq
import random
import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.session import materialise

# The shapes of the base kinds, in their order.
KINDS = ["email", "ip", "card", "phone"]
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# A match of four number groups can only begin where a run of digits begins, so runs are taken whole.
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LEARNED = [f"model_{k}" for k in KINDS]
ORDER = {k: i for i, k in enumerate(KINDS + LEARNED)}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def email_spans(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: found at their at-sign, so a long run of letters is read once."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            end = domain.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and start; matches that fail their test are dropped."""
    found = [("email", s, e) for s, e in email_spans(text)] if "@" in text else []
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
                  if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


# --- windows --------------------------------------------------------------------------------------

WINDOW, STRIDE = 96, 48
LEAST_DIGITS = 4
# An at-sign written out, as far as a dot written out or a plain one follows soon.
WRITTEN = re.compile(r"(?i)[\s\[({<]at[\s\])}>]{1,3}[a-z0-9-]{1,40}[\s\[({<.]{1,2}(?:dot[\s\])}>]|[a-z]{2})")
TAGS = 1 + 2 * len(KINDS)      # 0: outside; 1 + 2k: begins kind k; 2 + 2k: inside kind k
SYMBOLS = 98                   # blank, 95 printable ASCII, other white space, everything else


def codes(text: str) -> np.ndarray:
    """Character classes of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where((points >= 32) & (points < 127), points - 31, np.where(points < 32, 96, 97)).astype(np.uint8)


def windows(code: np.ndarray, text: str = "") -> np.ndarray:
    """Starts of the windows that may hold personal data; of ``text`` written-out at-signs count too."""
    n = len(code)
    if not n:
        return np.zeros(0, dtype=np.int64)
    starts = np.arange(0, max(1, n - STRIDE), STRIDE)
    ends = np.minimum(starts + WINDOW, n)
    digits = np.concatenate(([0], np.cumsum((code >= 17) & (code <= 26))))
    sign = code == 33
    for m in WRITTEN.finditer(text) if "at" in text or "AT" in text or "At" in text else ():
        sign[m.start()] = True
    signs = np.concatenate(([0], np.cumsum(sign)))
    return starts[(digits[ends] - digits[starts] >= LEAST_DIGITS) | (signs[ends] > signs[starts])]


def cut(code: np.ndarray, start: int) -> np.ndarray:
    piece = code[start:start + WINDOW]
    return np.concatenate((piece, np.zeros(WINDOW - len(piece), dtype=np.uint8)))


def tags_of(spans: list[tuple[str, int, int]], start: int) -> np.ndarray:
    tags = np.zeros(WINDOW, dtype=np.int64)
    for kind, s, e in spans:
        if s >= start and e <= start + WINDOW and not tags[s - start:e - start].any():
            tags[s - start:e - start] = 2 + 2 * KINDS.index(kind)
            tags[s - start] = 1 + 2 * KINDS.index(kind)
    return tags


# --- the network ----------------------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _summed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Outer products added over times and windows, in one thread: a thin product gains nothing by more."""
    return np.einsum("tbi,tbj->ij", x, y)


class Tagger:
    """Embedding, one LSTM per direction, a linear layer and CRF transitions, all in numpy."""

    def __init__(self, size: int = 16, embedded: int = 12, seed: int = 3, kind: type = np.float32):
        rng = np.random.default_rng(seed)
        self.size = size
        self.p = {"embed": rng.normal(0, 0.3, (SYMBOLS, embedded)),
                  "out": rng.normal(0, 0.2, (2 * size, TAGS)), "bias": np.zeros(TAGS),
                  "move": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        for d in ("f", "b"):
            self.p[f"w{d}"] = rng.normal(0, 0.25, (embedded + size, 4 * size))
            self.p[f"c{d}"] = np.concatenate((np.ones(size), np.zeros(3 * size)))  # forget gate open at first
        self.kind = kind
        self.p = {k: v.astype(kind) for k, v in self.p.items()}

    def _lstm(self, x: np.ndarray, d: str) -> tuple[np.ndarray, tuple]:
        """x: (time, batch, embedded) in the direction of reading; (outputs, what backward needs)."""
        n, embedded = self.size, x.shape[2]
        w = self.p[f"w{d}"]
        drive = x @ w[:embedded] + self.p[f"c{d}"]  # forget, input and output gates, candidate
        carry = w[embedded:]
        time, batch = x.shape[:2]
        hs, cs = (np.zeros((time + 1, batch, n), self.kind) for _ in range(2))
        gates, inner = (np.empty((time, batch, k * n), self.kind) for k in (3, 2))  # candidate and tanh of the cell
        for t in range(time):
            z = drive[t] + hs[t] @ carry
            gate = gates[t] = 0.5 * np.tanh(0.5 * z[:, :3 * n]) + 0.5
            g = inner[t, :, :n] = np.tanh(z[:, 3 * n:])
            cs[t + 1] = gate[:, :n] * cs[t] + gate[:, n:2 * n] * g
            th = inner[t, :, n:] = np.tanh(cs[t + 1])
            hs[t + 1] = gate[:, 2 * n:] * th
        return hs[1:], (x, hs, cs, gates, inner)

    def _lstm_back(self, down: np.ndarray, kept: tuple, d: str, grads: dict) -> np.ndarray:
        x, hs, cs, gates, inner = kept
        n, embedded = self.size, x.shape[2]
        w = self.p[f"w{d}"]
        back = w[embedded:].T
        f, i, o = (gates[:, :, k * n:(k + 1) * n] for k in range(3))
        g, th = inner[:, :, :n], inner[:, :, n:]
        # What a step's cell and output gradients are multiplied with, for all times at once.
        by_cell = np.concatenate((cs[:-1] * f * (1 - f), g * i * (1 - i), i * (1 - g * g)), axis=2)
        by_out, into_cell = th * o * (1 - o), o * (1 - th * th)
        dz = np.empty((len(x), x.shape[1], 4 * n), self.kind)
        dh = dc = np.zeros(down.shape[1:], self.kind)
        for t in range(len(x) - 1, -1, -1):
            dh = dh + down[t]
            dc = dc + dh * into_cell[t]
            now = dz[t]
            now[:, :n], now[:, n:2 * n], now[:, 3 * n:] = (dc * by_cell[t, :, k * n:(k + 1) * n] for k in range(3))
            now[:, 2 * n:3 * n] = dh * by_out[t]
            dh, dc = now @ back, dc * f[t]
        grads[f"w{d}"][:embedded] += _summed(x, dz)
        grads[f"w{d}"][embedded:] += _summed(hs[:-1], dz)
        grads[f"c{d}"] += dz.sum((0, 1))
        return dz @ w[:embedded].T

    def _scores(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        e = self.p["embed"][x.T]
        hf, kf = self._lstm(e, "f")
        hb, kb = self._lstm(e[::-1], "b")
        h = np.concatenate((hf, hb[::-1]), axis=2)
        return h @ self.p["out"] + self.p["bias"], (h, kf, kb)

    def _forward_backward(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log sums of all paths up to and from each (time, batch, tag), and of whole paths."""
        time = len(s)
        a, b = np.empty_like(s), np.zeros_like(s)
        a[0] = self.p["first"] + s[0]
        for t in range(1, time):
            a[t] = _logsum(a[t - 1][:, :, None] + self.p["move"], 1) + s[t]
        for t in range(time - 2, -1, -1):
            b[t] = _logsum(self.p["move"] + (s[t + 1] + b[t + 1])[:, None, :], 2)
        return a, b, _logsum(a[-1], 1)

    def loss_and_grads(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tags and its gradient."""
        s, (h, kf, kb) = self._scores(x)
        a, b, z = self._forward_backward(s)
        time, batch = len(s), len(x)
        rows, yt = np.arange(batch), y.T
        times = np.arange(time)[:, None]
        gold = self.p["first"][yt[0]] + s[times, rows, yt].sum(0) + self.p["move"][yt[:-1], yt[1:]].sum(0)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        ds = np.exp(a + b - z[:, None])
        grads["first"] += ds[0].sum(0)
        np.add.at(grads["first"], yt[0], -1)
        ds[times, rows, yt] -= 1
        # Sums over places and windows of p(tag, next tag), as products of what leads to and from them.
        low = a[:-1].max(axis=2, keepdims=True)
        high = (s[1:] + b[1:]).max(axis=2, keepdims=True)
        left = np.exp(a[:-1] - low) * np.exp(low + high - z[:, None])
        right = np.exp(s[1:] + b[1:] - high)
        grads["move"] += np.exp(self.p["move"]) * _summed(left, right)
        np.add.at(grads["move"], (yt[:-1], yt[1:]), -1)
        grads["out"] = _summed(h, ds)
        grads["bias"] = ds.sum((0, 1))
        dh = ds @ self.p["out"].T
        dx = self._lstm_back(dh[:, :, :self.size], kf, "f", grads)
        dx += self._lstm_back(dh[::-1, :, self.size:], kb, "b", grads)[::-1]
        np.add.at(grads["embed"], x.T, dx)
        return float((z - gold).mean()), {k: v / batch for k, v in grads.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int, batch: int = 32, rate: float = 0.03, seed: int = 5) -> float:
        """Adam with a falling rate; batches follow a seeded order, so refits agree."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        loss = 0.0
        for step in range(1, steps + 1):
            pick = rng.integers(len(x), size=batch)
            loss, grads = self.loss_and_grads(x[pick], y[pick])
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                m[k], v2[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v2[k] + 0.01 * g * g
                now = rate * (1 - step / (steps + 1))
                self.p[k] -= now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-8)
        return loss

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tags, their posterior probability) of each window, tags by Viterbi."""
        s, _ = self._scores(x)
        a, b, z = self._forward_backward(s)
        sure = np.exp(a + b - z[:, None])
        time, batch = len(s), len(x)
        best, back = self.p["first"] + s[0], np.zeros((time, batch, TAGS), dtype=np.int64)
        for t in range(1, time):
            paths = best[:, :, None] + self.p["move"]
            back[t] = paths.argmax(1)
            best = paths.max(1) + s[t]
        tags = np.zeros((batch, time), dtype=np.int64)
        tags[:, -1] = best.argmax(1)
        for t in range(time - 1, 0, -1):
            tags[:, t - 1] = back[t, np.arange(batch), tags[:, t]]
        return tags, np.take_along_axis(sure, tags.T[:, :, None], 2)[:, :, 0].T


# --- training and scanning ------------------------------------------------------------------------

SAMPLE_ROWS = 400      # rows with spans the network is fitted on, at most
PLAIN_ROWS = 100       # rows without spans beside them, at most
CUT = 512              # characters taken of a row
SAMPLE_WINDOWS = 6_000
COPIES = 4             # times a text with spans is learned from in other writings
STEPS = 800
SURE = 0.88            # mean posterior of an added span's characters
DECODED = 512          # windows decoded together


def stretch(text: str) -> tuple[bool, str, list[tuple[str, int, int]]]:
    """(whether it holds a span, a cut of bounded length, the spans inside it).

    The cut lies around the first span that a window can hold, wherever in the text that is, and so
    that a window begins at the span; without one it begins at the first window of interest.
    """
    spans = base_spans(text)
    first = min((s for _, s, e in spans if e - s <= WINDOW), default=None)
    if first is None:
        starts = windows(codes(text))
        low = int(starts[0]) if len(starts) else 0
    else:
        low = max(first % STRIDE, first - CUT // 2)
        while low < first and any(s < low < e for _, s, e in spans):  # no span is cut in two
            low += STRIDE
    high = min([low + CUT, *[s for _, s, e in spans if low < s < low + CUT < e and s != first]])
    inside = [(k, s - low, e - low) for k, s, e in spans if low <= s and e <= high]
    return first is not None, text[low:high], inside


def labelled_sample(docs: DataFrame, key: str, text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Cuts of texts with their spans of the fixed shapes: of all rows that hold a span the SAMPLE_ROWS
    whose keys have the smallest digests, and PLAIN_ROWS of the others with digits or at-signs mixed in.

    Every task hands on no more rows than that.  Only windows of at most SAMPLE_WINDOWS are kept of them.
    """
    like = r"@|[0-9]{3}|[0-9]\.[0-9]|\+[0-9]|(?:[0-9][ -]?){13}"  # what any span of the fixed shapes has
    rows = docs.where(F.col(f"`{text}`").rlike(like)).select(
        F.xxhash64(F.col(f"`{key}`"), F.lit(7)).alias("h"), F.xxhash64(F.col(f"`{text}`")).alias("g"),
        F.col(f"`{text}`").alias("t"))
    most = {True: SAMPLE_ROWS, False: PLAIN_ROWS}

    def least(batches):
        best = {True: [], False: []}
        for batch in batches:
            for h, g, t in zip(*[batch.column(c).to_pylist() for c in ("h", "g", "t")]):
                has, piece, spans = stretch(t)
                best[has].append((h, g, has, piece, listed(spans)))
            best = {has: heapq.nsmallest(most[has], found) for has, found in best.items()}
        found = best[True] + best[False]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["h", "g", "has", "t", "spans"])

    small = materialise(rows.mapInArrow(least, "h bigint, g bigint, has boolean, t string, spans string"), "labelled")
    picked = {has: small.where(F.col("has") == has).orderBy("h", "g").limit(n).collect() for has, n in most.items()}
    share, plain, mixed = SAMPLE_ROWS // PLAIN_ROWS, picked[False], []
    for i in range(0, len(picked[True]), share):
        mixed += picked[True][i:i + share] + plain[i // share:i // share + 1]
    mixed += plain[-(-len(picked[True]) // share):]
    return [(r.t, [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]) for r in mixed]


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choices("0123456789", k=n))


def _card(rng: random.Random) -> str:
    body = rng.choice("3456") + _digits(rng, 14)
    return body + next(c for c in "0123456789" if luhn(body + c))


def rewritten(kind: str, span: str, rng: random.Random) -> str:
    """A span of a kind in a writing that no fixed shape covers; numbers are drawn anew."""
    if kind == "email":
        local, domain = span.rsplit("@", 1)
        at, dot = rng.choice([(" at ", " dot "), ("(at)", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "),
                              (" @ ", "."), (" AT ", " DOT "), (" at ", "."), ("{at}", "{dot}")])
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        dot = rng.choice(["[.]", "(.)", " . ", " dot ", "[dot]"])
        return dot.join(str(rng.randrange(256)) for _ in range(4))
    if kind == "card":
        number, gap = _card(rng), rng.choice([".", "/", "  ", "_", " - "])
        return gap.join(number[i:i + 4] for i in range(0, 16, 4))
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{a} {b} {c}", f"0{a}/{b}{c}", f"({a}) {b} {c}",
                       f"+{rng.randint(1, 99)}/{a}/{b}{c}", f"0{a}-{b}{c}", f"1 {a} {b} {c}"])


def harmless(rng: random.Random) -> str:
    """Numbers and words that look a little like personal data and are none."""
    n = rng.randint
    return rng.choice([
        lambda: f"{n(1900, 2099)}-{n(1, 12):02d}-{n(1, 28):02d}", lambda: f"{n(1, 28)}.{n(1, 12)}.{n(1900, 2099)}",
        lambda: f"{n(0, 23):02d}:{n(0, 59):02d}:{n(0, 59):02d}", lambda: f"{n(1, 999)},{n(0, 999):03d},{n(0, 999):03d}.{n(0, 99):02d}",
        lambda: f"v{n(0, 20)}.{n(0, 20)}.{n(0, 20)}", lambda: _digits(rng, n(4, 12)), lambda: f"{n(1900, 2099)}-{n(1900, 2099)}",
        lambda: f"{n(0, 99)}.{_digits(rng, 6)}", lambda: f"{n(1, 99)} at {n(1, 99)} per cent", lambda: f"section {n(1, 20)}.{n(1, 20)}.{n(1, 20)}",
        lambda: f"{n(1000, 9999)} x {n(1000, 9999)}", lambda: f"look at the dot {n(100, 9999)}", lambda: f"${n(1, 9999)}.{n(0, 99):02d}",
        lambda: f"{_digits(rng, 4)} {_digits(rng, 4)} {_digits(rng, 4)} {n(1, 9)}{_digits(rng, 2)}", lambda: f"ISBN 978-{n(0, 9)}-{_digits(rng, 4)}-{_digits(rng, 4)}"])()


def rewritten_text(text: str, spans: list[tuple[str, int, int]], rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its spans in other writings, with harmless numbers strewn in, and where the spans are."""
    out, found, at, size = [], [], 0, 0

    def add(piece: str) -> None:
        nonlocal size
        out.append(piece)
        size += len(piece)

    for kind, s, e in sorted(spans, key=lambda x: x[1]):
        if s < at:
            continue
        add(text[at:s])
        if rng.random() < 0.3:
            add(harmless(rng) + " ")
        other = rewritten(kind, text[s:e], rng) if rng.random() < 0.85 else text[s:e]
        found.append((kind, size, size + len(other)))
        add(other)
        if rng.random() < 0.3:
            add(" " + harmless(rng))
        at = e
    add(text[at:])
    return "".join(out), found


def with_writings(labelled: list[tuple[str, list[tuple[str, int, int]]]], copies: int = COPIES, seed: int = 11) -> list:
    """Every text plain and, ``copies`` times, in other writings; texts without spans get harmless numbers."""
    rng, out = random.Random(seed), []
    for text, spans in labelled:
        out.append((text, spans))
        for _ in range(copies if spans else 1):
            if spans:
                out.append(rewritten_text(text, spans, rng))
            else:
                words = text.split(" ")
                for _ in range(3):
                    words.insert(rng.randrange(len(words) + 1), harmless(rng))
                out.append((" ".join(words), []))
    rng.shuffle(out)
    return out


def train(labelled: list[tuple[str, list[tuple[str, int, int]]]], steps: int = STEPS) -> Tagger | None:
    """A tagger fitted on labelled texts and their other writings; None without any window to learn from."""
    x, y = [], []
    for text, spans in with_writings(labelled):
        code = codes(text)
        for start in windows(code, text)[:SAMPLE_WINDOWS - len(x)]:
            x.append(cut(code, start))
            y.append(tags_of(spans, start))
    if not any(t.any() for t in y):
        return None
    tagger = Tagger()
    tagger.fit(np.stack(x), np.stack(y), steps)
    return tagger


def window_spans(tags: np.ndarray, sure: np.ndarray, start: int, length: int) -> list[tuple[float, str, int, int]]:
    """(confidence, kind, start, end) of one decoded window; spans at an inner edge are the neighbour's."""
    found, i = [], 0
    while i < WINDOW:
        if not tags[i]:
            i += 1
            continue
        kind, j = (tags[i] - 1) // 2, i + 1
        while j < WINDOW and tags[j] == 2 + 2 * kind:
            j += 1
        s, e = start + i, start + j
        if e <= length and (i > 0 or start == 0) and (j < WINDOW or e == length):
            found.append((float(sure[i:j].mean()), KINDS[kind], s, e))
        i = j
    return found


def reconciled(spans: list[tuple[float, str, int, int]]) -> list[tuple[float, str, int, int]]:
    """The non-overlapping spans of the largest total confidence; ties go to the earlier ones."""
    spans = sorted({(k, s, e): (c, k, s, e) for c, k, s, e in sorted(spans)}.values(), key=lambda x: (x[3], x[2], x[1]))
    ends = [e for *_, e in spans]
    best: list[tuple[float, list]] = [(0.0, [])]
    links = []
    for i, (c, _, s, _) in enumerate(spans):
        before = bisect_right(ends, s, 0, i)
        take = best[before][0] + c
        links.append((take > best[i][0], before))
        best.append((max(take, best[i][0]), []))
    out, i = [], len(spans)
    while i:
        taken, before = links[i - 1]
        if taken:
            out.append(spans[i - 1])
            i = before
        else:
            i -= 1
    return out[::-1]


AT_WORD = re.compile(r"(?i)\s*[\[({<]\s*at\s*[\])}>]\s*|\s+at\s+|\s*@\s*")
DOT_WORD = re.compile(r"(?i)\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\s*\.\s*")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")


def plain(text: str) -> str:
    """Written-out signs as signs."""
    return DOT_WORD.sub(".", AT_WORD.sub("@", text))


def plausible(text: str, kind: str) -> bool:
    """What a span must have whatever the network says, read with written-out signs as signs."""
    digits = re.sub("[^0-9]", "", text)
    if kind == "email":
        return EMAIL.fullmatch(plain(text)) is not None
    if kind == "ip":
        parts = plain(text).split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if re.search(r"[^0-9\s().+/_-]", text) or text == digits:
        return False
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def learned_spans(texts: list[str | None], base: list[list[tuple[str, int, int]]], tagger: Tagger) -> list[list[tuple[str, int, int]]]:
    """Per text, spans the network adds beside the base spans; no more than ``DECODED`` windows are held."""
    raw: list[list] = [[] for _ in texts]
    held: list[tuple[int, int, int, np.ndarray]] = []

    def decode() -> None:
        tags, sure = tagger.decode(np.stack([c for *_, c in held]))
        for (n, start, length, _), t, p in zip(held, tags, sure):
            if t.any():
                raw[n].extend(x for x in window_spans(t, p, start, length) if x[0] >= SURE)
        held.clear()

    for n, text in enumerate(texts):
        code = codes(text or "")
        for start in windows(code, text or ""):
            held.append((n, int(start), len(code), cut(code, start)))
            if len(held) == DECODED:
                decode()
    if held:
        decode()
    out = []
    for n, spans in enumerate(raw):
        taken = sorted((s, e) for _, s, e in base[n])
        starts, reach, far = [s for s, _ in taken], [], 0
        for _, e in taken:
            far = max(far, e)
            reach.append(far)
        keep = []
        for x in spans:
            before = bisect_left(starts, x[3])  # base spans that begin before this one ends
            if plausible(texts[n][x[2]:x[3]], x[1]) and not (before and reach[before - 1] > x[2]):
                keep.append(x)
        out.append([(f"model_{k}", s, e) for _, k, s, e in reconciled(keep)])
    return out


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (ORDER[x[0]], x[1], x[2])))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", tagger: Tagger | None = None) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, n_model, base_sha256, spans) of every row's whole text.

    Spans are kind:start:end in code points, end exclusive, by kind as listed and start; the network's
    kinds begin with ``model_``.  Without a tagger one is fitted on a bounded sample of ``docs``; a table
    in which no row holds a span of the fixed shapes gets none.  Null and empty texts have no spans, texts of any
    length are read whole.  Repeated rows are scanned each; other columns, whatever their names, are not read; an
    empty table gives no rows.
    """
    tagger = tagger or train(labelled_sample(docs, key, text))
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    counted = [f"n_{k}" for k in KINDS]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column("t").to_pylist()
                base = [base_spans(t) if t else [] for t in texts]
                more = learned_spans(texts, base, tagger) if tagger else [[] for _ in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("k"), *[pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64()) for k in KINDS],
                     pa.array([len(m) for m in more], pa.int64()),
                     pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base]),
                     pa.array([listed(b + m) for b, m in zip(base, more)])],
                    ["k", *counted, "n_model", "base_sha256", "spans"])

    schema = f"k {kind}, {', '.join(c + ' bigint' for c in counted)}, n_model bigint, base_sha256 string, spans string"
    return rows.mapInArrow(run, schema).withColumnRenamed("k", key)
