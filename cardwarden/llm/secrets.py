"""Secret scanning: fixed shapes, and random strings that a tokenizer cannot shorten.

Words and names known to a byte-pair vocabulary pack several characters into a token; random
strings do not.  Long unbroken runs are measured in characters per token, after known digests and
identifiers are set aside.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import map_batches

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY_BYTES = 64 << 20
# Words, numbers, white space and the rest, as byte-pair vocabularies split text before merging.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The shapes of the base kinds, in their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "random"]
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
# A run shorter than LEAST_HEX cannot match, so the scan may ask for the length at once; likewise above.
LONG_HEX = re.compile(r"[0-9a-f]{16,}")

LEAST_RANDOM = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
MAX_CHARS_PER_TOKEN = 2.2
# Rare words of 16 to 19 letters pack as badly as 2.0, so such a short word-shaped run must pack worse still.
SHORT_WORD, MAX_CHARS_OF_SHORT_WORD = 20, 1.95
# Set aside: digests by their length in hexadecimal digits (md5, sha1, sha224, sha256, sha384, sha512),
# universal identifiers, plain numbers and dates, names made of words, paths of words.
DIGEST = re.compile(r"(?i)(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})")
UNIVERSAL = re.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
NUMERIC = re.compile(r"[0-9+/_=-]*(?:T[0-9+/_=-]+Z?)?")
# Runs of one class are taken whole and never given back, so a failing match costs one pass.
NAME = re.compile(r"(?:[A-Z]*+[a-z]{2,}+|[A-Z]{2,}+|[0-9]++|[_/+=-]++)++")
NAME_PIECES = re.compile(r"[A-Za-z]+|[0-9]+")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LEAST_WORD = 3.0  # mean letters a piece of a name has
LEAST_LETTERS = 5  # different characters; repetition is not random
LEAST_REST = 4  # characters of a key beside a span found already
# A few characters over and over; a stretch of it is set aside, what is beside it is tested by itself.
REPEATED = re.compile(r"(.{1,8}?)\1{3,}+")
LEAST_REPEATED = 32
SLICE = 512  # characters encoded at once: the merges of one long piece take more than linear time


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed shapes, leftmost and non-overlapping within a kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def named(run: str, vocabulary: Vocabulary) -> bool:
    """Names made of words: pieces of the usual shapes, whose letters the vocabulary packs well."""
    bare = run.strip("-_=+/")
    pieces = NAME_PIECES.findall(bare)
    if not NAME.fullmatch(bare) or sum(map(len, pieces)) < LEAST_WORD * len(pieces):
        return False
    words = NAME_WORDS.findall(bare)
    return sum(map(len, words)) > MAX_CHARS_PER_TOKEN * sum(map(vocabulary.tokens, words))


def known(run: str, vocabulary: Vocabulary) -> bool:
    """Digests, identifiers, numbers, repetitions and names: random-looking or long, but no secrets."""
    bare = run.strip("-_=+/")
    return bool(DIGEST.fullmatch(bare) or UNIVERSAL.fullmatch(bare) or NUMERIC.fullmatch(bare)
                or len(set(bare)) < LEAST_LETTERS or named(run, vocabulary))


def is_random(run: str, vocabulary: Vocabulary) -> bool:
    bare = run.strip("-_=+/")
    short = len(bare) < SHORT_WORD and NAME_WORDS.fullmatch(bare)
    most = MAX_CHARS_OF_SHORT_WORD if short else MAX_CHARS_PER_TOKEN
    return len(bare) <= most * vocabulary.tokens(bare) and not known(run, vocabulary)


class Vocabulary:
    """Byte-pair ranks as bytes, turned into an encoder once per task."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.raw = f.read(MAX_VOCABULARY_BYTES + 1)
        if len(self.raw) > MAX_VOCABULARY_BYTES:
            raise ValueError("vocabulary too large to ship to the tasks")
        self.encoder = None

    def __getstate__(self):
        return {"raw": self.raw, "encoder": None}

    def tokens(self, run: str) -> int:
        if self.encoder is None:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.raw.splitlines()) if a}
            self.encoder = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        return sum(len(self.encoder.encode_ordinary(run[i:i + SLICE])) for i in range(0, len(run), SLICE))


def covered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The union of spans in order, as stretches apart from each other."""
    out: list[list[int]] = []
    for s, e, _ in spans:
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def uncovered(start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of a stretch outside ``taken``, which is in order and apart."""
    parts = []
    for s, e in taken:
        if start < s:
            parts.append((start, s))
        start = max(start, e)
    return parts + [(start, end)] if start < end else parts


def runs(text: str) -> Iterator[tuple[int, int]]:
    """Long unbroken runs without long repeated stretches."""
    for m in CANDIDATE.finditer(text):
        same = [r.span() for r in REPEATED.finditer(text, m.start(), m.end()) if r.end() - r.start() >= LEAST_REPEATED]
        yield from ((s, e) for s, e in uncovered(m.start(), m.end(), same) if e - s >= LEAST_RANDOM)


def random_spans(text: str, vocabulary: Vocabulary, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Runs with few characters per token, as far as they are outside the spans found already.

    What a span leaves of a run is tested by itself, and short parts count with the whole run: a key
    around a stretch of hexadecimal digits is masked to its ends.  Runs and spans are walked side by side.
    """
    found, at = [], 0
    taken = covered(taken)
    for start, end in runs(text):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        near, ahead = [], at
        while ahead < len(taken) and taken[ahead][0] < end:
            near.append(taken[ahead])
            ahead += 1
        whole = is_random(text[start:end], vocabulary)
        if not near:
            if whole:
                found.append((start, end, "random"))
            continue
        for s, e in uncovered(start, end, near):
            part = text[s:e]
            if e - s >= LEAST_RANDOM and is_random(part, vocabulary) or (
                    whole and len(part.strip("-_=+/")) >= LEAST_REST and not named(part, vocabulary)):
                found.append((s, e, "random"))
    return found


def secret_spans(text: str | None, vocabulary: Vocabulary) -> list[tuple[int, int, str]]:
    """All spans of one text in order; null and empty texts have none."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + random_spans(text, vocabulary, base), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redacted(text: str, spans: list[tuple[int, int, str]], mask: str = "[secret]") -> str:
    """The text with every stretch covered by spans replaced by one mask."""
    out, at, end = [], 0, -1
    for s, e, _ in spans:
        if s > end:
            out += [text[at:s], mask]
        at = end = max(e, end)
    return "".join(out) + text[max(at, 0):]


def scan(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, n_random, base_sha256, spans) of every row's whole text.

    Spans are kind:start:end in code points, end exclusive, by start and then kind.  Null and empty
    texts have no spans, texts of any length are read whole in time proportional to it, an empty table gives no
    rows.  Repeated rows are scanned each; other columns, whatever their names, are not read.
    """
    words = Vocabulary(vocabulary)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        all_spans = [secret_spans(t, words) for t in batch.column("t").to_pylist()]
        counts = [[sum(s[2] == k for s in spans) for spans in all_spans] for k in KINDS]
        digests = [hashlib.sha256(listed([s for s in spans if s[2] != "random"]).encode()).hexdigest() for spans in all_spans]
        return pa.RecordBatch.from_arrays(
            [batch.column("k"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests),
             pa.array([listed(s) for s in all_spans])],
            ["k", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    counted = ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_batches(rows, run, f"k {kind}, {counted}, base_sha256 string, spans string").withColumnRenamed("k", key)


def redact(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` masked; rows and columns stay, in their order.  Null and empty
    texts stay as they are; no column is added, so no name can clash.

    ``length`` names a bigint column that holds the text's length; it is counted anew where the
    text changed.
    """
    words = Vocabulary(vocabulary)
    at = docs.columns.index(text)
    measure = docs.columns.index(length) if length in docs.columns else None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        old = batch.column(at).to_pylist()
        new = [t if t is None else redacted(t, secret_spans(t, words)) for t in old]
        if measure is not None:
            lengths = [n if a == b else len(b) for n, a, b in zip(batch.column(measure).to_pylist(), old, new)]
            batch = batch.set_column(measure, batch.schema.field(measure), pa.array(lengths, batch.schema.field(measure).type))
        return batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return map_batches(docs, run, docs.schema)
