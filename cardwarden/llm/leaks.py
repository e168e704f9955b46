"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Words are compared without case and ASCII punctuation.  An item of n words is leaked by a text that
holds a stretch within k = n // 5 word edits of it (similarity 0.8).  Such a stretch lacks at most 2k
of the item's n - 1 word pairs, so it has one of any 2k + 1 of them, and n - 1 - 2k of the benchmark's
pairs within n + k words.  Places are looked at where one of the item's 2k + 1 rarest pairs stands and
pairs lie that dense; both tests lose nothing.  There every item-sized window that could begin the
stretch is embedded by the CGK random walk, which maps word edits to differing positions; sampled
positions of the walk are the LSH key, repeated often enough to reach the target recall on windows
with the most edits allowed.  Windows that meet an item are verified by their exact edit distance.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import LOWER, each_bytes, map_batches

MIN_WORDS = 5
EDITS_PER_WORD = 5          # one edit is allowed for so many words of an item
SAMPLED = 2                 # positions of the walk that make one key
RECALL = 0.99
TRIALS, FIRST_ROUNDS, MAX_ROUNDS = 300, 16, 256
BLOCK_ITEMS, BLOCK_CHARS = 5_000, 8_000_000
WORD_CACHE = 1 << 16
ODD = np.uint64(0x9E3779B97F4A7C15)
PUNCTUATION = string.punctuation.encode()


def plain_words(text: bytes | None) -> list[bytes]:
    return text.translate(LOWER, PUNCTUATION).split() if text else []


def allowed(n):
    return n // EDITS_PER_WORD


def least_edits(item: list, region: list) -> int:
    """Smallest edit distance of the item to any stretch of the region (bit-parallel columns)."""
    m = len(item)
    masks: dict = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = m
    for w in region:
        equal = masks.get(w, 0)
        diagonal = (((equal & up) + up) ^ up) | equal
        more = down | (full & ~(diagonal | up))
        less = up & diagonal
        score += bool(more & top) - bool(less & top)
        more, less = (more << 1) & full, (less << 1) & full
        up = less | (full & ~(equal | down | more))
        down = more & (equal | down)
        best = min(best, score)
    return best


def walk_keys(windows: np.ndarray, rounds: int, seed: int) -> np.ndarray:
    """(rounds, windows) keys: sampled positions of each window's CGK random walk.

    The walk reads a word, and steps on or stays by a random bit of (step, word); beyond the end it
    reads a blank.  The same seed gives items and windows the same walk and samples.
    """
    count, n = windows.shape
    rng = np.random.default_rng(seed + n)
    padded = np.concatenate([windows, np.zeros((count, 1), dtype=np.uint64)], axis=1)
    rows, keys = np.arange(count), np.zeros((rounds, count), dtype=np.uint64)
    for r in range(rounds):
        odd = rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        sampled = set(rng.choice(3 * n, SAMPLED, replace=False).tolist())
        at = np.zeros(count, dtype=np.int64)
        for j in range(max(sampled) + 1):
            word = padded[rows, at]
            if j in sampled:
                keys[r] = (keys[r] ^ word) * ODD + np.uint64(j)
            at = np.minimum(at + ((word * odd[j]) >> np.uint64(63)).astype(np.int64), n)
    return keys


def rounds_needed(n: int, seed: int) -> int:
    """Repetitions that meet RECALL on windows of n words with the most edits allowed.

    Measured on invented words with random insertions, deletions and replacements.
    """
    k = allowed(n)
    if not k:
        return 1
    rng = np.random.default_rng(seed)
    items = rng.integers(1, 1 << 62, (TRIALS, n), dtype=np.uint64)
    changed = np.zeros_like(items)
    for t in range(TRIALS):
        words = items[t].tolist()
        for _ in range(k):
            at, kind = int(rng.integers(len(words))), int(rng.integers(3))
            if kind == 0 and len(words) > 1:
                del words[at]
            elif kind == 1:
                words[at] = int(rng.integers(1, 1 << 62))
            else:
                words.insert(at, int(rng.integers(1, 1 << 62)))
        words = (words + rng.integers(1, 1 << 62, n).tolist())[:n]
        changed[t] = np.array(words, dtype=np.uint64)
    rounds = FIRST_ROUNDS
    while True:
        met = walk_keys(items, rounds, seed) == walk_keys(changed, rounds, seed)
        reached = np.flatnonzero(np.logical_or.accumulate(met, axis=0).mean(1) >= RECALL)
        if len(reached):
            return int(reached[0]) + 1
        if rounds >= MAX_ROUNDS:
            raise RuntimeError(f"windows of {n} words miss a recall of {RECALL} after {rounds} rounds")
        rounds *= 2


class Block:
    """The index of one bounded block of benchmark items, shipped to every task."""

    def __init__(self, items: list[tuple], seed: int = 7):
        self.seed, self.ids, self.words, by_length = seed, [], [], {}
        for key, text in items:
            words = plain_words(text.encode("utf-8", "replace"))
            if len(words) < MIN_WORDS:
                continue
            by_length.setdefault(len(words), []).append(len(self.ids))
            self.ids.append(key)
            self.words.append(np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64))
        own = [w[:-1] * ODD + w[1:] for w in self.words]
        self.pairs = np.unique(np.concatenate(own)) if own else np.zeros(0, dtype=np.uint64)
        # Every place of a pair in an item: which pair, which item, where in the item.
        self.pair = np.searchsorted(self.pairs, np.concatenate(own)) if own else np.zeros(0, dtype=np.int64)
        self.item = np.repeat(np.arange(len(own)), [len(p) for p in own])
        self.offset = np.concatenate([np.arange(len(p)) for p in own]) if own else np.zeros(0, dtype=np.int64)
        self.length = np.array([len(w) for w in self.words], dtype=np.int64)
        self.tables = {}
        for n, members in sorted(by_length.items()):
            rounds = rounds_needed(n, seed)
            keys = walk_keys(np.stack([self.words[i] for i in members]), rounds, seed)
            order = np.argsort(keys, axis=1, kind="stable")
            self.tables[n] = (rounds, np.take_along_axis(keys, order, 1), np.array(members)[order])

    def _anchors(self, common: np.ndarray) -> np.ndarray:
        """The 2k + 1 places of each item whose pairs are the rarest, as a mask; ``common`` counts pairs."""
        order = np.lexsort((self.offset, common[self.pair], self.item))
        first = np.concatenate(([0], np.cumsum(self.length - 1)[:-1]))
        rank = np.arange(len(order)) - first[self.item[order]]
        mask = np.zeros(len(order), dtype=bool)
        mask[order] = rank <= 2 * allowed(self.length[self.item[order]])
        return mask

    def _spots(self, words: np.ndarray, doc: np.ndarray, starts_of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(n, starts): where a stretch near an item of n words may begin."""
        pairs = words[:-1] * ODD + words[1:]
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        here = (self.pairs[at] == pairs) & (doc[:-1] == doc[1:])
        place = np.flatnonzero(here)
        which = at[place]
        common = np.bincount(which, minlength=len(self.pairs))
        chosen = np.flatnonzero(self._anchors(common))
        chosen = chosen[np.argsort(self.pair[chosen], kind="stable")]
        begin, end = (np.searchsorted(self.pair[chosen], np.arange(len(self.pairs)), s) for s in ("left", "right"))
        so_far = np.concatenate(([0], np.cumsum(here)))
        for cut in range(0, len(place), 1 << 17):
            p, w = place[cut:cut + (1 << 17)], which[cut:cut + (1 << 17)]
            times = end[w] - begin[w]
            spot = np.repeat(p, times)
            entry = chosen[np.repeat(begin[w], times) + np.arange(len(spot)) - np.repeat(np.cumsum(times) - times, times)]
            n = self.length[self.item[entry]]
            k = allowed(n)
            guess = spot - self.offset[entry]
            low = np.maximum(guess - k, starts_of[doc[spot]])
            high = np.minimum(guess + n + k, starts_of[doc[spot] + 1] - 1)
            ok = so_far[np.maximum(high, low)] - so_far[low] >= n - 1 - 2 * k
            low, last, n = low[ok], np.maximum((guess + k)[ok], low[ok]), n[ok]
            for size in np.unique(n):
                a, b = low[n == size], last[n == size]
                marks = np.zeros(len(words) + 1, dtype=np.int32)
                np.add.at(marks, a, 1)
                np.add.at(marks, np.minimum(b + 1, len(words)), -1)
                yield int(size), np.flatnonzero(np.cumsum(marks[:-1]) > 0)

    def near(self, words: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], int]:
        """(document, item) -> edits, over the words of a batch, ``doc`` telling whose they are."""
        if len(words) < 2 or not len(self.pairs):
            return {}
        starts_of = np.searchsorted(doc, np.arange(doc[-1] + 2))
        regions: dict[tuple[int, int], list[int]] = {}
        for n, begins in self._spots(words, doc, starts_of):
            rounds, keys, members = self.tables[n]
            ends = starts_of[doc[begins] + 1]
            for cut in range(0, len(begins), 1 << 15):
                b, e = begins[cut:cut + (1 << 15)], ends[cut:cut + (1 << 15)]
                spots = b[:, None] + np.arange(n)
                windows = np.where(spots < e[:, None], words[np.minimum(spots, len(words) - 1)], np.uint64(0))
                for r, found in enumerate(walk_keys(windows, rounds, self.seed)):
                    left, right = (np.searchsorted(keys[r], found, side) for side in ("left", "right"))
                    for w in np.flatnonzero(right > left):
                        for i in members[r, left[w]:right[w]]:
                            regions.setdefault((int(doc[b[w]]), int(i)), []).append(int(b[w]))
        return self._verified(words, starts_of, regions)

    def _verified(self, words, starts_of, regions) -> dict[tuple[int, int], int]:
        found = {}
        for (d, i), begins in regions.items():
            n = len(self.words[i])
            k, item = allowed(n), self.words[i].tolist()
            best, begins, at = n, sorted(set(begins)), 0
            while at < len(begins) and best:
                low = high = begins[at]
                while at < len(begins) and begins[at] <= high + n:
                    high, at = begins[at], at + 1
                region = words[max(low - 2 * k, starts_of[d]):min(high + n + 2 * k, starts_of[d + 1])]
                best = min(best, least_edits(item, region.tolist()))
            if best <= k:
                found[d, i] = best
        return found


class Digests:
    """Word digests with a bounded memory of recent words."""

    def __init__(self):
        self.seen: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.seen) > WORD_CACHE:
            self.seen.clear()
        found = list(map(self.seen.get, words))
        if None in found:
            for n, w in enumerate(words):
                if found[n] is None:
                    found[n] = self.seen[w] = xxhash.xxh64_intdigest(w)
        return np.array(found, dtype=np.uint64)


def blocks(items: DataFrame, key: str, text: str) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, read by the driver one after the other."""
    held, chars = [], 0
    for row in items.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where("t is not null").toLocalIterator():
        if held and (len(held) >= BLOCK_ITEMS or chars + len(row.t) > BLOCK_CHARS):
            yield Block(held)
            held, chars = [], 0
        held.append((row.k, row.t))
        chars += len(row.t)
    if held:
        yield Block(held)


PIECE = 1 << 17  # words looked at together


def _batch_matches(block: Block, digests: Digests, texts: Iterable[bytes | None]) -> dict[tuple[int, int], int]:
    found, words, docs = {}, [], []

    def flush():
        if words:
            lengths = [len(w) for w in words]
            some = block.near(np.concatenate(words),
                              np.repeat(np.arange(len(words)), lengths))
            found.update({(docs[d], i): edits for (d, i), edits in some.items()})
            words.clear()
            docs.clear()

    size = 0
    for row, text in enumerate(texts):
        own = digests.of(plain_words(text))
        if len(own):
            words.append(own)
            docs.append(row)
            size += len(own)
        if size >= PIECE:
            flush()
            size = 0
    flush()
    return found


def leaked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """(key, item key, n_words, edits) for every row and benchmark item leaked in its whole text.

    ``edits`` is the least word edit distance over the row's verified places.  Items under MIN_WORDS
    words, or null, say nothing about a text and match none; null and empty texts match nothing.
    Repeated rows are each reported; a repeated item reports under each of its keys.
    """
    kind, item_kind = (df.schema[k].dataType.simpleString() for df, k in ((docs, key), (items, item_key)))
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    schema = f"k {kind}, item {item_kind}, n_words bigint, edits bigint"
    arrow_item = None
    out = None
    for block in blocks(items, item_key, item_text):
        digests = Digests()

        def run(batch: pa.RecordBatch, block=block, digests=digests) -> pa.RecordBatch:
            found = sorted(_batch_matches(block, digests, each_bytes(batch, "t")).items())
            at = pa.array([row for (row, _), _ in found], pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("k").take(at), pa.array([block.ids[i] for (_, i), _ in found], arrow_item),
                 pa.array([len(block.words[i]) for (_, i), _ in found], pa.int64()),
                 pa.array([e for _, e in found], pa.int64())], ["k", "item", "n_words", "edits"])

        part = map_batches(rows, run, schema)
        out = part if out is None else out.union(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.select(F.col("k").alias(key), F.col("item").alias(item_key), "n_words", "edits")


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, unchanged; one pass per block of the benchmark."""
    for block in blocks(items, item_key, item_text):
        digests = Digests()

        def run(batch: pa.RecordBatch, block=block, digests=digests) -> pa.RecordBatch:
            gone = {row for row, _ in _batch_matches(block, digests, each_bytes(batch, text))}
            return batch.filter(pa.array([i not in gone for i in range(batch.num_rows)]))

        docs = map_batches(docs, run, docs.schema)
    return docs
