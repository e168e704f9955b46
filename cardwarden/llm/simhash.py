"""Near duplicates by SimHash fingerprints over an inverted index of positional bytes.

Two fingerprints that differ in at most 3 of 64 bits differ in at most 3 of 8 bytes, so they share
at least 5 positional bytes.  Of any 5 byte positions, 3 fall into one half of the fingerprint;
the index therefore has one posting list per triple of positions inside a half (8 triples) and
value of the three bytes.  Members of a list are paired inside the task, their shared positional
bytes are tallied, pairs with 5 or more are kept and verified bit by bit.  A list hands on a
spanning forest of its links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import as_bytes, attach, lower_words, map_batches
from cardwarden.llm.components import components
from cardwarden.session import materialise

SHINGLE = 3
SEED = 42
MAX_BITS = 3
LEAST_SHARED = 8 - MAX_BITS
TRIPLES = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]
# Longer posting lists are split by two more bytes; see refined().
LIST_ROWS = 4096
SLICE = 1 << 16


def simhash(words: list[bytes]) -> int:
    """Bit j is set when over half of the shingles' digests have it; 0 without words."""
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, n, SLICE):
        digests = np.array([
            xxhash.xxh64_intdigest(b" ".join(words[i:i + SHINGLE]), SEED) for i in range(start, min(n, start + SLICE))
        ], dtype="<u8")
        counts += np.unpackbits(digests.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp bigint) of every row; a null or wordless text has fingerprint 0."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [simhash(lower_words(t)) for t in as_bytes(batch, "t")]
        return pa.RecordBatch.from_arrays([batch.column("k"), pa.array(found, pa.int64())], ["k", "fp"])

    return map_batches(rows, run, f"k {kind}, fp bigint").withColumnRenamed("k", key)


# --- links ----------------------------------------------------------------------------------------

def _linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Tally of shared positional bytes first, bits only for pairs that reach the minimum."""
    apart = x ^ y
    shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(1)
    ok = shared >= LEAST_SHARED
    ok[ok] = np.bitwise_count(apart[ok]) <= MAX_BITS
    return ok


def _forest(nodes: int, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Smallest node of each node's component, by min-labels with pointer jumping."""
    a = np.concatenate(left) if left else np.zeros(0, dtype=np.int64)
    b = np.concatenate(right) if right else np.zeros(0, dtype=np.int64)
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[a], label[b])
        fresh = label.copy()
        np.minimum.at(fresh, label[a], low)
        np.minimum.at(fresh, label[b], low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


def _list_links(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges over all lists of a sorted block: every two members of a list are compared."""
    n = len(key)
    left, right = [], []
    sizes = np.diff(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))))
    for step in range(1, int(sizes.max()) if n else 0):
        at = np.flatnonzero(key[step:] == key[:-step])
        if not len(at):
            break
        ok = _linked(fp[at], fp[at + step])
        left.append(at[ok])
        right.append(at[ok] + step)
        if sum(map(len, left)) > 4 * n:  # keep a forest instead of the pairs seen so far
            root = _forest(n, left, right)
            more = np.flatnonzero(root != np.arange(n))
            left, right = [root[more]], [more]
    root = _forest(n, left, right)
    child = np.flatnonzero(root != np.arange(n))
    return fp[root[child]], fp[child]


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


MASKS = np.array([sum(1 << b for b in bits) for k in range(1, MAX_BITS + 1) for bits in combinations(range(24), k)],
                 dtype=np.int64)


def _cube_links(fp: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges of one list whose members share 5 bytes and differ within the 24 bits ``rest``.

    Neighbours are looked up instead of compared, so the work is the members times the 2,324 masks
    of up to 3 bits, however long the list; it has 2^24 members at most.
    """
    order = np.argsort(rest)
    fp, rest = fp[order], rest[order]
    label = np.arange(len(rest))
    while True:
        before = label.copy()
        for mask in MASKS:
            at = np.minimum(np.searchsorted(rest, rest ^ mask), len(rest) - 1)
            hit = rest[at] == rest ^ mask
            label[hit] = np.minimum(label[hit], label[at[hit]])
        label = label[label]
        if (label == before).all():
            child = np.flatnonzero(label != np.arange(len(label)))
            return fp[label[child]], fp[child]


def _block_links(key: np.ndarray, fp: np.ndarray, rest: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links of a sorted block of whole lists."""
    edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.repeat(np.diff(edges), np.diff(edges))
    for first in np.unique(key[size > LIST_ROWS]):
        own = key == first
        yield _edge_batch(*_cube_links(fp[own], rest[own]))
    few = size <= LIST_ROWS
    yield _edge_batch(*_list_links(key[few], fp[few]))


def _links_of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp, rest) sorted by key; a list cut by a batch's end waits for its rest."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append((batch.column("key").to_numpy(), batch.column("fp").to_numpy().view(np.uint64),
                     batch.column("rest").to_numpy()))
        if held[0][0][0] == held[-1][0][-1]:
            continue
        key, fp, rest = (np.concatenate(x) for x in zip(*held))
        cut = int(np.searchsorted(key, key[-1], "left"))
        yield from _block_links(key[:cut], fp[:cut], rest[:cut])
        held = [(key[cut:], fp[cut:], rest[cut:])]
    if held:
        yield from _block_links(*(np.concatenate(x) for x in zip(*held)))


def _bytes_at(fp: Column, positions: tuple[int, ...]) -> Column:
    value = F.lit(0).cast("bigint")
    for p in positions:
        value = value * 256 + F.shiftrightunsigned(fp, 8 * p).bitwiseAND(255)
    return value


def _postings(fps: DataFrame) -> DataFrame:
    """(triple, key, fp): one row per fingerprint and triple of byte positions."""
    entries = [F.struct(F.lit(i).alias("triple"), (F.lit(i << 24) + _bytes_at(F.col("fp"), t)).alias("key"))
               for i, t in enumerate(TRIPLES)]
    return fps.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.triple", "e.key")


def _packed(octets: np.ndarray, positions: tuple[int, ...]) -> np.ndarray:
    value = np.zeros(len(octets), dtype=np.int64)
    for p in positions:
        value = value << 8 | octets[:, p]
    return value


def _refined(postings: DataFrame) -> DataFrame:
    """Long lists split by two of the five other bytes, ten ways: two linked members of a list share
    its three bytes and at least two more, so every link is in one of the finer lists."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps, which = batch.column("fp").to_numpy(), batch.column("triple").to_numpy()
        keys, members, rests = [], [], []
        for i in np.unique(which):
            fp = fps[which == i]
            octets = fp.view(np.uint8).reshape(-1, 8)
            others = [p for p in range(8) if p not in TRIPLES[i]]
            for j, pair in enumerate(combinations(others, 2)):
                keys.append((int(i) * 10 + j << 40) | _packed(octets, (*TRIPLES[i], *pair)))
                rests.append(_packed(octets, tuple(p for p in others if p not in pair)))
                members.append(fp)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, members, rests)], ["key", "fp", "rest"])

    return map_batches(postings, run, "key bigint, fp bigint, rest bigint")


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct ``fp`` within 3 bits."""
    postings = _postings(fps)
    sizes = materialise(postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "posting_sizes")
    shared = materialise(postings.join(sizes, "key"), "postings")
    short = shared.where(F.col("n") <= LIST_ROWS).select("key", "fp", F.lit(0).cast("bigint").alias("rest"))
    long = _refined(shared.where(F.col("n") > LIST_ROWS).select("fp", "triple"))

    def paired(lists: DataFrame) -> DataFrame:
        return lists.repartition("key").sortWithinPartitions("key").mapInArrow(_links_of_sorted, "a bigint, b bigint")

    return paired(short).union(paired(long))


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) of every row, repeated rows included.

    ``fingerprint`` is 16 hexadecimal digits; ``component_id`` is the smallest key reachable over
    links of at most 3 bits, the row's own included.  A null or wordless text has fingerprint zero
    and links like any other.  Rows without a key take part; they are passed over as the smallest
    key, which is null only where no member has one.  Other columns are not read.
    """
    rows = materialise(fingerprints(docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text")),
                                    "doc"), "fingerprints")
    fps = materialise(rows.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc").alias("least")), "fps")
    total = rows.count()
    member = materialise(components(links(fps.select("fp"))), "members")
    placed = materialise(fps.join(member.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")), "placed")
    roots = materialise(placed.groupBy("root").agg(
        F.count("*").alias("fps"), F.min("least").alias("component_id")), "roots")
    classes = materialise(attach(placed.select("fp", "n", "root"), roots, "root", "fps", fps.count()).select(
        "fp", "n", "component_id"), "classes")
    out = attach(rows, classes, "fp", "n", total)
    return out.select(F.col("doc").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
