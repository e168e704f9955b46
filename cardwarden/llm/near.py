"""Near duplicates by shingle similarity, found through SimHash fingerprints of 256 bits.

Texts are sets of word shingles.  A fingerprint has 32 positional bytes; at a similarity of 0.8 two
texts differ in 39 of the 256 bits on average and share 8.5 of the bytes, unlike texts share one in
eight.  The index has posting lists for combinations of two byte positions and their values (three
beyond ``2 ** 24`` texts), as many combinations as make the wanted recall.  Inside a list shared
positional bytes are tallied per pair, pairs below the minimum are dropped, and bits are counted.  A
list hands on a spanning forest of its closest links, never its pairs; links are verified by the exact
similarity of the shingle sets before they join classes.  Pairs that a forest or a long list left out are
then verified too where their texts are still in different classes, so the index alone sets the recall.
They are never rows: texts that closeness holds together meet in cells with their shingle sets, and a cell
hands on at most one link for every two classes it joins.

Texts are compared by their words, A-Z in lower case; those with fewer words than a shingle are one
shingle, those without words are equal to each other and to nothing else.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import attach, each_bytes, hashable, lower_words, map_batches
from cardwarden.llm.components import components
from cardwarden.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.95  # of pairs at the least similarity, by the index
LANES = 4
BYTES = 8 * LANES
WIDE_TEXTS = 1 << 24  # more texts than this are indexed by three bytes
# Least shared bytes and most differing bits of a link: 0.8 leaves 8.5 and 39 on average, and these are four
# deviations of a pair's own spread away.
LEAST_SHARED = 3
MAX_BITS = 62
# Longer posting lists are taken in pieces, whose first members make a list of their own; the pairs that leaves out follow in ``left_out``.
LIST_ROWS = 2048
# Texts held together by closeness are verified in this many pieces, every two of which meet in a cell of their own; pieces have
# about ``PIECE_ROWS`` rows at least and ``LIST_ROWS`` at most, where a row counts as its shingles, ``ROW_SHINGLES`` at least.
PIECES, PIECE_ROWS, ROW_SHINGLES = 32, 32, 1024
SLICE = 1 << 15
WEIGHTS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * WEIGHTS[1]
        x = (x ^ (x >> np.uint64(27))) * WEIGHTS[2]
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """The set of a text's shingles as 64-bit digests in order."""
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    whole = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(size, len(words))):
            whole = _mixed(whole * WEIGHTS[0] + each[i:i + n] + np.uint64(i + 1))
    return np.unique(whole)


def fingerprint(found: np.ndarray) -> np.ndarray:
    """256 bits as four numbers: each is set when over half of the shingles' digests have it."""
    counts = np.zeros((LANES, 64), np.int64)
    for at in range(0, len(found), SLICE):
        part = found[at:at + SLICE]
        for lane in range(LANES):
            with np.errstate(over="ignore"):
                bits = _mixed(part + WEIGHTS[0] * np.uint64(lane + 1))
            counts[lane] += np.unpackbits(bits.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return np.packbits(2 * counts > len(found), axis=1, bitorder="little").view("<i8")[:, 0]


def expected_bits(similarity: float) -> float:
    """Share of bits in which texts of a set similarity differ: the angle of their vectors."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def index_positions(texts: int, similarity: float = SIMILARITY, recall: float = RECALL) -> list[tuple[int, ...]]:
    """Combinations of byte positions, in an order of their own, enough for the recall."""
    size = 2 if texts <= WIDE_TEXTS else 3
    shared = (1 - expected_bits(similarity)) ** (8 * size)
    wanted = math.ceil(math.log(1 - recall) / math.log(1 - shared))
    every = sorted(combinations(range(BYTES), size), key=lambda c: xxhash.xxh64_intdigest(bytes(c)))
    # The first pass uses every position about equally often.
    used, picked = [0] * BYTES, []
    for _ in range(min(wanted, len(every))):
        best = min(range(len(every)), key=lambda i: (sum(used[p] for p in every[i]), i))
        picked.append(every.pop(best))
        for p in picked[-1]:
            used[p] += 1
    return picked


# --- links ----------------------------------------------------------------------------------------

FP = [f"f{i}" for i in range(LANES)]


def _postings(nodes: DataFrame, positions: list[tuple[int, ...]], *more: str) -> DataFrame:
    def value(at: tuple[int, ...], number: int) -> Column:
        key = F.lit(number).cast("bigint")
        for p in at:
            key = key * 256 + F.shiftrightunsigned(F.col(FP[p // 8]), 8 * (p % 8)).bitwiseAND(255)
        return key
    keys = F.array(*[value(at, i) for i, at in enumerate(positions)])
    return nodes.select(F.explode(keys).alias("key"), "nid", *more, *FP)


def _close(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs share enough positional bytes and differ in few bits, and in how many."""
    apart = fp[a] ^ fp[b]
    ok = (apart.view(np.uint8).reshape(len(a), -1) == 0).sum(1) >= LEAST_SHARED
    bits = np.full(len(a), 256)
    bits[ok] = np.bitwise_count(apart[ok].view(np.uint64)).sum(1, dtype=np.int64)
    return bits <= MAX_BITS, bits


def spanning(n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Numbers of the edges of a lightest forest, by every part taking its lightest way out."""
    label, chosen = np.arange(n), []
    order = np.lexsort((b, a, weight))
    rank = np.empty(len(a), np.int64)
    rank[order] = np.arange(len(a))
    open_edges = np.arange(len(a))
    while True:
        la, lb = label[a[open_edges]], label[b[open_edges]]
        open_edges = open_edges[la != lb]
        if not len(open_edges):
            return np.unique(np.concatenate(chosen)) if chosen else np.zeros(0, np.int64)
        best = np.full(n, len(a))
        for side in (a, b):
            np.minimum.at(best, label[side[open_edges]], rank[open_edges])
        taken = order[np.unique(best[best < len(a)])]
        chosen.append(taken)
        x, y = label[a[taken]], label[b[taken]]
        while True:
            low = np.minimum(label[x], label[y])
            fresh = label.copy()
            np.minimum.at(fresh, x, low)
            np.minimum.at(fresh, y, low)
            np.minimum.at(fresh, label[x], low)
            np.minimum.at(fresh, label[y], low)
            fresh = fresh[fresh]
            if (fresh == label).all():
                break
            label = fresh


def _block_links(key: np.ndarray, nid: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    """Forest edges over the lists of a sorted block; every two members of a list, or piece, are compared.

    A row with a key names a list of which a pair was left out: long, or with closer ways round.
    """
    n = len(key)
    edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    begin = np.repeat(edges, np.diff(np.append(edges, n)))
    piece = (np.arange(n) - begin) // LIST_ROWS
    group = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]) | (piece[1:] != piece[:-1]))))
    left, right, weight, short = [], [], [], [key[piece > 0]]

    def forest() -> tuple[np.ndarray, ...]:
        a, b, w = (np.concatenate(v) for v in (left, right, weight))
        kept = spanning(n, a, b, w)
        short.append(np.unique(key[np.delete(a, kept)]))
        return a[kept], b[kept], w[kept]

    def compare(members: np.ndarray, group: np.ndarray) -> None:
        for step in range(1, len(members)):
            at = np.flatnonzero(group[step:] == group[:-step])
            if not len(at):
                return
            a, b = members[at], members[at + step]
            ok, bits = _close(fp, a, b)
            left.append(a[ok])
            right.append(b[ok])
            weight.append(bits[ok])
            if sum(map(len, left)) > 8 * n + 100_000:  # keep a forest instead of the pairs seen so far
                left[:], right[:], weight[:] = ([v] for v in forest())

    compare(np.arange(n), group)
    if piece.any():
        firsts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        compare(firsts, key[firsts])
    if not left:
        left = right = weight = [np.zeros(0, np.int64)]
    a, b, _ = forest()
    ends, lists = np.sort(np.stack([nid[a], nid[b]]), axis=0), np.unique(np.concatenate(short))
    none = [pa.nulls(len(x), pa.int64()) for x in (lists, a)]
    return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in (
        [pa.array(ends[0]), none[0]], [pa.array(ends[1]), none[0]], [none[1], pa.array(lists)])], ["a", "b", "key"])


BLOCK_ROWS = 1 << 16


def _links_of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and fingerprint; a list cut by a block's end waits for its rest, a long one
    goes on in pieces, each with the list's first member."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush(last: bool) -> Iterator[pa.RecordBatch]:
        key, nid, fp = (np.concatenate(x) for x in zip(*held))
        cut = len(key) if last else int(np.searchsorted(key, key[-1], "left"))
        if cut == 0 and len(key) >= BLOCK_ROWS:  # one list longer than a block
            yield _block_links(key, nid, fp)
            held[:] = [(key[:1], nid[:1], fp[:1])]
            return
        if cut:
            yield _block_links(key[:cut], nid[:cut], fp[:cut])
        held[:] = [(key[cut:], nid[cut:], fp[cut:])] if cut < len(key) else []

    for batch in batches:
        if batch.num_rows:
            lanes = np.column_stack([batch.column(c).to_numpy() for c in FP])
            held.append((batch.column("key").to_numpy(), batch.column("nid").to_numpy(), np.ascontiguousarray(lanes)))
            if sum(len(h[0]) for h in held) >= BLOCK_ROWS:
                yield from flush(False)
    if held:
        yield from flush(True)


def candidates(nodes: DataFrame, positions: list[tuple[int, ...]]) -> tuple[DataFrame, DataFrame]:
    """Distinct links (a, b) between nodes (nid, fingerprint), to be verified, and the lists (key) of which
    a pair was left out."""
    lists = _postings(nodes, positions).repartition("key").sortWithinPartitions("key", *FP, "nid")
    found = materialise(lists.mapInArrow(_links_of_sorted, "a bigint, b bigint, key bigint"), "links")
    return found.where("key is null").select("a", "b").distinct(), found.where("key is not null").select("key").distinct()


CELL = ["key", "p", "q"]


def _links_across(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Close pairs of different roots in cells of at most two pieces, sorted by cell; of two pieces, only the
    pairs across.  All of them with ``whole``, else a forest that holds together what they do."""
    held: list[tuple[np.ndarray, ...]] = []

    def pairs(cell, other, root, nid, fp) -> Iterator[pa.RecordBatch]:
        group = np.cumsum(np.concatenate(([0], (cell[1:] != cell[:-1]).any(axis=1))))
        inside = cell[:, 1] == cell[:, 2]
        left, right, weight = [], [], []

        def given(kept: np.ndarray | slice) -> pa.RecordBatch:
            a, b = (np.concatenate(v)[kept] for v in (left, right))
            ends = np.sort(np.stack([nid[a], nid[b]]), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1])], ["a", "b"])

        def forest() -> np.ndarray:
            return spanning(len(nid), *[np.concatenate(v) for v in (left, right, weight)])

        for step in range(1, len(group)):
            same = group[step:] == group[:-step]
            if not same.any():
                break
            a = np.flatnonzero(same & (root[step:] != root[:-step]) & (inside[step:] | (other[step:] != other[:-step])))
            if not len(a):
                continue
            ok, bits = _close(fp, a, a + step)
            if ok.any():
                for v, found in ((left, a[ok]), (right, a[ok] + step), (weight, bits[ok])):
                    v.append(found)
            if sum(map(len, left)) > 8 * len(nid) + 100_000:
                if whole:
                    yield given(slice(None))
                    left, right, weight = [], [], []
                else:
                    kept = forest()
                    left, right, weight = ([np.concatenate(v)[kept]] for v in (left, right, weight))
        if left:
            yield given(slice(None) if whole else forest())

    def flush(last: bool) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(x) for x in zip(*held)]
        new = np.flatnonzero((columns[0][1:] != columns[0][:-1]).any(axis=1)) + 1
        cut = len(columns[0]) if last else int(new[-1]) if len(new) else 0
        yield from pairs(*[c[:cut] for c in columns])
        held[:] = [tuple(c[cut:] for c in columns)]

    for batch in batches:
        if batch.num_rows:
            of = [np.column_stack([batch.column(c).to_numpy() for c in names]) for names in (CELL, FP)]
            held.append((of[0], *[batch.column(c).to_numpy() for c in ("other", "root", "nid")], np.ascontiguousarray(of[1])))
            if sum(len(h[0]) for h in held) >= BLOCK_ROWS:
                yield from flush(False)
    if held:
        yield from flush(True)


def _in_cells(numbered: DataFrame) -> DataFrame:
    """Rows of (key, piece, root) by cells of two pieces of a key, unless all of both is one class."""
    pieces = numbered.groupBy("key", "piece").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    left, right = (pieces.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("piece", "lo", "hi")]) for side in "pq")
    cells = left.join(right, "key").where(
        "piece_p <= piece_q and not (lo_p = hi_p and lo_q = hi_q and lo_p = lo_q)").select(
        "key", F.col("piece_p").alias("p"), F.col("piece_q").alias("q"))
    one, two = (numbered.join(cells.withColumn("piece", F.col(at)), ["key", "piece"]) for at in "pq")
    return one.withColumn("other", F.lit(0)).unionByName(two.where("p < q").withColumn("other", F.lit(1)))


def _sorted_cells(rows: DataFrame) -> DataFrame:
    return rows.repartition(*CELL).sortWithinPartitions(*CELL, "other", "nid")


def left_out(nodes: DataFrame, roots: DataFrame, lists: DataFrame, positions: list[tuple[int, ...]], whole: bool = True) -> DataFrame:
    """Every link (a, b) of the given lists whose ends are not in one class yet, or a forest of each cell's.

    Members are sorted by class and taken in pieces; every two pieces of a list meet in a cell of their
    own, unless both belong to one class.  So a class of any size is compared with the others' members,
    never with itself, and no cell is longer than two pieces.
    """
    rows = nodes.join(roots, "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    keyed = _postings(rows, positions, "root").join(lists, "key")
    nth = F.row_number().over(Window.partitionBy("key").orderBy("root", "nid"))
    numbered = materialise(keyed.withColumn("piece", F.floor((nth - 1) / LIST_ROWS)), "pieces")
    cells = _sorted_cells(_in_cells(numbered).select(*CELL, "other", "root", "nid", *FP))
    return cells.mapInArrow(lambda batches: _links_across(batches, whole), "a bigint, b bigint").distinct()


def _alike_in_cell(other: np.ndarray, root: np.ndarray, nid: np.ndarray, fp: np.ndarray, size: np.ndarray,
                   found: np.ndarray, inside: bool, similarity: float) -> list[tuple[int, int]]:
    """Links of similar texts that join a cell's classes, one for every two that meet."""
    starts = np.concatenate(([0], np.cumsum(size)))
    class_of, number, links = np.unique(root, return_inverse=True)[1], None, []
    for i in range(len(nid) - 1):
        j = np.arange(i + 1, len(nid))
        j = j[(class_of[j] != class_of[i]) & (inside | (other[j] != other[i]))
              & (np.minimum(size[j], size[i]) >= similarity * np.maximum(size[j], size[i]) * (1 - 1e-9))]
        if len(j):
            j = j[_close(fp, np.full(len(j), i), j)[0]]
        if not len(j):
            continue
        if number is None:
            number = np.unique(found, return_inverse=True)[1]
            mine = np.zeros(number.max() + 1, bool)
        own = number[starts[i]:starts[i + 1]]
        mine[own] = True
        firsts = np.concatenate(([0], np.cumsum(size[j])[:-1]))
        both = np.add.reduceat(mine[np.concatenate([number[starts[k]:starts[k + 1]] for k in j])], firsts, dtype=np.int64)
        mine[own] = False
        for k in j[both / (size[i] + size[j] - both) >= similarity]:
            if class_of[k] != class_of[i]:
                links.append((min(nid[i], nid[k]), max(nid[i], nid[k])))
                class_of[class_of == class_of[k]] = class_of[i]
    return links


def _alike_across(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """The links of rows with their shingles, sorted by cell; two pieces are held at a time."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush(last: bool) -> Iterator[pa.RecordBatch]:
        *columns, found = [np.concatenate(x) for x in zip(*held)]
        edges = np.flatnonzero(np.concatenate(([True], (columns[0][1:] != columns[0][:-1]).any(axis=1), [last])))
        at = np.concatenate(([0], np.cumsum(columns[-1])))
        links = []
        for lo, hi in zip(edges, edges[1:]):
            cell, *rest = [c[lo:hi] for c in columns]
            links += _alike_in_cell(*rest, found[at[lo]:at[hi]], cell[0, 1] == cell[0, 2], similarity)
        held[:] = [(*[c[edges[-1]:] for c in columns], found[at[edges[-1]]:])] if edges[-1] < len(columns[0]) else []
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if batch.num_rows:
            of = [np.column_stack([batch.column(c).to_numpy() for c in names]) for names in (CELL, FP)]
            found = batch.column("found")
            held.append((of[0], *[batch.column(c).to_numpy() for c in ("other", "root", "nid")], np.ascontiguousarray(of[1]),
                         found.value_lengths().to_numpy().astype(np.int64), found.flatten().to_numpy()))
            if sum(len(h[-1]) for h in held) >= LIST_ROWS * ROW_SHINGLES:
                yield from flush(False)
    if held:
        yield from flush(True)


def alike(loose: DataFrame, nodes: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Verified links (a, b) between classes among the texts that the given close pairs hold together.

    All close pairs of such a group are verified inside cells of two of its pieces, which texts are dealt to by
    digest.  A group has ``PIECES`` pieces at most, so its texts' shingles move that many times and its work is
    spread; more only beyond ``LIST_ROWS`` rows a piece.
    """
    groups = components(loose).select(F.col("node").alias("nid"), F.col("root").alias("key"))
    rows = nodes.select("nid", *FP).join(groups, "nid").join(roots, "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    weight = F.greatest(F.size("found"), F.lit(ROW_SHINGLES)).cast("bigint").alias("weight")
    weighed = materialise(rows.join(sets.select("nid", weight), "nid"), "groups")
    total = F.sum("weight")
    most = F.least(F.lit(LIST_ROWS * ROW_SHINGLES), F.greatest(F.lit(PIECE_ROWS * ROW_SHINGLES), total / PIECES))
    facts = materialise(weighed.groupBy("key").agg(F.count("*").alias("n"), F.ceil(total / most).alias("pieces")), "facts")
    numbered = attach(weighed.drop("weight"), facts, "key", "n", weighed.count())
    numbered = materialise(numbered.withColumn("piece", F.pmod(F.xxhash64("nid"), "pieces")).drop("pieces"), "pieces")
    cells = _sorted_cells(_in_cells(numbered).join(sets, "nid").select(*CELL, "other", "root", "nid", *FP, "found"))
    return cells.mapInArrow(lambda batches: _alike_across(batches, similarity), "a bigint, b bigint").distinct()


# --- texts ----------------------------------------------------------------------------------------

def _identity(key: str, text: str) -> Column:
    """A document's id as text; one without a key is known by its text."""
    return F.coalesce(F.concat(F.lit("k"), F.col(f"`{key}`").cast("string")),
                      F.concat(F.lit("t"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))))


def _mark(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def _sketches(batch: pa.RecordBatch, size: int) -> pa.RecordBatch:
    """(place, digest of the words, fingerprint); the words of one text are held at a time."""
    fps, marks = np.empty((batch.num_rows, LANES), np.int64), []
    for i, t in enumerate(each_bytes(batch, "text")):
        words = lower_words(t)
        fps[i] = fingerprint(shingles(words, size))
        marks.append(hashlib.md5(b" ".join(words)).digest())
    return pa.RecordBatch.from_arrays(
        [batch.column("place"), pa.array(marks, pa.binary()), *[pa.array(fps[:, i]) for i in range(LANES)]],
        ["place", "node", *FP])


def distinct_texts(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """One row per distinct sequence of words: (nid, node, place, fingerprint) as a stored table.

    ``place`` is the smallest document of the sequence: keys in their own order, none last.
    """
    rows = docs.select(
        F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("key"), _identity(key, text).alias("id"),
                 _mark(text).alias("mark")).alias("place"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["place"].dataType.simpleString()

    made = map_batches(rows, lambda batch: _sketches(batch, size), f"place {kind}, node binary, {', '.join(f'{c} bigint' for c in FP)}")
    one = made.groupBy("node").agg(F.min("place").alias("place"), *[F.min(c).alias(c) for c in FP])
    return materialise(one.withColumn("nid", F.monotonically_increasing_id()), "texts")


def shingle_sets(links: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(nid, found): the whole shingle sets of the texts at the links' ends, as a stored table."""
    ends = links.select(F.col("a").alias("nid")).union(links.select("b")).distinct()
    mine = materialise(nodes.join(ends, "nid").select("nid", "node", F.col("place.id").alias("id"), F.col("place.mark").alias("mark")), "linked")
    texts = docs.select(_identity(key, text).alias("id"), _mark(text).alias("mark"), F.col(f"`{text}`").alias("text")).join(
        mine, ["id", "mark"]).dropDuplicates(["nid"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(lower_words(t), size).view(np.int64) for t in each_bytes(batch, "text")]
        return pa.RecordBatch.from_arrays([batch.column("nid"), pa.array(found, pa.list_(pa.int64()))], ["nid", "found"])

    return materialise(map_batches(texts.select("nid", "text"), run, "nid bigint, found array<bigint>"), "shingles")


def verified(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The links whose texts are similar enough, by their whole shingle sets."""
    left, right = (sets.select(F.col("nid").alias(c), F.col("found").alias(f"of_{c}")) for c in "ab")
    both = F.size(F.array_intersect("of_a", "of_b"))
    alike = both / (F.size("of_a") + F.size("of_b") - both) >= similarity
    return links.join(left, "a").join(right, "b").where(alike).select("a", "b")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the document with the smallest key.

    Classes are the components of verified links.  Rows with the same key and text are one document, of
    which one row stays; so is one row of a key whose texts lead several classes.  Keys have any type that
    has an order.  A row without a key stays only where no row with one does, and is known by its text.
    Null texts have no words.  Rows and columns are handed on as they are, whatever the columns' names.
    """
    nodes = distinct_texts(docs, key, text, size)
    told = nodes.where(F.col("node") != F.lit(hashlib.md5(b"").digest()))
    positions = index_positions(told.count(), similarity, recall)
    links, lists = candidates(told, positions)
    links = materialise(links, "candidates")
    edges = materialise(verified(links, shingle_sets(links, nodes, docs, key, text, size), similarity), "verified")
    found = components(edges)
    # What the forests left out, between texts that did not come together without it.
    roots = found.select(F.col("node").alias("nid"), "root")
    loose = materialise(left_out(told, roots, lists, positions, whole=False), "loose")
    if not loose.isEmpty():
        sets = shingle_sets(loose, nodes, docs, key, text, size)
        others = materialise(alike(loose, told, roots, sets, similarity), "verified")
        if not others.isEmpty():
            found = components(edges.unionByName(others))
    placed = nodes.select("nid", "place").join(found.withColumnRenamed("node", "nid"), "nid", "left")
    least = placed.groupBy(F.coalesce("root", "nid").alias("root")).agg(F.min("place").alias("place"))
    winners = least.select(F.col("place.id").alias("__id"), F.col("place.mark").alias("__mark"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), _identity(key, text).alias("__id"),
                       _mark(text).alias("__mark"), F.xxhash64(*hashable(docs)).alias("__row"))
    kept = rows.join(winners, ["__id", "__mark"], "left_semi")
    first = F.row_number().over(Window.partitionBy("__id").orderBy("__row"))
    return kept.withColumn("__nth", first).where("__nth = 1").select("__doc.*")
