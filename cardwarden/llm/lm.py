"""Language-model scoring by a weighted backoff automaton.

States are the n-grams that can stand before a word; a state's arcs are the words seen after it in
training, weighted with their smoothed log-probability, and its failure arc leads to the next shorter
n-gram.  Probabilities are smoothed towards the shorter context with a Dirichlet prior,

    p(w | h) = (c(hw) + m p(w | h')) / (c(h) + m),

so an arc weighs log10 p(w | h), the failure arc log10(m / (c(h) + m)), and the root uses add-one
counts with one further type for unknown words.

The automaton of a large corpus fits no task.  Texts are laid down in chunks of bounded size; chunks
send their distinct n-grams, sorted, to buckets of digest ranges, each bucket adds up the counts of all
chunks and answers every chunk in its own order.  A chunk then holds the part of the automaton that its
texts can reach and runs through them from left to right, carrying the state.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import as_bytes, lower_words
from cardwarden.session import materialise

ORDER = 2
PRIOR = 300.0
CHUNK_TOKENS = 300_000
BUCKET_TOKENS = 1_000_000
LANE = 512
END = 0  # digest of the end of a text
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def _planes(values: np.ndarray) -> bytes:
    """Bytes by significance, so that leading zeros lie together for the shuffle's compression."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(width, -1).T).view(kind).ravel()


def _pack(sorted_keys: np.ndarray) -> bytes:
    return _planes(np.diff(sorted_keys, prepend=np.uint64(0)))


def _unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(raw, "<u8"), dtype=np.uint64) if raw else np.zeros(0, dtype=np.uint64)


# --- chunks ---------------------------------------------------------------------------------------

class _Chunk:
    def __init__(self):
        self.keys, self.held, self.lengths, self.tokens, self.local = [], [], [], [], {}

    def add(self, key, held: bool, words: list[bytes]) -> None:
        local = self.local
        ids = [local.setdefault(w, len(local)) for w in words]
        ids.append(local.setdefault(None, len(local)))
        self.keys.append(key)
        self.held.append(held)
        self.lengths.append(len(ids))
        self.tokens.append(np.array(ids, dtype="<u4"))

    def row(self, name: str) -> dict:
        digests = np.array([END if w is None else xxhash.xxh64_intdigest(w) for w in self.local], dtype="<u8")
        return {"chunk": name, "keys": self.keys, "held": self.held, "lengths": self.lengths,
                "tokens": zlib.compress(_planes(np.concatenate(self.tokens)), 1), "digests": digests.tobytes()}


def chunked(docs: DataFrame, key: str, text: str, held: Column) -> DataFrame:
    """One row per chunk: its documents, their lengths, tokens as places in the list of digests."""
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), F.coalesce(held, F.lit(False)).alias("h"))
    schema = f"chunk string, keys array<{kind.simpleString()}>, held array<boolean>, lengths array<int>, tokens binary, digests binary"
    fields = ["chunk", "keys", "held", "lengths", "tokens", "digests"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, now, size = TaskContext.get().partitionId(), 0, _Chunk(), 0
        key_type = None

        def done():
            row = now.row(f"{part}-{made}")
            kinds = [pa.string(), pa.list_(key_type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([row[f]], t) for f, t in zip(fields, kinds)], fields)

        for batch in batches:
            key_type = batch.schema.field("k").type
            for k, h, t in zip(batch.column("k").to_pylist(), batch.column("h").to_pylist(), as_bytes(batch, "t")):
                words = lower_words(t)
                if size and size + len(words) >= CHUNK_TOKENS:
                    yield done()
                    made, now, size = made + 1, _Chunk(), 0
                now.add(k, h, words)
                size += len(words) + 1
        if size:
            yield done()

    return rows.mapInArrow(run, schema)


class _Grams:
    """The n-grams of a chunk: per order, each place's number among the sorted distinct ones (-1: none)."""

    def __init__(self, tokens: bytes, digests: bytes, lengths, order: int):
        self.lengths = np.asarray(lengths, dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        words = np.frombuffer(digests, dtype="<u8")[_from_planes(zlib.decompress(tokens), "<u4")]
        depth = np.arange(len(words)) - np.repeat(self.starts, self.lengths)
        self.keys, self.at, self.first = {}, {}, {}
        key = words
        for k in range(1, order + 1):
            if k > 1:
                mixed = key[:-1] * ODD + words[1:]
                mixed = (mixed ^ (mixed >> np.uint64(31))) * MIX
                key = np.concatenate((words[:1], mixed ^ (mixed >> np.uint64(29))))
            places = np.flatnonzero(depth >= k - 1)
            self.keys[k], first, number = np.unique(key[places], return_index=True, return_inverse=True)
            self.first[k] = places[first]
            self.at[k] = np.full(len(words), -1, dtype=np.int64)
            self.at[k][places] = number

    def counts(self, k: int, trained: np.ndarray) -> np.ndarray:
        """How often each distinct n-gram lies in a training text of the chunk."""
        of_token = np.repeat(trained, self.lengths) & (self.at[k] >= 0)
        return np.bincount(self.at[k][of_token], minlength=len(self.keys[k]))


def _bounds(buckets: int) -> np.ndarray:
    return np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)


def _sent(batches: Iterator[pa.RecordBatch], order: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Each chunk's distinct n-grams with their training counts, cut by bucket."""
    for batch in batches:
        for row in batch.to_pylist():
            grams = _Grams(row["tokens"], row["digests"], row["lengths"], order)
            trained = ~np.array(row["held"], dtype=bool)
            out = []
            for k in range(1, order + 1):
                keys, counts = grams.keys[k], grams.counts(k, trained).astype("<u4")
                cuts = np.concatenate(([0], np.searchsorted(keys, _bounds(buckets)), [len(keys)]))
                out += [(b, row["chunk"], k, _pack(keys[i:j]), _planes(counts[i:j]))
                        for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if j > i]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()))],
                    ["bucket", "chunk", "k", "grams", "counts"])


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket: counts added over the chunks, answered to each chunk in the order it sent."""
    out = []
    for k, own in rows.groupby("k"):
        keys = [_unpack(g) for g in own["grams"]]
        distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
        sent = np.concatenate([_from_planes(c, "<u4") for c in own["counts"]])
        total = np.bincount(number, weights=sent, minlength=len(distinct)).astype("<u8")
        ends = np.cumsum([len(x) for x in keys])
        known, mass = int((total > 0).sum()), int(total.sum())
        for i, chunk in enumerate(own["chunk"]):
            answer = total[number[ends[i] - len(keys[i]):ends[i]]]
            out.append((chunk, int(own["bucket"].iloc[0]), int(k), _planes(answer), known if not i else 0, mass if not i else 0))
    return pd.DataFrame(out, columns=["chunk", "bucket", "k", "totals", "known", "mass"])


# --- the automaton --------------------------------------------------------------------------------

class Automaton:
    """The part of the weighted backoff automaton that a chunk's texts can reach.

    A state is the number of words of context it stands for, at its place in the text; arcs[k] holds
    the weights of arcs out of contexts of k - 1 words, failure[k] those of failure arcs out of
    contexts of k words.
    """

    def __init__(self, grams: _Grams, totals: dict[int, np.ndarray], order: int, tokens: int, types: int, prior: float):
        self.order, self.grams = order, grams
        self.unknown = -np.log10(tokens + types + 1)
        # One more count, of nothing, for the places that hold no n-gram (number -1).
        self.count = {k: np.append(totals[k].astype(np.float64), 0.0) for k in totals}
        self.seen = {k: self.count[k][grams.at[k]] > 0 for k in totals}
        p = {1: (self.count[1] + 1) / (tokens + types + 1)}
        self.failure = {}
        for k in range(2, order + 1):
            place = grams.first[k]
            before, shorter = grams.at[k - 1][place - 1], grams.at[k - 1][place]
            p[k] = (self.count[k][:-1] + prior * p[k - 1][shorter]) / (self.count[k - 1][before] + prior)
            self.failure[k - 1] = np.log10(prior / (self.count[k - 1] + prior))
        self.arcs = {k: np.log10(v) for k, v in p.items()}

    def step(self, place: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read the token at each place in each state: (log10 weight, next state)."""
        weight, after = np.zeros(len(place)), np.zeros(len(place), dtype=np.int64)
        state, open_ = state.copy(), np.ones(len(place), dtype=bool)
        for k in range(self.order, 0, -1):
            here = open_ & (state == k - 1)
            hit = here & self.seen[k][place]
            weight[hit] += self.arcs[k][self.grams.at[k][place[hit]]]
            after[hit] = min(k, self.order - 1)
            open_ &= ~hit
            miss = here & ~hit
            if k > 1:
                weight[miss] += self.failure[k - 1][self.grams.at[k - 1][place[miss] - 1]]
                state[miss] = k - 2
            else:
                weight[miss] += self.unknown
        return weight, after

    def run(self) -> np.ndarray:
        """log10 probability of every text, its pieces of LANE tokens read side by side.

        The state after a token depends on the last order - 1 tokens only, so a piece starts at the
        root that many tokens early and does not count those.
        """
        lengths, starts = self.grams.lengths, self.grams.starts
        pieces = -(-lengths // LANE)
        doc = np.repeat(np.arange(len(lengths)), pieces)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[doc] + nth * LANE
        end = np.minimum(begin + LANE, starts[doc] + lengths[doc])
        at = np.maximum(begin - (self.order - 1), starts[doc])
        state, total = np.zeros(len(doc), dtype=np.int64), np.zeros(len(doc))
        while True:
            live = np.flatnonzero(at < end)
            if not len(live):
                break
            weight, state[live] = self.step(at[live], state[live])
            total[live] += np.where(at[live] >= begin[live], weight, 0.0)
            at[live] += 1
        return np.bincount(doc, weights=total, minlength=len(lengths))


def scored(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", order: int = ORDER,
           prior: float = PRIOR) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows where ``held`` is true (null: false) are scored without being learned from.  A null text is
    an empty one, which is its end alone.  ``base_score`` is the add-one unigram score.  Repeated rows
    are learned from and scored each; without training rows every token is unknown; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    chunks = materialise(chunked(docs, key, text, held), "chunks")
    tokens = chunks.select(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tokens * order // BUCKET_TOKENS + 1)
    sent = chunks.select("chunk", "held", "lengths", "tokens", "digests").mapInArrow(
        lambda batches: _sent(batches, order, buckets), "bucket int, chunk string, k int, grams binary, counts binary")
    answers = materialise(sent.groupBy("bucket").applyInPandas(
        _added, "chunk string, bucket int, k int, totals binary, known bigint, mass bigint"), "answers")
    model = answers.where("k = 1").agg(F.sum("known"), F.sum("mass")).first()
    types, train = model[0] or 0, model[1] or 0

    def score(chunk: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0]
        grams = _Grams(row["tokens"], row["digests"], row["lengths"], order)
        totals = {k: np.concatenate([_from_planes(t, "<u8") for t in own.sort_values("bucket")["totals"]])
                  if len(own) else np.zeros(0) for k in range(1, order + 1)
                  for own in [answered[answered["k"] == k]]}
        model = Automaton(grams, totals, order, train, types, prior)
        counts = model.count[1][grams.at[1]]
        base = np.add.reduceat(np.log10((counts + 1) / (train + types + 1)), grams.starts)
        known = np.add.reduceat((counts > 0).astype(np.int64), grams.starts)
        return pd.DataFrame({
            "k": pd.Series(list(row["keys"]), dtype=object), "held_out": np.asarray(row["held"], dtype=bool),
            "n_tokens": grams.lengths, "n_known": known, "train_tokens": train, "base_score": base, "score": model.run()})

    kind = docs.schema[key].dataType.simpleString()
    out = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        score, f"k {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("k", key)
