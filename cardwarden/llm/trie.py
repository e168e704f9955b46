"""Prefix trie of conversations that share their first turns.

Every turn is a 128-bit digest of role and text with the size of its text; a conversation is the
array of its turns.  Equal conversations become one row with a count.  The distinct ones are sorted
as arrays over range partitions, and each partition streams them in blocks of bounded size, the
range shards.  A shard is a padded matrix of turn ranks: ``lexsort`` orders it, changes from row to row,
or-accumulated over the columns, mark where nodes start, and ``reduceat`` adds up every depth.

A subtree is a run of rows, and everything asked of it is a sum over them: members, leaves, bytes of
all members' turns, and bytes and children of the nodes that start in a row.  So only nodes on a
shard's first and last path can lie in two shards.  They are put together by the digest of their
path, after the one thing a shard cannot know is added: how many turns its first row shares with
the last row of the shard before.

Turns are ordered by number, null first, ties by role and text; null role or text counts as empty; repeated
turns stay.  Rows without a conv_id belong to no conversation.  Texts are digested whole, extra columns play no
part, an empty table has no nodes.  A conversation is one row of 20 bytes a turn; a group of equal ones of any
size is counted and its ids are digested as a sorted stream.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.operators.joins import spread_join
from cardwarden.session import materialise

BLOCK = 1024  # turns are numbered inside blocks of their own numbers
CELLS = 1 << 20  # matrix cells of a shard, unless one row has more
RANGE_TURNS = 256  # turns that decide the range partition; rows alike in them share one, in streamed shards
GRAFT = 9  # conversations start with up to GRAFT - 1 turns of another
KIN = 5
TURN = np.dtype([("a", ">u8"), ("b", ">u8"), ("size", ">u4")])
NO_ENDS = hashlib.sha256().hexdigest()


def placed_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, place, turn digest and size): places from 1, counted inside blocks of turn numbers
    and shifted by the blocks before, so that the sort of a long conversation is spread."""
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).cast("bigint")
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    size = F.unhex(F.lpad(F.hex(F.octet_length("text")), 8, "0"))
    rows = rows.select("conv_id", block.alias("block"), "turn", F.concat(digest, size).alias("id"),
                       # Ties go by role and text.
                       F.struct("role", "text").alias("said"))
    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    running = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("conv_id", "block", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "said")
    return rows.withColumn("nth", F.row_number().over(inside)).join(before, ["conv_id", "block"]).select(
        "conv_id", (F.col("before") + F.col("nth")).alias("place"), "id")


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, ids): the turns of every conversation in order, as one array."""
    placed = placed_turns(turns).groupBy("conv_id").agg(F.collect_list(F.struct("place", "id")).alias("turns"))
    return placed.select("conv_id", F.transform(F.array_sort("turns"), lambda t: t["id"]).alias("ids"))


def rebuilt(whole: DataFrame) -> DataFrame:
    """(conv_id, ids): first h turns of conversation c - c % 5, then c's own after its first h;
    h is crc32 of c in decimal, modulo 9."""
    c = F.col("conv_id")
    rows = whole.select("conv_id", "ids", (F.crc32(c.cast("string").cast("binary")) % GRAFT).cast("int").alias("h"),
                        (c - c % KIN).alias("stem"))
    # A stem serves KIN conversations at most, with GRAFT - 1 turns at most.
    stems = whole.where(c % KIN == 0).select(c.alias("stem"), F.slice("ids", 1, GRAFT - 1).alias("first"))
    first = F.slice(F.coalesce("first", F.array().cast("array<binary>")), F.lit(1), F.col("h"))
    rest = F.slice("ids", F.col("h") + 1, F.greatest(F.size("ids"), F.lit(1)))
    return rows.join(stems, "stem", "left").select("conv_id", F.concat(first, rest).alias("ids"))


def sequence_key(ids: Column) -> Column:
    """A 256-bit digest of a conversation."""
    return F.unhex(F.sha2(F.aggregate(ids, F.lit("").cast("binary"), lambda a, t: F.unhex(F.sha2(F.concat(a, t), 256))), 256))


def counted(convs: DataFrame) -> DataFrame:
    """(key, n, conv_id, ends_sha256) of every distinct sequence: members, the smallest, all ids digested.

    Ids of a sequence arrive sorted and stream through the digest, whatever their number.
    """
    rows = convs.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")

    def run(batches):
        key, n, least, digest = None, 0, 0, None
        for batch in batches:
            out = []
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if k != key:
                    if n:
                        out.append((key, n, least, digest.hexdigest()))
                    key, n, least, digest = k, 1, c, hashlib.sha256(str(c).encode())
                else:
                    n += 1
                    digest.update(b",%d" % c)
            if out:
                yield _batch(out)
        if n:
            yield _batch([(key, n, least, digest.hexdigest())])

    def _batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int64(), pa.string()))],
            names=["key", "n", "conv_id", "ends_sha256"])

    return rows.mapInArrow(run, "key binary, n bigint, conv_id bigint, ends_sha256 string")


# --- one shard ------------------------------------------------------------------------------------

PART = ("kind string, shard bigint, depth bigint, path binary, parent_path binary, conv_id bigint, parent_conv_id bigint, "
        "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, "
        "rest bigint, turns bigint")
FIELDS = [f.split()[0] for f in PART.split(", ")]


def paths(ids: list[bytes]) -> list[bytes]:
    """A digest of every prefix, the empty one first."""
    digest, found = hashlib.sha256(), []
    found.append(digest.digest())
    for t in ids:
        digest.update(t)
        found.append(digest.digest())
    return found


def shard_nodes(rows: list[tuple], shard: int) -> pd.DataFrame:
    """All nodes of some distinct sequences (ids, n, conv_id, ends) in ascending order.

    ``inner`` nodes are whole.  Those on the first and last row's paths are ``edge`` sums without
    what depends on the neighbours: bytes and children of nodes that start in the first row, and whether
    the last row is a leaf.  A ``first`` row per depth tells the first path's bytes from there on, a
    ``last`` row the last path's turns.
    """
    turns = np.array([len(r[0]) for r in rows])
    flat = np.frombuffer(b"".join(t for r in rows for t in r[0]), TURN)
    width, n = int(turns.max(initial=0)), len(rows)
    order = np.lexsort((flat["b"], flat["a"]))
    new = np.ones(len(flat), np.int64)
    if len(flat):
        a, b = flat["a"][order], flat["b"][order]
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    rank = np.empty(len(flat), np.int32)
    rank[order] = np.cumsum(new)
    inside = np.arange(width) < turns[:, None]
    matrix, size = np.zeros((n, width), np.int32), np.zeros((n, width), np.int64)
    matrix[inside], size[inside] = rank, flat["size"]
    if width:
        by = np.lexsort(matrix.T[::-1])  # shorter rows first, as 0 pads them
        rows, turns, inside, matrix, size = [rows[i] for i in by], turns[by], inside[by], matrix[by], size[by]
    count, least = (np.array([r[i] for r in rows]) for i in (1, 2))

    changed = np.ones((n, width + 1), bool)  # column d: the node of depth d starts here
    changed[1:, 0] = False
    changed[1:, 1:] = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)
    starts = changed.copy()
    starts[:, 1:] &= inside
    starts[0] = False
    weigh = np.concatenate([np.zeros((n, 1), np.int64), size], axis=1)
    rest = weigh[:, ::-1].cumsum(axis=1)[:, ::-1]  # bytes from this depth on
    own = (weigh * starts)[:, ::-1].cumsum(axis=1)[:, ::-1]
    saved = rest * count[:, None] - own
    children = np.zeros((n, width + 1), np.int64)
    children[:, :-1] = starts[:, 1:]
    shared = np.where(changed[1:].any(axis=1), changed[1:].argmax(axis=1), width + 1) - 1  # turns alike with the row before
    leaf = np.zeros(n, np.int64)
    leaf[:-1] = shared < turns[:-1]

    first, last = paths(rows[0][0]), paths(rows[-1][0])
    alike = 0
    while alike + 1 < min(len(first), len(last)) and first[alike + 1] == last[alike + 1]:
        alike += 1
    out: list[dict] = []
    above = None
    for d in range(width + 1):
        at = np.flatnonzero(changed[:, d])
        there = np.flatnonzero(turns[at] >= d) if d else np.arange(len(at))
        sums = {name: np.add.reduceat(v, at)[there] for name, v in (
            ("n_convs", count), ("n_children", children[:, d]), ("n_leaves", leaf), ("saved_tokens", saved[:, d]))}
        conv = np.minimum.reduceat(least, at)[there]
        begin = at[there]
        end = np.append(at[1:], n)[there]
        on_first, on_last = (begin == 0), (end == n) & (turns[-1] >= d)
        edge = on_first | on_last
        parent = np.full(len(begin), -1) if above is None else np.searchsorted(above[0], begin, side="right") - 1
        made = {"shard": shard, "depth": d, "conv_id": conv, **sums,
                "ends_sha256": [rows[i][3] if turns[i] == d else None for i in begin], "edge": edge}
        path = np.full(len(begin), None, object)
        up = np.full(len(begin), None, object)
        path[on_first] = first[d] if d < len(first) else None
        path[on_last] = last[d] if d < len(last) else None
        parent_conv = np.full(len(begin), None, object)
        if d:
            here = above[2][parent]
            up[here] = above[3][parent][here]
            parent_conv[~here] = above[1][parent][~here]
        out.append(pd.DataFrame({**made, "path": path, "parent_path": up, "parent_conv_id": parent_conv}))
        above = (begin, conv, edge, path)
    nodes = pd.concat(out, ignore_index=True)
    nodes["kind"] = np.where(nodes.pop("edge"), "edge", "inner")
    ends = [pd.DataFrame({"kind": "first", "shard": shard, "depth": np.arange(len(first)), "path": first,
                          "rest": rest[0, :len(first)], "turns": turns[0]}),
            pd.DataFrame({"kind": "last", "shard": shard, "depth": np.arange(len(last)), "path": last, "turns": turns[-1]})]
    whole = pd.concat([nodes, *ends], ignore_index=True).reindex(columns=FIELDS)
    for c in FIELDS:
        if c not in ("kind", "path", "parent_path", "ends_sha256"):
            whole[c] = whole[c].astype("Int64")
    return whole


def shards(distinct: DataFrame) -> DataFrame:
    """The nodes of all shards, from (ids, n, conv_id, ends_sha256) in range partitions."""
    spark = distinct.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = distinct.repartitionByRange(parts, F.slice("ids", 1, RANGE_TURNS)).sortWithinPartitions("ids")

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        widest = 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("ids", "n", "conv_id", "ends_sha256")]):
                wider = max(widest, len(row[0]) + 1)
                if held and (len(held) + 1) * wider > CELLS:
                    yield as_batch(shard_nodes(held, number))
                    number, held, wider = number + 1, [], len(row[0]) + 1
                held.append(row)
                widest = wider
        if held:
            yield as_batch(shard_nodes(held, number))

    def as_batch(pdf):
        kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in PART.split(", ")])
        return pa.RecordBatch.from_pandas(pdf, schema=schema, preserve_index=False)

    return rows.mapInArrow(run, PART)


# --- all shards -----------------------------------------------------------------------------------

def recombined(parts: DataFrame) -> DataFrame:
    """Edge nodes of all shards put together: (path, parent_path, depth, conv_id, sums, ends)."""
    first = parts.where("kind = 'first'").select("shard", "depth", "path", "rest", "turns")
    last = parts.where("kind = 'last'").select("shard", "depth", "path", "turns")
    # One row per shard.
    order = Window.orderBy("shard")
    line = first.where("depth = 0").select("shard", F.lag("shard").over(order).alias("before"))
    # Turns shared with the last row of the shard before; the very first shard shares the root only.
    met = first.join(line, "shard").join(
        last.select(F.col("shard").alias("before"), "depth", "path", F.lit(True).alias("met")), ["before", "depth", "path"], "left")
    alike = met.groupBy("shard", "before").agg(F.coalesce(F.max(F.when(F.col("met"), F.col("depth"))), F.lit(0)).alias("alike"))
    begun = first.join(alike, "shard")
    # Bytes of the first path's nodes that start in this shard.
    fresh = begun.where("depth = alike + 1").select("shard", F.col("rest").alias("fresh"))
    begun = begun.join(fresh, "shard", "left").select(
        "path", "depth",
        (-F.when(F.col("depth") > F.col("alike"), F.col("rest")).otherwise(F.coalesce("fresh", F.lit(0)))).alias("saved_tokens"),
        ((F.col("depth") >= F.col("alike")) & (F.col("depth") < F.col("turns"))).cast("bigint").alias("n_children"))
    # The last row is a leaf unless the next shard's first row goes on from it.
    following = alike.select(F.col("before").alias("shard"), F.col("alike").alias("next_alike"))
    done = last.join(following, "shard", "left").select(
        "path", "depth", F.coalesce(F.col("next_alike") < F.col("turns"), F.lit(True)).cast("bigint").alias("n_leaves"))
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    edges = parts.where("kind = 'edge'").select("path", "parent_path", "depth", "conv_id", "ends_sha256", *sums)
    every = edges.unionByName(begun, allowMissingColumns=True).unionByName(done, allowMissingColumns=True)
    return every.groupBy("path", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_path").alias("parent_path"), F.max("ends_sha256").alias("ends_sha256"),
        *[F.sum(c).alias(c) for c in sums])


def nodes(turns: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs = rebuilt(materialise(sequences(turns), "sequences"))
    return trie(convs)


def trie(convs: DataFrame) -> DataFrame:
    """The nodes of (conv_id, ids); conv_id is unique."""
    keyed = materialise(convs.select("conv_id", "ids", sequence_key(F.col("ids")).alias("key")), "conversations")
    # A sequence's smallest member lends its turns.
    distinct = counted(keyed).drop("key").join(keyed.select("conv_id", "ids"), "conv_id")
    parts = materialise(shards(distinct), "shards")
    edges = materialise(recombined(parts), "edges")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = parts.where("kind = 'inner'")
    # Children of edge nodes take the parent's smallest member from the whole node.  A parent of many
    # children is hot, so its facts are found by depth and path once and spread over the children.
    parents = edges.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("__parent"))
    whole = inner.where("parent_path is null").select(*out).unionByName(
        with_parent(inner.where("parent_path is not null"), parents).select(*out)).unionByName(
        with_parent(edges.withColumn("parent_conv_id", F.lit(None).cast("bigint")), parents).select(*out))
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


def with_parent(children: DataFrame, parents: DataFrame) -> DataFrame:
    return spread_join(children, parents, "parent_path").withColumn("parent_conv_id", F.col("__parent"))
