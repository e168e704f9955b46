"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space that parts words: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

# A key with more than this share of all rows is hot; there are fewer than 1 / HOT_SHARE such keys.
HOT_SHARE = 0.002
SPREAD = 4096
# Of a record batch, so many bytes are worked on together.
BATCH_BYTES = 1 << 22


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, also where lambdas refer to it."""
    return F.transform(F.array(value), use)[0]


def words_column(text: Column) -> Column:
    """Words of a text: maximal runs of anything but white space; none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+")
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, without building them as an array of their own twice."""
    return F.size(words_column(text)).cast("long")


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text with A-Z in lower case."""
    return text.translate(LOWER).split() if text else []


def as_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def few_rows(batch: pa.RecordBatch, most: int = 128) -> Iterator[pa.RecordBatch]:
    """A batch in slices, so that few of its values are Python objects at a time."""
    for at in range(0, batch.num_rows, most):
        yield batch.slice(at, most)


def some_bytes(batch: pa.RecordBatch, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about so many bytes, a row at least."""
    return few_rows(batch, max(1, batch.num_rows * most // max(1, batch.nbytes)))


def each_bytes(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    """The values of a text column as bytes, some at a time."""
    for part in few_rows(batch):
        yield from as_bytes(part, name)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` with a record batch in and one out, for some bytes of rows at a time.

    Spark's batches go up to 64 MB, which as Python objects and with their results are several times that.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in some_bytes(batch):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
            del batch
            pa.default_memory_pool().release_unused()
    return df.mapInArrow(run, schema)


def hashable(df: DataFrame) -> list[Column]:
    """The columns that can be hashed and compared: those without maps, variants or intervals inside."""
    return [F.col(f"`{c}`") for c, t in df.dtypes if not any(x in t for x in ("map<", "variant", "interval", "void"))]


def row_hash(df: DataFrame) -> Column:
    """A number that differs between unlike rows, to spread rows of one key."""
    return F.pmod(F.xxhash64(*hashable(df)), F.lit(SPREAD)).cast("int") if hashable(df) else F.lit(0)


def attach(df: DataFrame, facts: DataFrame, key: str, rows: str, total: int, spread: Column | None = None) -> DataFrame:
    """Left join of ``df`` to one row of facts per key when single keys own much of ``df``.

    ``rows`` is the column of ``facts`` with the key's number of rows in ``df`` and ``total`` their
    sum.  Keys above ``HOT_SHARE`` of the total number fewer than ``1 / HOT_SHARE``, so their facts
    are broadcast; rows served that way, and rows without a key, are spread over the partitions of
    the second join instead of meeting in one.  ``facts`` is read twice, so it should be a stored
    table; its columns other than the key must not be in ``df``.
    """
    least = max(1, int(total * HOT_SHARE))
    names = [c for c in facts.columns if c not in (key, rows)]
    hot = F.broadcast(facts.where(F.col(rows) > least).select(
        F.col(key).alias("__hot_key"), F.struct(F.lit(True).alias("__here"), *names).alias("__hot")))
    cold = facts.where(F.col(rows) <= least).select(
        F.col(key).alias("__cold_key"), F.lit(0).alias("__cold_spread"), F.struct(*names).alias("__cold"))
    spread = row_hash(df) if spread is None else spread
    served = df.join(hot, F.col(key) == F.col("__hot_key"), "left").withColumn(
        "__spread", F.when(F.col("__hot").isNotNull() | F.col(key).isNull(), 1 + spread).otherwise(0).cast("int"))
    joined = served.join(
        cold, (F.col(key) == F.col("__cold_key")) & (F.col("__spread") == F.col("__cold_spread")), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.coalesce(F.col(f"__hot.`{c}`"), F.col(f"__cold.`{c}`")).alias(c) for c in names])
