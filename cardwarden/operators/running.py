"""Profiles that grow with the files of a table: a later run reads only the files that are new.

Every file leaves one row of mergeable sums and extremes; keys leave themselves, once each, in hash
buckets.  A run takes the new files' rows and new keys in as one version, so a crash leaves the last
profile and a repeated run adds nothing.  The report merges the rows of the files.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.schemas import DOUBLE, LONG, TEXT, schema_of
from cardwarden.sinks.versions import FAN, ROWS_PER_BUCKET, VersionedTables

WRITER = "profile"
SUMS = ["total_rows", "missing_keys", "amounts", "zero_or_negative", "positives", "negatives", "amount_sum", "new_keys"]
LOWS, HIGHS = ["min_key", "min_time", "minimum"], ["max_key", "max_time", "maximum"]


class RunningProfile(VersionedTables):
    """Key, time, amount and target profile of a table whose files arrive over time.

    ``key`` and ``time`` are whole numbers, ``target`` is 0 or 1; missing amounts are null or NaN.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, time: str, amount: str, target: str,
                 rows_per_bucket: int = ROWS_PER_BUCKET, fan: int = FAN):
        partial = schema_of(key=LONG, file=TEXT, total_rows=LONG, missing_keys=LONG, min_key=LONG, max_key=LONG,
                            min_time=LONG, max_time=LONG, amounts=LONG, zero_or_negative=LONG, amount_sum=DOUBLE,
                            minimum=DOUBLE, maximum=DOUBLE, positives=LONG, negatives=LONG, new_keys=LONG)
        super().__init__(spark, path, {"partials": partial, "keys": schema_of(key=LONG)}, "key", rows_per_bucket, fan)
        self.of = (key, time, amount, target)

    def files(self) -> list[str]:
        """Files already taken in."""
        return sorted(r.file for r in self.read("partials").where("file <> ''").select("file").distinct().collect())

    def update(self, files: list[str], read: Callable[[list[str]], DataFrame]) -> int:
        """Take in the files not seen before; ``read`` opens some of them.  Gives their number."""
        known = set(self.files())
        fresh = [f for f in dict.fromkeys(files) if f not in known]
        if not fresh:
            return 0
        key, time, amount, target = (F.col(f"`{c}`") for c in self.of)
        rows = read(fresh)
        x = F.nanvl(amount.cast("double"), F.lit(None))
        partials = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count("*").alias("total_rows"), F.count_if(key.isNull()).alias("missing_keys"),
            F.min(key).cast("bigint").alias("min_key"), F.max(key).cast("bigint").alias("max_key"),
            F.min(time).cast("bigint").alias("min_time"), F.max(time).cast("bigint").alias("max_time"),
            F.count(x).alias("amounts"), F.count_if(x <= 0).alias("zero_or_negative"), F.sum(x).alias("amount_sum"),
            F.min(x).alias("minimum"), F.max(x).alias("maximum"), F.count_if(target == 1).alias("positives"),
            F.count_if(target == 0).alias("negatives"), F.lit(0).cast("bigint").alias("new_keys"))
        # Keys of the new files that no earlier file held; only their buckets are opened.
        mine = rows.where(key.isNotNull()).select(key.cast("bigint").alias("key")).distinct().persist()
        try:
            before = self.read("keys", keys=mine) if known else None
            new = mine if before is None else mine.join(before, "key", "left_anti")
            of_files = self._per_file(fresh, partials)
            count = self.spark.createDataFrame([("", new.count())], "file string, new_keys bigint")
            parts = of_files.unionByName(count, allowMissingColumns=True).withColumn("key", F.xxhash64("file"))
            self.append({"partials": parts, "keys": new}, WRITER, self.version().writers.get(WRITER, -1) + 1)
        finally:
            mine.unpersist()
        return len(fresh)

    def _per_file(self, fresh: list[str], partials: DataFrame) -> DataFrame:
        """The rows of the files by the names they were given; files without rows have zeros."""
        found = {_place(r["file"]): r for r in partials.collect()}  # one narrow row per file
        rows = []
        for name in fresh:
            r = found.get(_place(name))
            rows.append({"file": name, **({c: r[c] for c in partials.columns if c != "file"} if r else {"total_rows": 0})})
        kinds = T.StructType([f for f in self.schemas["partials"] if f.name != "key"])
        return self.spark.createDataFrame([tuple(r.get(f.name) for f in kinds) for r in rows], kinds)

    def report(self) -> DataFrame:
        """One row over all files taken in: rows, distinct and repeated keys, ranges, amounts, target."""
        p = self.read("partials")
        merged = p.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS],
                       *[F.min(c).alias(c) for c in LOWS], *[F.max(c).alias(c) for c in HIGHS])
        return merged.select(
            "total_rows", "missing_keys", F.col("new_keys").alias("distinct_keys"),
            (F.col("total_rows") - F.col("missing_keys") - F.col("new_keys")).alias("duplicates"),
            "min_key", "max_key", "min_time", "max_time", "minimum", "maximum",
            F.when(F.col("amounts") > 0, F.col("amount_sum") / F.col("amounts")).alias("mean"),
            "amounts", "zero_or_negative", "positives", "negatives")


def _place(file: str) -> str:
    """A file's path without scheme and repeated slashes, which its names differ in."""
    return "/" + re.sub("^[a-z0-9]+:", "", unquote(file)).strip("/")
