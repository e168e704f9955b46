"""Parquet tables of one key that change together, version by version.

A version is one small JSON file that names every data file of every table; a change writes new data
files first and becomes visible with its version, which is moved into place only if no other writer
took the number.  Readers hold one version and see exactly its files, whatever is compacted or
deleted meanwhile.  Files of a part are split by hash buckets of the key, as many as its rows ask for,
sorted by key and written with Bloom filters, so a lookup opens the buckets of its keys and no
others.  Small parts are merged ``FAN`` at a time, so there are at most ``FAN`` parts per size class.

The number of files a version names grows with the data, by one per ``ROWS_PER_BUCKET`` rows; the
driver holds that list and no data.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.operators.joins import known_subset

FAN = 8
ROWS_PER_BUCKET = 1_000_000
MOST_BUCKETS = 1 << 16
# Versions kept readable by ``expire``.
KEEP_VERSIONS = 100


class Conflict(RuntimeError):
    """Another writer took the version first; read again and repeat the change."""


@dataclass(frozen=True)
class Part:
    """Files of one change to one table, relative to the root, and how its keys were split."""

    table: str
    files: list[str]
    buckets: int
    rows: int
    born: int  # the version that added its rows first; older delete marks do not concern it
    level: int = 0


@dataclass(frozen=True)
class Version:
    number: int = 0
    parts: list[Part] = field(default_factory=list)
    marks: list[Part] = field(default_factory=list)  # keys deleted but not yet taken out of the files
    writers: dict[str, int] = field(default_factory=dict)  # last batch of each writer


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class VersionedTables:
    """Named tables with a common key column under one root."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType], key: str,
                 rows_per_bucket: int = ROWS_PER_BUCKET, fan: int = FAN):
        self.spark, self.root, self.schemas, self.key = spark, root.rstrip("/"), schemas, key
        self.rows_per_bucket, self.fan = rows_per_bucket, fan

    # --- files ---

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("log").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        """Data files below a folder, relative to the root; one change's, so few."""
        fs, at = self._files(), self._path(folder)
        if not fs.exists(at):
            return []
        base, found, each = fs.makeQualified(self._path("")).toString().rstrip("/"), [], fs.listFiles(at, True)
        while each.hasNext():
            name = each.next().getPath()
            if not name.getName().startswith(("_", ".")):
                found.append(name.toString().removeprefix(base + "/"))
        return sorted(found)

    # --- versions ---

    def numbers(self) -> list[int]:
        return sorted(int(n.removeprefix("log/").removesuffix(".json")) for n in self._names("log"))

    def version(self, number: int | None = None) -> Version:
        """The given version, or the newest one; an empty one before the first change."""
        known = self.numbers()
        if not known and number is None:
            return Version()
        name = f"log/{(known[-1] if number is None else number):012d}.json"
        text = self.spark.read.option("wholetext", True).text(f"{self.root}/{name}").first().value
        raw = json.loads(text)
        return Version(raw["number"], [Part(**p) for p in raw["parts"]], [Part(**p) for p in raw["marks"]], raw["writers"])

    def _commit(self, version: Version) -> Version:
        """The version file appears whole and only if its number is free."""
        text = json.dumps({"number": version.number, "parts": [vars(p) for p in version.parts],
                           "marks": [vars(p) for p in version.marks], "writers": version.writers})
        fs, draft = self._files(), self._path(f"_drafts/{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        jvm = self.spark._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        fs.mkdirs(self._path("log"))
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(fs.makeQualified(draft), fs.makeQualified(self._path(f"log/{version.number:012d}.json")), options)
        except Exception as e:
            if "AlreadyExists" in str(e):
                raise Conflict(f"version {version.number} exists") from e
            raise
        return version

    # --- reading ---

    def read(self, table: str, version: Version | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The rows of a table in one version; with ``keys`` (a column of that name) only theirs.

        Keys decide the files: only buckets that hold one of them are opened.  The bucket numbers, at
        most ``MOST_BUCKETS``, are collected, the keys are not.
        """
        version = version or self.version()
        if keys is not None:
            keys = keys.select(self.key).distinct()
        out = None
        # Parts with the same delete marks ahead of them are read as one.
        groups: dict[tuple, list[Part]] = {}
        for p in version.parts:
            if p.table == table and p.files:
                ahead = tuple(i for i, m in enumerate(version.marks) if m.born > p.born)
                groups.setdefault(ahead, []).append(p)
        touched = self._touched(keys, {p.buckets for ps in groups.values() for p in ps}) if keys is not None else None
        for ahead, parts in groups.items():
            files = [f for p in parts for f in p.files if touched is None or _bucket(f) in touched[p.buckets]]
            if not files:
                continue
            rows = self._open(self.schemas[table], files)
            if ahead:
                marked = self._open(self._key_schema(), [f for i in ahead for f in version.marks[i].files]).distinct()
                rows = rows.join(marked, self.key, "left_anti").select(*self.schemas[table].names)
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            return self.spark.createDataFrame([], self.schemas[table])
        return out if keys is None else known_subset(out, keys, self.key).select(*self.schemas[table].names)

    def _touched(self, keys: DataFrame, counts: set[int]) -> dict[int, set[int]]:
        """Per number of buckets those that hold a key; counts are powers of two, so one set serves all."""
        most = max(counts, default=1)
        found = {r.b for r in keys.select(bucket_of(F.col(self.key), most).alias("b")).distinct().collect()}
        return {n: {b % n for b in found} for n in counts}

    def _key_schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.key, next(iter(self.schemas.values()))[self.key].dataType)])

    def _open(self, schema: T.StructType, files: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in files])

    # --- writing ---

    def _write(self, table: str, rows: DataFrame, born: int, level: int = 0, buckets: int | None = None) -> Part:
        """New files in a folder of their own; invisible until a version names them."""
        schema = self.schemas.get(table) or self._key_schema()
        folder = f"data/{table}/{uuid.uuid4().hex}"
        rows = rows.select(*schema.names)
        if buckets is None:
            rows = rows.persist()
            buckets = min(MOST_BUCKETS, 1 << max(0, math.ceil(math.log2(max(1, rows.count()) / self.rows_per_bucket))))
        try:
            placed = rows.withColumn("bucket", bucket_of(F.col(self.key), buckets))
            # A range of buckets per task, whatever their number; rows of a bucket in order of the key.
            placed.repartition(min(buckets, 2048), "bucket").sortWithinPartitions("bucket", self.key).write.option(
                f"parquet.bloom.filter.enabled#{self.key}", "true").partitionBy("bucket").parquet(f"{self.root}/{folder}")
        finally:
            rows.unpersist()
        files = self._names(folder)
        size = self._open(schema, files).count() if files else 0
        return Part(table, files, buckets, size, born, level)

    def written(self, writer: str, batch: int) -> bool:
        """Whether a writer's batch is in the newest version; batches of a writer come in order."""
        return self.version().writers.get(writer, -1) >= batch

    def append(self, tables: dict[str, DataFrame], writer: str, batch: int) -> Version:
        """Rows for several tables, visible together and once per (writer, batch)."""
        at = self.version()
        if at.writers.get(writer, -1) >= batch:
            return at
        number = at.number + 1
        added = [self._write(name, rows, number) for name, rows in tables.items()]
        done = self._commit(Version(number, at.parts + [p for p in added if p.rows], at.marks, {**at.writers, writer: batch}))
        return self.compact(done)

    def compact(self, at: Version | None = None) -> Version:
        """Merge size classes that are full; rows marked as deleted stay out of the merged files.

        Only parts with the same marks ahead are merged, so every part keeps one birth.
        """
        at = at or self.version()
        for table in self.schemas:
            classes: dict[tuple, list[Part]] = {}
            for p in at.parts:
                ahead = sum(m.born > p.born for m in at.marks)
                if p.table == table:
                    classes.setdefault((p.level, ahead), []).append(p)
            for (level, _), parts in sorted(classes.items()):
                if len(parts) >= self.fan:
                    rows = self.read(table, Version(at.number, parts, at.marks))
                    merged = self._write(table, rows, max(p.born for p in parts), level + 1)
                    # Its marks are applied already, and later ones have later births.
                    merged = Part(**{**vars(merged), "born": at.number})
                    kept = [p for p in at.parts if p not in parts]
                    return self.compact(self._commit(Version(at.number + 1, kept + ([merged] if merged.rows else []), at.marks, at.writers)))
        return at

    def delete(self, keys: DataFrame) -> Version:
        """Rows with these keys leave all tables at once: a mark that readers merge."""
        at = self.version()
        number = at.number + 1
        mark = self._write("marks", keys.select(self.key).where(F.col(self.key).isNotNull()).distinct(), number)
        return self._commit(Version(number, at.parts, at.marks + ([mark] if mark.rows else []), at.writers))

    def purge(self) -> Version:
        """Take marked rows out of the files: only files that hold one are rewritten, all tables in one version."""
        at = self.version()
        if not at.marks:
            return at
        number, parts = at.number + 1, []
        for p in at.parts:
            ahead = [m for m in at.marks if m.born > p.born]
            if not ahead:
                parts.append(p)
                continue
            marked = self._open(self._key_schema(), [f for m in ahead for f in m.files]).distinct()
            touched = self._touched(marked, {p.buckets})[p.buckets]
            near = [f for f in p.files if _bucket(f) in touched]
            hit = set()
            if near:
                found = self._open(self._key_schema(), near).select(self.key, F.col("_metadata.file_path").alias("file"))
                # As many names as files, at most.
                names = known_subset(found, marked, self.key).select("file").distinct().collect()
                hit = {f for f in near if any(r.file.endswith(f) for r in names)}
            stay = [f for f in p.files if f not in hit]
            rows = p.rows
            if hit:
                left = self._open(self.schemas[p.table], sorted(hit)).join(marked, self.key, "left_anti")
                fresh = self._write(p.table, left, number, p.level, p.buckets)
                gone = self._open(self.schemas[p.table], sorted(hit)).count() - fresh.rows
                stay, rows = stay + fresh.files, rows - gone
            if stay:
                parts.append(Part(p.table, stay, p.buckets, rows, at.number, p.level))
        return self._commit(Version(number, parts, [], at.writers))

    def expire(self, keep: int = KEEP_VERSIONS) -> int:
        """Forget old versions and delete files that no kept version names; gives the number of files.

        Not while a writer is between its files and its version.
        """
        known = self.numbers()
        kept = {f for n in known[-keep:] for v in [self.version(n)] for p in v.parts + v.marks for f in p.files}
        fs = self._files()
        for n in known[:-keep]:
            fs.delete(self._path(f"log/{n:012d}.json"), False)
        gone = [f for f in self._names("data") if f not in kept]
        for f in gone:
            fs.delete(self._path(f), False)
        return len(gone)

    def change(self, step: Callable[[], Version], tries: int = 5) -> Version:
        """Repeat a change that lost its version to another writer."""
        for left in range(tries - 1, -1, -1):
            try:
                return step()
            except Conflict:
                if not left:
                    raise
        raise AssertionError


def _bucket(file: str) -> int:
    return int(file.rsplit("bucket=", 1)[1].split("/", 1)[0])
