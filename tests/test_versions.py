import pytest
from pyspark.sql import functions as F

from cardwarden.session import work_path
from cardwarden.sinks import versions
from cardwarden.sinks.versions import Conflict, VersionedTables
from pyspark.sql import types as T

PARENT = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
CHILD = T.StructType([T.StructField("id", T.LongType()), T.StructField("p", T.DoubleType())])


@pytest.fixture
def store(spark):
    return VersionedTables(spark, work_path(spark, "versions-test"), {"parent": PARENT, "child": CHILD}, "id",
                           rows_per_bucket=50, fan=3)


def rows(spark, lo, hi):
    ids = spark.range(lo, hi)
    return {"parent": ids.select("id", F.concat(F.lit("n"), "id").alias("name")),
            "child": ids.select("id", (F.col("id") / 2).alias("p")).union(ids.select("id", F.lit(-1.0)))}


def ids_of(df):
    return sorted(r.id for r in df.select("id").collect())


def test_versions_batches_and_pinned_readers(spark, store):
    assert store.read("parent").count() == 0 and store.version().number == 0
    store.append(rows(spark, 0, 10), "w", 0)
    first = store.version()
    store.append(rows(spark, 10, 20), "w", 1)
    store.append(rows(spark, 500, 600), "w", 1)  # a replay
    store.append(rows(spark, 20, 25), "other", 0)
    assert ids_of(store.read("parent")) == list(range(25))
    assert store.read("child").count() == 50
    assert ids_of(store.read("parent", first)) == list(range(10))
    assert store.written("w", 1) and not store.written("w", 2) and store.written("other", 0)


def test_lookups_open_only_their_buckets(spark, store):
    store.append(rows(spark, 0, 2000), "w", 0)
    part = next(p for p in store.version().parts if p.table == "parent")
    assert part.buckets == 64 and len(part.files) == 64
    found = store.read("parent", keys=spark.createDataFrame([(7,), (7,), (123456,), (None,)], "id bigint"))
    assert ids_of(found) == [7] and len(found.inputFiles()) <= 3
    before = len(found.inputFiles())
    for b in range(1, 6):  # history grows, the lookup's files only by the open size classes
        store.append(rows(spark, 2000 * b, 2000 * b + 2000), "w", b)
    again = store.read("parent", keys=spark.createDataFrame([(7,), (7,), (123456,), (None,)], "id bigint"))
    assert ids_of(again) == [7] and len(again.inputFiles()) <= before * 4


def test_many_batches_leave_few_parts_and_one_version_per_reader(spark, store):
    pinned = []
    for b in range(30):
        store.append(rows(spark, b * 2, b * 2 + 2), "w", b)
        pinned.append((b, store.version()))
    assert ids_of(store.read("parent")) == list(range(60))
    parts = store.version().parts
    assert len([p for p in parts if p.table == "parent"]) <= 8 and len(parts) <= 16
    for b, version in pinned[::7]:
        assert ids_of(store.read("parent", version)) == list(range(2 * b + 2))
        assert store.read("child", version).count() == 2 * (2 * b + 2)
    gone = store.expire(keep=1)
    assert gone > 0 and ids_of(store.read("parent")) == list(range(60)) and store.expire(keep=1) == 0
    assert store.numbers() == [store.version().number]


def test_deletes_cascade_and_untouched_files_stay(spark, store):
    store.append(rows(spark, 0, 2000), "w", 0)
    old = store.version()
    store.delete(spark.createDataFrame([(5,), (5,), (None,), (99_999,)], "id bigint"))
    marked = store.version()
    want = [i for i in range(2000) if i != 5]
    for v in (marked, None):
        assert ids_of(store.read("parent", v)) == want and store.read("child", v).where("id = 5").count() == 0
    store.append(rows(spark, 5, 6), "w", 1)  # the key comes back after its deletion
    assert ids_of(store.read("parent")) == list(range(2000))
    before = {f for p in store.version().parts for f in p.files}
    store.purge()
    after = {f for p in store.version().parts for f in p.files}
    assert not store.version().marks and len(before - after) == 2 and len(after - before) == 2  # one file a table
    assert ids_of(store.read("parent")) == list(range(2000)) and store.read("child").count() == 4000
    assert sum(p.rows for p in store.version().parts if p.table == "child") == 4000
    assert ids_of(store.read("parent", old)) == list(range(2000)) and ids_of(store.read("parent", marked)) == want


def test_compaction_applies_marks(spark, store):
    for b in range(2):
        store.append(rows(spark, b * 5, b * 5 + 5), "w", b)
    store.delete(spark.createDataFrame([(1,), (7,)], "id bigint"))
    for b in range(2, 8):
        store.append(rows(spark, b * 5, b * 5 + 5), "w", b)
    want = [i for i in range(40) if i not in (1, 7)]
    assert ids_of(store.read("parent")) == want and store.read("child").count() == 76
    store.purge()
    assert ids_of(store.read("parent")) == want and store.read("child").count() == 76
    store.delete(spark.range(1000))
    assert store.read("parent").count() == 0
    store.purge()
    assert store.read("child").count() == 0 and not store.version().parts


@pytest.mark.parametrize("step", [0, 1, 2])
def test_crashes_show_nothing(spark, store, monkeypatch, step):
    """A writer that dies after its first table, its second, or before its version leaves the last version."""
    store.append(rows(spark, 0, 10), "w", 0)
    calls = []
    write, commit = VersionedTables._write, VersionedTables._commit

    def dying(self, *a, **k):
        if len(calls) == step:
            raise OSError("lost")
        calls.append(1)
        return write(self, *a, **k)

    def no_commit(self, version):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTables, "_write", dying) if step < 2 else m.setattr(VersionedTables, "_commit", no_commit)
        with pytest.raises(OSError):
            store.append(rows(spark, 10, 20), "w", 1)
    assert ids_of(store.read("parent")) == list(range(10)) and store.version().number == 1
    store.append(rows(spark, 10, 20), "w", 1)
    assert ids_of(store.read("parent")) == list(range(20)) and store.read("child").count() == 40


def test_two_writers_cannot_take_one_version(spark, store):
    at = store.version()
    store._commit(versions.Version(at.number + 1))
    with pytest.raises(Conflict):
        store._commit(versions.Version(at.number + 1))
    tries = []

    def step():
        tries.append(1)
        if len(tries) < 3:
            raise Conflict
        return store.version()
    assert store.change(step).number == 1 and len(tries) == 3
