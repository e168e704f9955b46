"""Fill-in-the-middle transformation of texts, digested and restored as streams of pieces.

A text is cut into prefix, middle and suffix at two places drawn from a digest of its id, and the
three are put in the order of its form.  Texts go out in pieces of ``UNIT`` code points keyed by
document and output position; a repartition by document with a sort inside the partitions (in JVM
memory, spilling) streams them into an incremental digest, and a second sort by restored position
streams them into another.  No task holds more than a batch of pieces, however long a text.

Null text counts as empty; a text that is empty, holds a sentinel or is drawn plain stays as it is.  A null
id draws like an id without digits.  Rows with equal ids are documents of their own.  Bytes that are not
UTF-8 count as one code point each and come back unchanged.  Columns other than id and text play no
part, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import each_bytes, few_rows

UNIT = 65_536
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, MIDDLE, SUFFIX)  # in the order of the text
# Fixed values of the draw, in percent.
PLAIN_SHARE, SPM_SHARE = 10, 20
OUTPUT_ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
HEAD = -1  # the position of a document's row of facts, before its pieces


@dataclass(frozen=True)
class Cut:
    """How a text of n code points is cut; plain texts have no parts."""

    form: str
    first: int | None = None
    second: int | None = None


def cut_of(key: str, text: str) -> Cut:
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in MARKS) or h3 % 100 >= 100 - PLAIN_SHARE:
        return Cut("plain")
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    return Cut("spm" if h4 % 100 < SPM_SHARE else "psm", a, b)


def pieces_of(text: str, cut: Cut, unit: int = UNIT) -> Iterator[str]:
    """The output in order; a part's first piece starts with its sentinel, every part has one."""
    if cut.form == "plain":
        parts = [("", text)]
    else:
        bounds = dict(zip(MARKS, ((0, cut.first), (cut.first, cut.second), (cut.second, len(text)))))
        parts = [(m, text[slice(*bounds[m])]) for m in OUTPUT_ORDER[cut.form]]
    for mark, part in parts:
        yield mark + part[:unit]
        for i in range(unit, len(part), unit):
            yield part[i:i + unit]


def _encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


PIECE = "uid bigint, place bigint, data binary"
FACTS = "n bigint, form string, prefix_chars bigint, middle_chars bigint"


class _Rows:
    """Output rows, handed on in batches of bounded size."""

    def __init__(self, schema: pa.Schema, most: int = 1 << 20):
        self.schema, self.most = schema, most
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, size: int) -> pa.RecordBatch | None:
        self.rows.append(row)
        self.size += size + 64
        return self.flush() if self.size >= self.most else None

    def flush(self) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        columns = [pa.array(c, t.type) for c, t in zip(zip(*self.rows), self.schema)]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _schema(**fields) -> pa.Schema:
    return pa.schema([pa.field(k, v) for k, v in fields.items()])


FACT_FIELDS = dict(doc_key=pa.string(), n=pa.int64(), form=pa.string(), prefix_chars=pa.int64(), middle_chars=pa.int64())
SENT = _schema(uid=pa.int64(), place=pa.int64(), data=pa.binary(), **FACT_FIELDS)
JOINED = _schema(uid=pa.int64(), place=pa.int64(), data=pa.binary(), **FACT_FIELDS, output_sha256=pa.string())
DONE = _schema(**FACT_FIELDS, output_sha256=pa.string(), restored_sha256=pa.string())


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _send(batches, unit: int):
    """Pieces of every text by output position, after a row of facts."""
    out = _Rows(SENT)
    for batch in batches:
        for uid, key, data in zip(batch.column("uid").to_pylist(), batch.column("doc_key").to_pylist(), each_bytes(batch, "text")):
            text = (data or b"").decode("utf-8", "surrogateescape")
            cut = cut_of(key or "", text)
            plain = cut.form == "plain"
            full = out.add((uid, HEAD, None, key, len(text), cut.form, None if plain else cut.first,
                            None if plain else cut.second - cut.first), 0)
            if full:
                yield full
            for place, piece in enumerate(pieces_of(text, cut, unit)):
                piece = _encoded(piece)
                full = out.add((uid, place, piece, *[None] * len(FACT_FIELDS)), len(piece))
                if full:
                    yield full
    last = out.flush()
    if last:
        yield last


def _documents(batches) -> Iterator[tuple]:
    """Sorted rows, one at a time, as Python values."""
    for batch in batches:
        for part in few_rows(batch):
            yield from zip(*[c.to_pylist() for c in part.columns])


def _join(batches):
    """Pieces in output order into a digest; each is sent on with its place in the restored text.

    Only output and form are read: a piece that starts with a sentinel opens that part.
    """
    out, facts, digest, opened = _Rows(JOINED), None, None, 0
    for uid, place, data, *fields in _documents(batches):
        if place == HEAD:
            if facts:
                full = out.add((*facts, digest.hexdigest()), 64)
                if full:
                    yield full
            facts, digest, opened = (uid, HEAD, None, *fields), hashlib.sha256(), 0
            form = fields[2]
            continue
        digest.update(data)
        if form != "plain":
            for part, mark in enumerate(MARKS):
                if data.startswith(mark.encode()):
                    opened, data = part << 40, data[len(mark):]
                    break
        full = out.add((uid, opened + place, data, *[None] * (len(FACT_FIELDS) + 1)), len(data))
        if full:
            yield full
    if facts:
        out.add((*facts, digest.hexdigest()), 64)
    last = out.flush()
    if last:
        yield last


def _restore(batches):
    out, facts, digest = _Rows(DONE), None, None
    for _, place, data, *fields in _documents(batches):
        if place == HEAD:
            if facts:
                full = out.add((*facts, digest.hexdigest()), 64)
                if full:
                    yield full
            facts, digest = fields, hashlib.sha256()
        else:
            digest.update(data)
    if facts:
        out.add((*facts, digest.hexdigest()), 64)
    last = out.flush()
    if last:
        yield last


def sent(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: int = UNIT) -> DataFrame:
    """All pieces by document and output position, sorted inside partitions: the output as a table.

    ``uid`` numbers the rows of ``docs``; joining ``data`` by place gives a document's output.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{key}`").cast("string").alias("doc_key"),
                       F.col(f"`{text}`").alias("text"))
    made = rows.mapInArrow(lambda batches: _send(batches, unit), _ddl(SENT))
    return made.repartition("uid").sortWithinPartitions("uid", "place")


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: int = UNIT) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every document."""
    joined = sent(docs, key, text, unit).mapInArrow(_join, _ddl(JOINED))
    # Pieces stay in their partitions, so the second sort moves nothing between executors.
    done = joined.sortWithinPartitions("uid", "place").mapInArrow(_restore, _ddl(DONE))
    return done.select(F.col("doc_key").cast(docs.schema[key].dataType).alias(key),
                       "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
