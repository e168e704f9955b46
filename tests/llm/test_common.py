import tracemalloc

import pyarrow as pa

from cardwarden.llm import common, leaks


class Rows:
    """Hands the given batches to what ``mapInArrow`` is given."""

    def __init__(self, *batches):
        self.batches = batches

    def mapInArrow(self, run, schema):
        return list(run(iter(self.batches)))


def test_large_batches_are_worked_on_in_slices():
    """All rows come back in order, a slice has some MB, and a row of any size is a slice of its own."""
    texts = ["x" * 5000] * 4000 + ["y" * (2 * common.BATCH_BYTES)] * 3 + [None, ""]
    batch = pa.RecordBatch.from_pydict({"n": list(range(len(texts))), "text": texts})
    seen = []

    def run(part):
        seen.append((part.num_rows, part.nbytes))
        return part

    out = common.map_batches(Rows(batch, batch.slice(0, 0), batch.slice(0, 2)), run, "n bigint, text string")
    assert pa.Table.from_batches(out).column("n").to_pylist() == [*range(len(texts)), 0, 1]
    assert len(seen) > 5 and all(rows == 1 or size <= 8 * common.BATCH_BYTES for rows, size in seen)
    assert common.map_batches(Rows(batch), lambda part: None, "n bigint") == []


def test_decontamination_holds_some_texts_and_words():
    """6,000 texts of 3 KB with 3 million different words, 18 MB, are neither held as objects nor kept as digests."""
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(f"{i:x}q{j:x}" for j in range(500)) for i in range(6000)]})
    block = leaks.Block([(1, "one two three four five six seven eight")])
    digests = leaks.Digests()
    tracemalloc.start()
    try:
        for part in common.some_bytes(batch):
            assert leaks._batch_matches(block, digests, common.each_bytes(part, "text")) == {}
        assert tracemalloc.get_traced_memory()[1] < 32e6
    finally:
        tracemalloc.stop()
