import random

import numpy as np
import xxhash

from cardwarden.llm import components, simhash


def fingerprint(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in words).split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps):
    """fps: list of (id, fp) -> component id per row."""
    ids = list(range(len(fps)))

    def find(i):
        while ids[i] != i:
            i = ids[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= 3:
                a, b = find(i), find(j)
                ids[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(fps):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(fps))]


def test_groups_equal_brute_force(spark, folder, sample_docs):
    rows = [(r.doc_id, r.text) for r in sample_docs.collect()]
    fps = [(k, fingerprint(t)) for k, t in rows]
    want = {k: (f"{fp:016x}", c) for (k, fp), c in zip(fps, brute_groups(fps))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.grouped(sample_docs).collect()}
    assert got == want


def test_edge_rows(spark, folder):
    rows = [(5, None), (7, ""), (3, " \n"), (None, "A b"), (9, "a B"), (9, "a B"), (None, "lonely words here today"),
            (11, "word " * 70_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.grouped(df).collect()]
    assert sorted(c for k, f, c in got if f == "0" * 16) == [3, 3, 3]
    assert [c for k, f, c in got if k == 9] == [9, 9] and len(got) == 8
    assert (None, 9) in [(k, c) for k, _, c in got] and (None, None) in [(k, c) for k, _, c in got]
    assert simhash.grouped(df.limit(0)).count() == 0



def near_set(rng, n, center, flips):
    return sorted({center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(n)})


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def roots(spark, fps):
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp bigint")
    found = {r.node: r.root for r in components.components(simhash.links(df)).collect()}
    return [found.get(signed(x), signed(x)) for x in fps]


def same_classes(a, b):
    return len({*zip(a, b)}) == len({*a}) == len({*b})


def test_links_connect_exactly_the_pairs_within_three_bits(spark, folder):
    rng = random.Random(4)
    fps = near_set(rng, 300, rng.getrandbits(64), 6) + near_set(rng, 200, rng.getrandbits(64), 9)
    fps = sorted({*fps, *(rng.getrandbits(64) for _ in range(300))})
    want = brute_groups([(i, x) for i, x in enumerate(fps)])
    assert same_classes(roots(spark, fps), want)


def test_long_lists_lose_no_link(spark, folder, monkeypatch):
    monkeypatch.setattr(simhash, "LIST_ROWS", 8)
    rng = random.Random(5)
    fps = sorted({*near_set(rng, 400, rng.getrandbits(64), 5), *(rng.getrandbits(64) for _ in range(50))})
    assert same_classes(roots(spark, fps), brute_groups([(i, x) for i, x in enumerate(fps)]))


def test_cube_links_equal_pairs():
    rng = np.random.default_rng(1)
    rest = np.unique(rng.integers(0, 1 << 24, 60) & 0x3FF)
    fp = rest.astype(np.uint64)
    a, b = simhash._cube_links(fp, rest)
    label = {int(x): int(x) for x in fp}
    label.update({int(y): int(x) for x, y in zip(a, b)})
    want = brute_groups([(int(x), int(x)) for x in fp])
    assert same_classes([label[int(x)] for x in fp], want)


def test_components_of_chains_stars_and_nulls(spark, folder):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(50)] + [(1001, 1000), (1000, 1000)]
    df = spark.createDataFrame(chain + star + [(None, 3), (4, None)], "a bigint, b bigint")
    found = {r.node: r.root for r in components.components(df).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(51)}}
