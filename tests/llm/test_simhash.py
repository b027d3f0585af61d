import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spindle.llm import simhash as S


def plain_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(prints, max_bits=4):
    """Smallest index reachable."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def by_components(rows, prints):
    groups = {}
    for (doc_id, _), c in zip(rows, plain_components(prints), strict=True):
        groups.setdefault(c, []).append(doc_id)
    least = {c: min((i for i in ids if i is not None), default=None) for c, ids in groups.items()}
    return sorted(((i, f"{p:016x}", least[c]) for (i, _), p, c in zip(rows, prints, plain_components(prints), strict=True)), key=str)


def run(df, **how):
    return sorted((tuple(r) for r in S.near_duplicates(df, **how).select("doc_id", S.fp_hex(F.col("fp")), "component_id").collect()), key=str)


def test_whole_table_against_a_plain_version(small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    assert run(small_docs) == by_components(rows, [plain_print(t) for _, t in rows])


def test_fingerprint_of_many_chunks(monkeypatch):
    text = " ".join(str(i % 997) for i in range(3000))
    want = plain_print(text)
    monkeypatch.setattr(S, "CHUNK", 100)
    assert S.simhash64(text.encode()) == want


def test_links_and_blocks_against_all_pairs(spark):
    rng = random.Random(5)
    prints = []
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            p = base
            for b in rng.sample(range(64), rng.randrange(0, 6)):
                p ^= 1 << b
            prints.append(p)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    want = {}
    for p, c in zip(prints, plain_components(prints), strict=True):
        want.setdefault(c, set()).add(p)
    want = {frozenset(g) for g in want.values() if len(g) > 1}
    for block in (2048, 2):
        got = {}
        for r in S.components(S.links(df, 4, block)).collect():
            got.setdefault(r.root, set()).add(r.node % (1 << 64))
        assert {frozenset(g) for g in got.values()} == want


def test_components_of_a_long_chain(spark):
    chain = list(range(1, 200))
    random.Random(1).shuffle(chain)
    edges = spark.createDataFrame([(i, i + 1) for i in chain], "a long, b long")
    got = S.components(edges).collect()
    assert len(got) == 200 and {r.root for r in got} == {1}


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert run(edge_docs) == by_components(rows, [plain_print(t) for _, t in rows])
    assert run(no_docs) == []


def test_keep_one(spark, edge_docs, no_docs, small_docs):
    kept = S.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    groups = plain_components([plain_print(t) for _, t in rows])
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(groups))
    for c in set(groups):
        ids = [r[0] for r, g in zip(rows, groups, strict=True) if g == c]
        mine = [r for r in got if r in [x for x, g in zip(rows, groups, strict=True) if g == c]]
        assert len(mine) >= 1 and mine[0][0] == min((i for i in ids if i is not None), default=None)
    assert S.keep_one(no_docs).count() == 0
    prints = [plain_print(r.text) for r in small_docs.collect()]
    assert S.keep_one(small_docs).count() == len(set(plain_components(prints)))


def test_tally_and_list_width():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    b = a.copy()
    for i in range(500):
        for byte in rng.choice(8, int(rng.integers(0, 9)), replace=False):
            b[i] ^= np.uint64(int(rng.integers(0, 256)) << (8 * int(byte)))
    want = [sum((int(x) >> s & 255) == (int(y) >> s & 255) for s in range(0, 64, 8)) for x, y in zip(a, b, strict=True)]
    assert S.shared_bytes(a, b).tolist() == want
    assert [S.list_width(n, 2048, 4) for n in (0, 2048 * 256, 2048 * 256 + 1, 2048 * 65536 + 1, 10 ** 15)] == [1, 1, 2, 3, 4]


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_every_width_gives_the_same_components(spark, width, monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.integers(-(1 << 62), 1 << 62, 40)
    near = [int(x) ^ sum(1 << int(k) for k in rng.choice(60, int(rng.integers(0, 6)), replace=False)) for x in base for _ in range(3)]
    fps = sorted({*map(int, base), *near})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    monkeypatch.setattr(S, "list_width", lambda n, block, most: width)
    got = {frozenset(v) for v in grouped(S.components(S.links(df, 4, 16)).collect()).values()}
    lab = {x: x for x in fps}
    for i, x in enumerate(fps):
        for y in fps[:i]:
            if ((x ^ y) & (2 ** 64 - 1)).bit_count() <= 4:
                old, new = lab[x], lab[y]
                lab = {k: new if v == old else v for k, v in lab.items()}
    want = {}
    for k, v in lab.items():
        want.setdefault(v, set()).add(k)
    assert got == {frozenset(v) for v in want.values() if len(v) > 1}


def grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r.root, set()).add(r.node)
    return out
