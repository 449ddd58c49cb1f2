import random
from collections import Counter
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from shoplens.llm import simhash
from shoplens.llm.common import materialize
from shoplens.llm.components import components


def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w.decode() for w in lower.encode().split()]
    if not words:
        return 0
    grams = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, bits=2):
    """Union of all pairs of fingerprints at most ``bits`` apart."""
    names = sorted(set(prints))
    root = {p: p for p in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(names, 2):
        if (a ^ b).bit_count() <= bits:
            root[find(b)] = find(a)
    return {p: find(p) for p in names}


def test_fingerprints(rows):
    for r in rows:
        assert simhash.fingerprint(r[1]) == brute_print(r[1])


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{k * k % 97}" for k in range(1000))
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 64)
    assert simhash.fingerprint(text) == brute_print(text)


def test_every_near_pair_shares_an_anchor():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 300, dtype="int64")
    for flips in (0, 1, 2):
        b = a.copy()
        for k in range(len(b)):
            for bit in rng.choice(64, flips, replace=False):
                b[k] ^= np.array(1 << int(bit), dtype="uint64").view("int64")
        row, home = simhash.anchors(a, 0)
        assert len(row) == len(a)
        visits = set(zip(*(x.tolist() for x in simhash.anchors(b, 2))))
        assert all((int(r), int(h)) in visits for r, h in zip(row, home))


def test_code_is_perfect():
    pattern, excess = simhash._cosets(0)
    assert pattern.shape[0] == 2048 and ((excess == 0).sum(axis=1) == 1).all()


def test_components(spark):
    rng = random.Random(2)
    chain = [(k, k + 1) for k in range(100, 180)]
    star = [(500, 600 + k) for k in range(50)]
    extra = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    extra = [(min(e), max(e)) for e in extra if e[0] != e[1]]
    edges = chain + star + extra + chain[:5]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def test_replicas_are_no_broadcast_table(spark):
    rng = np.random.default_rng(8)
    prints = rng.integers(-(1 << 63), 1 << 63, 3000, dtype="int64")
    prints[::3] = prints[1::3] ^ 5                                # two bits away
    nodes = materialize(spark.createDataFrame([(x,) for x in prints.tolist()], "print long"), "nodes")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "8m")       # stands for the driver's memory
    try:
        links = {(r.a, r.b) for r in simhash.near_links(nodes).collect()}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    near = {(min(x, y), max(x, y)) for x, y in zip(prints[::3].tolist(), prints[1::3].tolist())}
    assert links == near


def test_groups(spark, docs, rows, no_docs):
    rng = random.Random(4)
    base = [f"v{rng.randrange(300)}" for _ in range(300)]
    near = []
    for k in range(30):
        words = list(base)
        for _ in range(k // 6):
            words[rng.randrange(300)] = f"z{rng.randrange(9)}"
        near.append((5000 + k, " ".join(words)))
    every = [(r[0], r[1]) for r in rows] + near
    df = spark.createDataFrame(every, "doc_id long, text string").withColumn("label", F.lit("x"))
    got = simhash.near_groups(df).collect()
    prints = [brute_print(t) for _, t in every]
    group = groups(prints)
    least = {}
    for (doc, _), p in zip(every, prints):
        if doc is not None:
            g = group[p]
            least[g] = min(least.get(g, doc), doc)
    want = Counter((doc, p, least.get(group[p])) for (doc, _), p in zip(every, prints))
    assert Counter((r.doc_id, r.print & (2 ** 64 - 1), r.component) for r in got) == want
    assert simhash.near_groups(no_docs).count() == 0


def test_keep_one(docs, rows, no_docs):
    kept = simhash.keep_one(docs.withColumn("node", F.lit(1)))
    assert kept.columns == docs.columns + ["node"]
    got = [(r.doc_id, r.text) for r in kept.collect()]
    group = groups([brute_print(r[1]) for r in rows])
    best = {}
    for r in rows:
        name = (r[0] is None, r[0] or 0)
        g = group[brute_print(r[1])]
        best[g] = min(best.get(g, name), name)
    assert sorted((d is None, d or 0) for d, _ in got) == sorted(best.values())
    assert simhash.keep_one(no_docs).count() == 0
