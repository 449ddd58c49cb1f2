import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from shoplens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    """(root, per node [(side, sibling or None)])."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, p in enumerate(at):
            near = p ^ 1
            paths[k].append(("-", None) if near >= len(level) else ("LR"[near > p], level[near]))
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
        at = [p // 2 for p in at]
    return level[0], paths


def brute(rows):
    """{leaf: {(doc_id, subroot, root, steps, proof)}}."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0], leaf(*r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        own[g] = tree([x[1] for x in groups[g]])
    root, above = tree([own[g][0] for g in order])
    out = []
    for g, outer in zip(order, above):
        for (doc_id, node), path in zip(groups[g], own[g][1]):
            whole = path + outer
            out.append((doc_id, node, own[g][0], root, "".join(s for s, _ in whole),
                        tuple(x for _, x in whole if x)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.key, r.leaf, r.subroot, r.root, r.steps, tuple(r.proof)) for r in df.collect()), key=str)


def test_manifest_equals_brute_force(docs, rows):
    for height in (10, 2, 1):
        out = merkle.manifest(merkle.leaves(docs), height)
        assert found(out) == brute(rows)
        assert all(r.folded_root == r.root for r in out.collect())


def test_uneven_groups(spark):
    rng = random.Random(3)
    rows = [(k, f"text {k}", g, None, k) for g, n in (("é", 1), ("z", 33), (None, 5), ("", 4), ("~", 17), ("a", 2))
            for k in range(n)]
    rng.shuffle(rows)
    assert found(merkle.manifest(merkle.leaves(spark.createDataFrame(rows, SCHEMA)), 2)) == brute(rows)


def test_lone_leaves(spark):
    rows = [(k, "x", f"g{k}", "s", 1) for k in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = merkle.manifest(merkle.leaves(df))
    assert found(out) == brute(rows) and all(r.folded_root == r.root for r in out.collect())
    one = merkle.manifest(merkle.leaves(df.limit(1))).collect()
    assert len(one) == 1 and one[0].root == one[0].leaf == one[0].subroot and list(one[0].proof) == []


def test_a_changed_leaf_does_not_verify(docs, rows):
    changed = merkle.leaf_of([F.col(c) if c != "n_chars" else F.lit(-1) for c in merkle.FIELDS])
    out = merkle.manifest(merkle.leaves(docs, claimed=F.when(F.col("doc_id") % 3 == 0, changed))).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.folded_root == r.root) == (r.key is None or r.key % 3 != 0)
        assert r.folded_root == merkle.fold(r.claimed, r.steps, r.proof)


def test_nulls_repeats_and_clashing_names(spark, docs, rows, no_docs):
    wide = docs.select("*", F.lit(1).alias("key"), F.lit(2).alias("tree"), F.lit(3).alias("position"))
    assert found(merkle.manifest(merkle.leaves(wide))) == brute(rows)
    assert merkle.manifest(merkle.leaves(no_docs)).count() == 0
    same = [(1, "t", "en", "s", 1)] * 9 + [(None, None, None, None, None)] * 3
    assert found(merkle.manifest(merkle.leaves(spark.createDataFrame(same, SCHEMA)))) == brute(same)


def test_long_text(spark):
    rows = [(k, "é" * (300_000 + k), "en", "s", None) for k in range(3)]
    assert found(merkle.manifest(merkle.leaves(spark.createDataFrame(rows, SCHEMA)))) == brute(rows)
