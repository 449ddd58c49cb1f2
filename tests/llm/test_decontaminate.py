import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import bitmap
from shoplens.llm import decontaminate as D


def brute(docs, items):
    """{(doc_id, smallest id of the equal items): (matched, window)}"""
    out = {}
    first = {}
    for i, item in items:
        own = tuple(D._WORD.findall((item or "").lower()))
        first[own] = min(first.get(own, i), i)
    items = [(i, item) for i, item in items if first[tuple(D._WORD.findall((item or "").lower()))] == i]
    for d, text in docs:
        w = D._WORD.findall((text or "").lower())
        for i, item in items:
            t = D._WORD.findall((item or "").lower())
            if len(t) < D.LEAST_TOKENS:
                continue
            size = min(D.WINDOW, len(t))
            best = max((sum(w[a + k] == t[b + k] for k in range(size))
                        for a in range(len(w) - size + 1) for b in range(len(t) - size + 1)), default=0)
            if 5 * best >= 4 * size:
                out[d, i] = (best, size)
    return out


def test_masks_catch_two_substitutions_in_a_window():
    for size in range(D.WINDOW, D.WINDOW + 4):
        for bad in combinations(range(size), 2):
            assert any(all(p + o not in bad for o in offsets)
                       for offsets, mask in zip(D._OFFSETS, D.MASKS)
                       for p in range(size - len(mask) + 1))


def test_bitmap(spark):
    values = [random.Random(1).getrandbits(63) - 2 ** 62 for _ in range(500)]
    seen = bitmap.build(spark.createDataFrame([(v,) for v in values], "h long"), "h")
    assert bitmap.contains(seen, np.array(values, dtype="int64").view("uint64")).all()
    other = np.random.default_rng(2).integers(0, 2 ** 63, 5000).astype("uint64")
    assert bitmap.contains(seen, other).mean() < 0.01
    empty = bitmap.build(spark.createDataFrame([], "h long"), "h")
    assert not bitmap.contains(empty, other).any()


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(6)

    def words(n):
        return [f"t{rng.randrange(600)}" for _ in range(n)]
    items = [(k, " ".join(words(rng.randrange(15, 50)))) for k in range(25)]
    items += [(90, None), (91, ""), (92, "too short"), (93, "exactly five words in here"),
              (94, items[0][1])]
    docs = []
    for k in range(160):
        text = items[rng.randrange(25)][1].split()
        rate = rng.choice((0, 0.05, 0.1, 0.2, 0.4))
        text = [f"Q{rng.randrange(50)}" if rng.random() < rate else t for t in text]
        text = text[rng.randrange(4):len(text) - rng.randrange(4)]
        docs.append((k, " ".join(words(rng.randrange(40)) + text) + ", " + " ".join(words(rng.randrange(40)))))
    docs += [(500, None), (501, ""), (502, "So exactly five words in here."), (None, items[3][1]),
             (503, " ".join(words(5000)) + " " + items[4][1].upper())]
    docs += [(504, items[5][1])] * 2
    return docs, items


def test_overlaps(spark, cases):
    docs, items = cases
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hash", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("tokens", F.lit(0))
    got = {(r.doc_id, r.item_id): (r.matched, r.window) for r in D.overlaps(df, bench).collect()}
    assert got == brute(docs, items)
    clean = D.decontaminate(df, bench)
    assert clean.columns == df.columns
    bad = {d for d, _ in brute(docs, items)}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if d not in bad)


def test_copies_on_both_sides_give_no_pairs(spark):
    """40 copies of a document and 50 of an item: 40 links, 50 memberships."""
    text = " ".join(f"word{k}" for k in range(20))
    docs = spark.createDataFrame([(k, f"before {text} after") for k in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(k, text.upper() if k % 2 else text) for k in range(7, 57)] + [(99, "other " + text[7:])],
                                  "item_id long, text string")
    got = D.overlaps(docs, items.where("item_id < 99")).collect()
    assert len(got) == 40 and {(r.item_id, r.copies) for r in got} == {(7, 50)}
    groups = {r.item_id: r.represented_by for r in D.item_groups(items).collect()}
    assert groups == {**{k: 7 for k in range(7, 57)}, 99: 99}


def test_empty_sides(spark, docs, no_docs):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert D.overlaps(no_docs, bench).count() == 0
    assert D.overlaps(docs, bench.limit(0)).count() == 0
    assert D.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_split_keeps_every_row(spark):
    df = spark.range(2000).withColumn("text", F.concat(F.lit("t"), F.col("id").cast("string")))
    members = spark.createDataFrame([(k,) for k in range(0, 2000, 7)], "m long").select(
        F.xxhash64("m").alias("h"))
    some, rest = bitmap.split(df, F.xxhash64("id"), members, "h")
    a, b = ({r.id for r in x.collect()} for x in (some, rest))
    assert not a & b and len(a) + len(b) == 2000 and set(range(0, 2000, 7)) <= a
    some, rest = bitmap.split(df, F.xxhash64("id"), members.limit(0), "h")
    assert some.count() == 0 and rest.count() == 2000
