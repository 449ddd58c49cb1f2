import random
from itertools import combinations

import pytest

from shoplens.llm import decontaminate as D


@pytest.mark.parametrize("size", range(1, D.WINDOW + 4))
def test_masks_catch_what_the_check_accepts(size):
    """An item below WINDOW tokens is judged as a whole, at four fifths."""
    window = min(size, D.WINDOW)
    replaced = window - -(-4 * window // 5)
    masks = [(len(D.EVERY_MASK[k]), D._OFFSETS[k]) for k in D.masks_for([size])]
    for bad in combinations(range(size), replaced):
        assert any(all(p + o not in bad for o in offsets)
                   for length, offsets in masks for p in range(size - length + 1))


def test_short_items_as_brute_force_finds_them(spark):
    rng = random.Random(3)
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in range(1, 13)}
    docs, want = [], set()
    for n, item in items.items():
        most = n - -(-4 * n // 5)
        for count in range(most + 2):
            for bad in combinations(range(n), min(count, n)):
                text = ["q" if k in bad else w for k, w in enumerate(item)]
                around = [[f"o{rng.randrange(999)}" for _ in range(rng.randrange(9))] for _ in "ab"]
                if count <= most:
                    want.add((len(docs), n, n - count))
                docs.append((len(docs), " ".join(around[0] + text + around[1])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(i)) for n, i in items.items()] + [(99, " .,- ")],
                                  "item_id long, text string")
    found = D.overlaps(df, bench)
    assert {(r.doc_id, r.item_id, r.matched) for r in found.collect()} == want


def test_a_hit_carries_no_more_than_its_item_covers(spark, monkeypatch):
    passage = " ".join(f"p{k}" for k in range(20))
    df = spark.createDataFrame([(1, " x ".join([passage] * 60)), (2, "y " + passage)],
                               "doc_id long, text string")
    bench = spark.createDataFrame([(7, "z " + passage + " z"), (8, "p3 p4")],
                                  "item_id long, text string")
    verify, carried = D._verify, []

    def spy(pairs):
        carried.extend(pairs.selectExpr("size(tokens)", "size(item_tokens)").collect())
        return verify(pairs)

    monkeypatch.setattr(D, "_verify", spy)
    found = {(r.doc_id, r.item_id, r.matched, r.place) for r in D.overlaps(df, bench).collect()}
    assert found == {(1, 7, 13, 0), (2, 7, 13, 1), (1, 8, 2, 3), (2, 8, 2, 4)}
    assert len(carried) >= 120 and all(t <= i + D.WINDOW for t, i in carried)
