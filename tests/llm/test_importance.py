import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shoplens.llm import importance, ordering

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text):
    w = WORD.findall(lower(text))
    return len(w), [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % importance.BUCKETS


def brute(rows, target):
    """{(doc_id, n_features, weight, score, rank)} by counting one by one."""
    s = Counter(bucket(f) for _, t in rows for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    big_s, big_t = float(sum(s.values())), float(sum(t.values()))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in s}
    out = []
    for doc_id, text in rows:
        n, f = features(text)
        weight = sum(gain[bucket(x)] for x in f)
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    drawn = sorted((x for x in out if x[4] >= 20),
                   key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[2], x[1]))
    drawn = drawn[:len(drawn) * 5 // 100]
    ranks = {id(x): k + 1 for k, x in enumerate(drawn)}
    return Counter((*x[:4], ranks.get(id(x))) for x in out)


def got(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def test_checksums_of_spans():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(30000))
    start = np.array([rng.randrange(20000) for _ in range(400)])
    length = np.array([rng.choice([1, 2, 5, 20, 255, 256, 257, 512, 513, 1000, 9999]) for _ in range(400)])
    want = [zlib.crc32(data[a:a + n]) for a, n in zip(start, length)]
    assert importance.crc32_of_spans(np.frombuffer(data, "uint8"), start, length).tolist() == want


def test_buckets_of_texts():
    rng = random.Random(3)
    texts = ["", "a", "Über ÄB x1-y2", "x" * 5000 + " " + "y" * 400 + " z " + "q" * 10, "", "tail", "Head Z",
             " ".join("w" * rng.randrange(1, 300) for _ in range(200)), "İI ſK \U0001f642a b"]
    data = np.frombuffer("".join(texts).encode(), "uint8")
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    n_words, runs = importance._buckets(data, offsets)
    assert n_words.tolist() == [features(t)[0] for t in texts]
    found = Counter(b for _, buckets in runs for b in buckets.tolist())
    assert found == Counter(bucket(f) for t in texts for f in features(t)[1])


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(importance, "_SLICE", 40)
    rng = random.Random(4)
    texts = [" ".join("abcé"[rng.randrange(4)] * rng.randrange(1, 12) for _ in range(n)) for n in (0, 1, 2, 30, 300)]
    texts += ["x" * 500, " " * 300, "end " + " " * 100 + "a"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    words, n_features, _ = (np.concatenate(x) for x in zip(*importance._measured(batch, np.zeros(10000, "int64"))))
    assert words.tolist() == [features(t)[0] for t in texts]
    assert n_features.tolist() == [len(features(t)[1]) for t in texts]
    counts = sum(c for (c,) in importance._measured(batch, None))
    want = Counter(bucket(f) for t in texts for f in features(t)[1])
    assert {k: int(counts[k]) for k in np.flatnonzero(counts)} == want


def test_resample_equals_brute_force(spark, docs, rows):
    target = ["w1 w2 the of w3 extra line number", "copy", None, "", "W1 W2 the"] * 3
    table = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    wide = docs.withColumn("weight", F.lit("mine")).withColumn("__place", F.lit(1)).withColumn("rank", F.lit(2))
    assert got(importance.resample(wide, table)) == brute([r[:2] for r in rows], target)


def test_ranks_with_ties_and_nulls(spark):
    text = " ".join(f"t{k}" for k in range(25))
    rows = [(7, text)] * 30 + [(None, text)] * 20 + [(k, text) for k in range(100, 160)] + [(1, "few words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = importance.resample(df, spark.createDataFrame([("t1 t2 t3",)], "text string"), percent=30)
    assert out.count() == len(rows)
    ranked = [r["rank"] for r in out.collect() if r["rank"] is not None]
    assert sorted(ranked) == list(range(1, 110 * 30 // 100 + 1))
    assert got(importance.resample(df, spark.createDataFrame([("t1 t2 t3",)], "text string"))) == brute(rows, ["t1 t2 t3"])


def test_empty_tables(spark, docs, no_docs, rows):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(no_docs, nothing).count() == 0
    assert got(importance.resample(docs, nothing)) == brute([r[:2] for r in rows], [])


def test_numbered_by_ranges(spark):
    from shoplens.llm.common import materialize
    rng = random.Random(9)
    rows = [(rng.choice(["a"] * 8 + ["b", None]), rng.choice([None, *range(30)]), k) for k in range(2000)]
    df = materialize(spark.createDataFrame(rows, "g string, a long, position long"), "rows")
    out = ordering.numbered(df, ["a"], "g", position="__p", size="__n").collect()
    for g in ("a", "b", None):
        own = sorted((r for r in out if r.g == g), key=lambda r: r["__p"])
        assert [r["__p"] for r in own] == list(range(len(own))) and {r["__n"] for r in own} == {len(own)}
        keys = [(r.a is not None, r.a or 0) for r in own]
        assert keys == sorted(keys)
    assert Counter(r.position for r in out) == Counter(range(2000))
