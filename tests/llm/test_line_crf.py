import os
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import line_crf as C


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(1)
    lengths = np.array([4, 1, 6, 2])
    score, trans = rng.normal(size=13), rng.normal(size=(2, 2))
    alpha, beta, log_z, first = C.forward_backward(score, lengths, trans)
    got = np.exp(alpha[:, 1] + beta[:, 1] - log_z)
    at = 0
    for n in lengths:
        total, good = 0.0, np.zeros(n)
        for y in product((0, 1), repeat=int(n)):
            p = np.exp(sum(score[at + k] * y[k] for k in range(n))
                       + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += p
            good += p * np.array(y)
        np.testing.assert_allclose(got[at:at + n], good / total)
        np.testing.assert_allclose(log_z[at], np.log(total))
        assert first[at]
        at += n


def test_scores_without_the_wide_matrix():
    rng = np.random.default_rng(2)
    field = C.Field(rng.normal(size=C.WIDTH), rng.normal(size=(2, 2)))
    texts = ["one\ntwo words\nTHREE!! of them", "", "x", "a\n\nb\n" * 5]
    cut = [C.lines_of(t) for t in texts]
    wide = np.vstack([C.features(c) for c in cut]) @ field.weights
    own = np.vstack([C.line_features(c) for c in cut])
    np.testing.assert_allclose(C.line_scores(field, own, np.array([len(c) for c in cut])), wide, atol=1e-4)


def test_training_learns_and_batches_agree():
    good = ["the cat of the house is in the garden.\nit was a good day for the cat."] * 40
    bad = ["%%% ### $$$\nBUY!! NOW!! ***"] * 40
    cut = [C.lines_of(t) for t in good + bad]
    lengths = np.array([len(c) for c in cut])
    label = np.repeat([1.0] * 40 + [0.0] * 40, lengths)
    field = C.train(np.vstack([C.features(c) for c in cut]), lengths, label)
    s = C.quality_scores(field, good + bad)
    assert s[:40].min() > 0.9 and s[40:].max() < 0.1
    alone = np.concatenate([C.quality_scores(field, [t]) for t in good[:2] + bad[:2]])
    np.testing.assert_allclose(alone, s[[0, 1, 40, 41]], atol=1e-6)


def test_awkward_rows(spark, docs, rows, no_docs):
    labels = spark.createDataFrame(
        [(k, k % 2, 0) for k in range(50)] + [(3, None, 0), (None, 1, 0), (4, 1, 0), (4, 0, 0)],
        "doc_id long, quality int, toxic int")
    out = C.classify(docs.withColumn("label", F.lit("x")).withColumn("x", F.lit(1)), labels)
    got = out.collect()
    assert len(got) == len(rows)
    assert all(0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    by_text = {}
    for r, src in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)),
                      sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        if src[0] is not None and src[0] >= 1000:
            by_text.setdefault(src[1] or "", set()).add(round(r.score, 9))
    assert all(len(v) == 1 for v in by_text.values())
    assert C.classify(no_docs, labels).count() == 0
    assert {round(r.score, 9) for r in C.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_held_out_labels_never_train(spark, docs):
    labels = spark.createDataFrame([(k, 1, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    used = {r.doc_id for r in C.training_rows(docs, labels).collect()}
    assert used and all(zlib.crc32(str(k).encode()) % 5 for k in used)


def test_a_hot_id_trains_once(spark):
    """20,000 rows of one labelled id are one training document."""
    hot = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("hot text\nof two lines").alias("text"))
    mixed = spark.range(500).select(F.lit(2).cast("long").alias("doc_id"), F.concat(F.lit("v"), "id").alias("text"))
    rest = spark.range(3, 5003).select(F.col("id").alias("doc_id"), F.lit("a line").alias("text"))
    labels = spark.range(1, 5003).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    rows = C.training_rows(hot.unionAll(mixed).unionAll(rest), labels).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) <= C.TRAIN_DOCS and len(ids) > 2900
    assert all(len(r.x) == 4 * C.WIDTH * r.lines for r in rows)


def test_documents_train_whole_or_not(spark, monkeypatch):
    monkeypatch.setattr(C, "TRAIN_LINES", 300)
    docs = spark.createDataFrame([(k, "\n".join(["x y"] * n)) for k, n in enumerate([5, 1000, 40, 200, 90, 301, 8, 0, 60] * 3)],
                                 "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    sizes = {r.doc_id: (r.text or "").count("\n") + 1 for r in docs.collect()}
    rows = C.training_rows(docs, labels).collect()
    assert rows and sum(r.lines for r in rows) <= 300 and all(r.lines == sizes[r.doc_id] for r in rows)
    left = 300 - sum(r.lines for r in rows)
    skipped = [n for k, n in sizes.items() if k not in {r.doc_id for r in rows} and zlib.crc32(str(k).encode()) % 5]
    assert all(n > left for n in skipped)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="no test data")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = C.classify(docs, labels).where("held_out").join(labels, "doc_id")
    r = out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("accuracy")).first()
    assert r.accuracy >= 0.95
