"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is labelled good or bad.  A line's score is linear
in features of the line itself and of the lines before and after it; a
transition matrix links neighbouring labels.  Forward-backward gives each
line's marginal probability of being good, and a document's quality is the
mean of these marginals weighted by line length.

The field is trained on labelled documents, every line with its document's
label, by maximum likelihood with an L2 penalty.  ``fit`` uses at most
``TRAIN_DOCS`` labelled documents, those with the smallest hash of their
id, and of each at most ``TRAIN_LINES`` consecutive lines; scoring always
reads whole texts.  Only numbers computed on the executors are gathered for
the fit.  doc_id, lang, source and the labels are no inputs of a score.

Defined results: a null or empty text is one empty line and gets that line's
score; repeated rows get equal scores; a document labelled more than once
counts with its smallest label; null labels are ignored; without any usable
label every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.quality_rules import STOP_WORDS, SYMBOLS

TRAIN_DOCS = 3000
TRAIN_LINES = 100_000       # of all training documents together
ROUNDS = 250
RATE = 0.1
PENALTY = 1e-3
FOLDS = 5
GOOD_FROM = 0.3
BATCH_BYTES = 16 << 20      # texts and features scored at once
LINE_BYTES = 400

_STOP = frozenset(w for line in STOP_WORDS.values() for w in line.split())
_END = (".", "!", "?", ":", ";", '"')
OWN = 20                    # features of a line alone


def line_features(lines: list[str]) -> np.ndarray:
    """One row of ``OWN`` features per line of a document."""
    out = np.zeros((len(lines), OWN), dtype="float32")
    seen: set[str] = set()
    for k, line in enumerate(lines):
        words = line.split()
        n = len(words)
        row = out[k]
        row[0] = n == 0
        row[1] = n
        row[2] = len(line)
        if not n:
            continue
        row[3] = sum(map(line.count, SYMBOLS))
        row[4] = line.count("!")
        row[5] = line.count("|")
        row[6] = sum(map(str.isupper, words))
        row[7] = sum(map(_STOP.__contains__, line.lower().split()))
        row[8] = n - len(set(words))
        row[9] = line in seen
        row[10] = line.endswith(_END)
        row[11] = sum(map(str.isdigit, words))
        row[12] = line.count("http") + line.count("@")
        seen.add(line)
    n = np.maximum(out[:, 1], 1.0)
    out[:, 13] = np.minimum(out[:, 2] / n, 20) / 10      # characters a word
    out[:, 3:9] = np.minimum(out[:, 3:9] / n[:, None], 1.0)
    out[:, 11:13] = np.minimum(out[:, 11:13] / n[:, None], 1.0)
    out[:, 14:18] = out[:, [3, 4, 6, 8]] > 0.2
    out[:, 1] = np.log1p(out[:, 1]) / 4
    out[:, 18] = out[:, 1] < 0.35                        # up to three words
    out[:, 2] = np.log1p(out[:, 2]) / 8
    out[:, 19] = np.log1p(len(lines)) / 6
    return out


def features(lines: list[str]) -> np.ndarray:
    """Own features, then those of the line before and after, then edges."""
    own = line_features(lines)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    edges = np.zeros((len(own), 3))
    edges[:, 0] = 1.0
    edges[0, 1] = edges[-1, 2] = 1.0
    return np.hstack([own, before, after, edges])


WIDTH = 3 * OWN + 3


# -- the field ------------------------------------------------------------

@dataclass
class Field:
    """weights: score of the label good; trans[i, j]: from label i to j."""
    weights: np.ndarray
    trans: np.ndarray

    @staticmethod
    def blank() -> Field:
        return Field(np.zeros(WIDTH), np.zeros((2, 2)))


def forward_backward(score: np.ndarray, lengths: np.ndarray, trans: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(alpha, beta, log Z by line, first line flags), all chains at once.

    ``score`` holds the lines of all chains one after another; step t works
    on the t-th line of every chain that has one.
    """
    n = len(score)
    ends = np.cumsum(lengths)
    order = np.argsort(-lengths, kind="stable")
    starts, size = (ends - lengths)[order], lengths[order]
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), side="left")     # chains with > t lines
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    alpha[starts, 1] = score[starts]
    for t in range(1, longest):
        at = starts[:alive[t]] + t
        prev = alpha[at - 1]
        alpha[at, 0] = np.logaddexp(prev[:, 0] + trans[0, 0], prev[:, 1] + trans[1, 0])
        alpha[at, 1] = np.logaddexp(prev[:, 0] + trans[0, 1],
                                    prev[:, 1] + trans[1, 1]) + score[at]
    for t in range(longest - 2, -1, -1):
        at = starts[:alive[t + 1]] + t
        good = beta[at + 1, 1] + score[at + 1]
        bad = beta[at + 1, 0]
        beta[at, 0] = np.logaddexp(trans[0, 0] + bad, trans[0, 1] + good)
        beta[at, 1] = np.logaddexp(trans[1, 0] + bad, trans[1, 1] + good)
    last = np.logaddexp(alpha[ends - 1, 0], alpha[ends - 1, 1])
    first = np.zeros(n, dtype=bool)
    first[ends - lengths] = True
    return alpha, beta, np.repeat(last, lengths), first


def marginals(score: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Probability that each line is good."""
    alpha, beta, log_z, _ = forward_backward(score, lengths, trans)
    return np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - log_z, 0.0))


def train(x: np.ndarray, lengths: np.ndarray, label: np.ndarray) -> Field:
    """Maximum likelihood by Adam steps; ``label`` has one entry per line."""
    theta = np.zeros(WIDTH + 4)
    if not len(label):
        return Field.blank()
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    docs = len(lengths)
    for step in range(1, ROUNDS + 1):
        weights, trans = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        score = x @ weights
        alpha, beta, log_z, first = forward_backward(score, lengths, trans)
        good = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - log_z, 0.0))
        grad = np.zeros_like(theta)
        grad[:WIDTH] = x.T @ (label - good)
        at = np.flatnonzero(~first)
        for i in range(2):
            for j in range(2):
                pair = np.exp(alpha[at - 1, i] + trans[i, j] + j * score[at]
                              + beta[at, j] - log_z[at])
                true = (label[at - 1] == i) & (label[at] == j)
                grad[WIDTH + 2 * i + j] = true.sum() - pair.sum()
        grad = grad / docs - PENALTY * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Field(theta[:WIDTH], theta[WIDTH:].reshape(2, 2))


# -- Spark ----------------------------------------------------------------

def lines_of(text: str | None) -> list[str]:
    return (text or "").split("\n")


def line_scores(field: Field, own: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``features(...) @ weights`` of all documents, without the wide matrix."""
    w = field.weights
    # Summed row by row: equal texts score equally whatever batch they are in.
    here, before, after = ((own * w[k * OWN:(k + 1) * OWN]).sum(axis=1) for k in range(3))
    ends = np.cumsum(lengths)
    first, last = np.zeros(len(own), dtype=bool), np.zeros(len(own), dtype=bool)
    first[ends - lengths] = last[ends - 1] = True
    out = here + w[-3] + w[-2] * first + w[-1] * last
    out[1:] += np.where(first[1:], 0.0, before[:-1])
    out[:-1] += np.where(last[:-1], 0.0, after[1:])
    return out


def quality_scores(field: Field, texts: list[str | None]) -> np.ndarray:
    """Length-weighted mean marginal of each text."""
    cut = [lines_of(t) for t in texts]
    lengths = np.array([len(c) for c in cut], dtype="int64")
    own = np.vstack([line_features(c) for c in cut])
    good = marginals(line_scores(field, own, lengths), lengths, field.trans)
    weight = np.fromiter((len(line) + 1 for c in cut for line in c), "float64", len(good))
    begin = np.cumsum(lengths) - lengths
    return np.add.reduceat(good * weight, begin) / np.add.reduceat(weight, begin)


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text leaves remainder 0: never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def training_documents(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """(doc_id, text_hash, label) of the bounded sample: a local table of at
    most ``TRAIN_DOCS`` rows, each doc_id once."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull()
                           & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min(target).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS))
    text = F.coalesce("text", F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    sizes = (docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"),
                         lines.alias("lines"))
             .join(F.broadcast(chosen.select(F.col("doc_id").cast("long"), "label")), "doc_id")
             .groupBy("doc_id", "label").agg(F.min(F.struct("text_hash", "lines")).alias("one"))
             .orderBy(F.xxhash64("doc_id"), "doc_id"))
    kept, room = [], TRAIN_LINES
    for row in sizes.collect():                         # at most TRAIN_DOCS rows
        if row["one"]["lines"] <= room:
            room -= row["one"]["lines"]
            kept.append((row["doc_id"], row["one"]["text_hash"], row["label"]))
    return docs.sparkSession.createDataFrame(kept, "doc_id long, text_hash long, label int")


def training_rows(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """(doc_id, label, lines, x) of the bounded sample, x row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(lines_of(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.array([len(x) for x in found], pa.int32()),
                 pa.array([x.astype("float32").tobytes() for x in found], pa.binary())],
                ["doc_id", "label", "lines", "x"])

    sample = training_documents(docs, labels, target)
    rows = (docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
            .join(F.broadcast(sample), ["doc_id", "text_hash"])
            .select("doc_id", "label", "text")
            .mapInArrow(run, "doc_id long, label int, lines int, x binary"))
    # Rows of one id and text are equal; any of them stands for all.
    return rows.groupBy("doc_id").agg(*[F.first(c).alias(c) for c in ("label", "lines", "x")])


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality") -> Field:
    """Train on the bounded sample (TRAIN_DOCS documents, TRAIN_LINES lines)."""
    rows = training_rows(docs, labels, target).toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return Field.blank()
    lengths = rows.column("lines").to_numpy().astype("int64")
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), "float32")
    label = np.repeat(rows.column("label").to_numpy() > 0, lengths).astype("float64")
    return train(x.reshape(-1, WIDTH).astype("float64"), lengths, label)


def score(text: Column, field: Field) -> Column:
    """Column of quality scores of whole texts."""
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            texts, out, begin, size = s.tolist(), [], 0, 0
            for k, t in enumerate(texts):
                size += len(t or "") + LINE_BYTES * ((t or "").count("\n") + 1)
                if size > BATCH_BYTES or k + 1 == len(texts):
                    out.append(quality_scores(field, texts[begin:k + 1]))
                    begin, size = k + 1, 0
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))
    return F.pandas_udf(run, "double")(text)


def classify(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    field = fit(docs, labels, target)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       score(F.col("text"), field).alias("score")).withColumn(
        "predicted", (F.col("score") >= GOOD_FROM).cast("int"))
