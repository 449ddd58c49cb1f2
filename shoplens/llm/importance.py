"""Importance resampling towards a target distribution.

A text's features are all runs of one to three consecutive words, joined by
one space; a feature's bucket is its CRC-32 modulo ``BUCKETS``.  The gain of a
bucket is the log ratio of its share in the target's features and in the
corpus's, in thousandths; a document's weight is the sum over its features,
and the documents with the highest Gumbel-perturbed weights are drawn.

The checksums of all features of a batch are taken at once.  CRC-32 is linear:
up to a constant for the length, the checksum of a span is the XOR of one word
per byte, which depends on the byte and on its distance from the span's end.
A position table holds these words; the bytes are looked up and folded by
``bitwise_xor.reduceat``.  A word stands in features that end with it, one
word later and two words later: its bytes are folded once for each of these
ends, and a feature is the XOR of its words' folds.  Features beyond ``BLOCK``
bytes are folded block by block: neighbouring blocks are joined in rounds, and
each round needs the table that moves a checksum over twice as many zero bytes
as the one before.

Both passes over the texts are map-side: the first leaves at most ``BUCKETS``
counts a task, the second one row a document.  On the driver are only the
``BUCKETS`` gains.  The draw is a global order of (score, doc_id), numbered
by ranges, so no task sorts all documents.

Defined results: a null or empty text has no features and weight 0; a null
doc_id is hashed as an empty string and orders before all others; rows with
equal score and doc_id are ranked by weight and features, equal rows in any
order (each has its own rank); texts are whole, long ones are cut between
words with the last two words carried on; other columns are not read,
whatever their names; an empty corpus has no rows, an empty target gives
gains by the add-one rule.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import materialize
from shoplens.llm.ordering import numbered

BUCKETS = 10_000
RUN = 3                     # words in the longest feature
MIN_WORDS = 20              # shorter documents are not drawn
PERCENT = 5
SEED = "42"

BLOCK = 256                 # bytes that the position table covers
_CHUNK = 1 << 17            # bytes looked up at once
_SLICE = 1 << 18            # bytes of text taken at once
_POLYNOMIAL = 0xEDB88320

_BYTES = np.arange(256, dtype="uint8")
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype("uint8")
_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype="uint32")
    for _ in range(8):
        c = np.where(c & 1, c >> np.uint32(1) ^ np.uint32(_POLYNOMIAL), c >> np.uint32(1))
    return c.astype("uint32")


def _position_table() -> np.ndarray:
    """[distance from the end][byte]: the byte's part of the checksum."""
    first = _byte_table()
    rows = [first]
    for _ in range(BLOCK - 1):
        rows.append(rows[-1] >> np.uint32(8) ^ first[rows[-1] & np.uint32(255)])
    return np.concatenate(rows)


_PLACES = _position_table()
_LENGTHS = np.array([zlib.crc32(bytes(n)) for n in range(BLOCK + 1)], dtype="uint32")


def _moved(values: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Checksums moved over the zero bytes that ``tables[4][256]`` stand for."""
    out = tables[0][values & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ tables[k][values >> np.uint32(8 * k) & np.uint32(255)]
    return out


def _block_step() -> np.ndarray:
    """Tables that move a checksum over ``BLOCK`` zero bytes."""
    first = _byte_table()
    out = np.stack([np.arange(256, dtype="uint32") << np.uint32(8 * k) for k in range(4)])
    for _ in range(BLOCK):
        out = out >> np.uint32(8) ^ first[out & np.uint32(255)]
    return out


_BLOCK_STEP = _block_step()


def _linear(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The linear part of the checksums of spans of 1 to ``BLOCK`` bytes."""
    out = np.empty(len(start), dtype="uint32")
    total = np.cumsum(length)
    a = 0
    while a < len(start):
        done = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, done + _CHUNK, "right")))
        ends = total[a:b] - done
        firsts = ends - length[a:b]
        at = np.arange(ends[-1])
        byte = data[at + np.repeat(start[a:b] - firsts, length[a:b])]
        place = np.repeat(ends - 1, length[a:b]) - at
        out[a:b] = np.bitwise_xor.reduceat(_PLACES[(place << 8) + byte], firsts)
        a = b
    return out


def _zeros(n: int) -> int:
    """CRC-32 of ``n`` zero bytes."""
    crc, block = 0, bytes(1 << 16)
    while n:
        take = min(n, len(block))
        crc, n = zlib.crc32(block[:take], crc), n - take
    return crc


def _long(data: np.ndarray, start: int, length: int) -> int:
    """The linear part of one span of more than ``BLOCK`` bytes."""
    ends = np.arange(start + length, start, -BLOCK)[::-1]
    firsts = np.maximum(ends - BLOCK, start)
    parts, step = _linear(data, firsts, ends - firsts), _BLOCK_STEP
    while len(parts) > 1:
        if len(parts) % 2:              # nothing before the first block
            parts = np.concatenate((np.zeros(1, "uint32"), parts))
        parts = _moved(parts[0::2], step) ^ parts[1::2]
        step = _moved(step, step)
    return int(parts[0])


def crc32_of_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans (of a byte at least) of an array of bytes."""
    out = np.empty(len(start), dtype="uint32")
    short = np.flatnonzero(length <= BLOCK)
    out[short] = _linear(data, start[short], length[short]) ^ _LENGTHS[length[short]]
    for k in np.flatnonzero(length > BLOCK).tolist():
        out[k] = _long(data, int(start[k]), int(length[k])) ^ _zeros(int(length[k]))
    return out


def _folds(joined: np.ndarray, place: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """Per number of words that follow (0 to ``RUN`` - 1): the fold of each
    word with its space, as a part of a feature that ends so much later.  Bytes
    further than ``BLOCK`` from the end get a value of no meaning."""
    after = np.zeros(len(place) + RUN, "int64")
    after[:len(place)] = length + 1
    out = [np.zeros(len(place), "uint32") for _ in range(RUN)]
    step = 1 << 14                      # words looked up at once
    for a in range(0, len(place), step):
        b = min(a + step, len(place))
        first = place[a:b]
        low, high = int(first[0]), int(place[b - 1] + length[b - 1] + 1)
        byte = joined[low:high].astype("int32")
        own = length[a:b] + 1
        # Distance from the end of the word; its space lies beyond the end.
        away = np.repeat((first + length[a:b] - 1 - low).astype("int32"), own) - np.arange(
            high - low, dtype="int32")
        word = away >= 0
        shift = np.zeros(b - a, "int64")
        for n in range(RUN):
            if n:
                shift += after[a + n:b + n]
            far = away + np.repeat(shift.astype("int32"), own)
            np.clip(far, 0, BLOCK - 1, out=far)
            parts = _PLACES[(far << 8) + byte]
            if n == 0:
                parts *= word           # the last word's space is not in the feature
            out[n][a:b] = np.bitwise_xor.reduceat(parts, first - low)
    return out


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words of texts that lie one after the other: (bytes of all words with
    one space after each, start and length of each word there, words of each
    text)."""
    data = _LOWER[data]
    inside = _WORD[data]
    firsts, lasts = inside.copy(), inside.copy()
    firsts[1:] &= ~inside[:-1]
    lasts[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    firsts[edge] = inside[edge]
    lasts[edge - 1] = inside[edge - 1]
    start = np.flatnonzero(firsts)
    length = np.flatnonzero(lasts) + 1 - start
    place = np.cumsum(length + 1) - length - 1
    joined = np.full(int((length + 1).sum()), 32, dtype="uint8")
    joined[np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)] = data[inside]
    return joined, place, length, np.diff(np.searchsorted(start, offsets))


def _buckets(data: np.ndarray, offsets: np.ndarray, carried: int = 0
             ) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """(words of each text, per run length (its features of each text,
    buckets)); runs of the first ``carried`` words alone are left out."""
    joined, place, length, n_words = _words(data, offsets)

    def runs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        owner = np.repeat(np.arange(len(n_words)), n_words)
        folds = _folds(joined, place, length)
        total = len(owner)
        for n in range(1, min(RUN, total) + 1):
            ends = total - n + 1
            crc = folds[n - 1][:ends].copy()
            for k in range(1, n):
                crc ^= folds[n - 1 - k][k:k + ends]
            size = place[n - 1:] + length[n - 1:] - place[:ends]
            crc ^= _LENGTHS[np.minimum(size, BLOCK)]
            whole = owner[:ends] == owner[n - 1:]       # all words in one text
            whole[:max(0, carried - n + 1)] = False
            long = np.flatnonzero((size > BLOCK) & whole)
            crc[long] = crc32_of_spans(joined, place[long], size[long])
            yield (np.bincount(owner[:ends][whole], minlength=len(n_words)),
                   (crc[whole] % np.uint32(BUCKETS)).astype("int64"))
    return n_words, runs()


def _pieces(data: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """A long text in parts cut between words: (bytes, words carried over
    from the part before)."""
    gaps = np.flatnonzero(~_WORD[_LOWER[data]])
    a, kept = 0, np.zeros(0, dtype="uint8")
    while a < len(data):
        at = int(np.searchsorted(gaps, a + _SLICE))
        b = int(gaps[at]) + 1 if at < len(gaps) else len(data)
        part = np.concatenate((kept, data[a:b]))
        joined, place, _, n = _words(kept, np.array([0, len(kept)]))
        yield part, int(n[0])
        joined, place, _, n = _words(part, np.array([0, len(part)]))
        kept = joined[place[-min(RUN - 1, len(place)):][0]:] if len(place) else joined
        a = b


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of bounded size; a
    text that is longer makes a run of its own."""
    column = batch.column("text").cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], "int64")[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", "uint8")
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _SLICE, "right")) - 1)
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def _measured(batch: pa.RecordBatch, gains: np.ndarray | None) -> Iterator[tuple[np.ndarray, ...]]:
    """Per run of rows: (words, features, weights of its texts), or without
    gains (counts of all buckets,)."""
    for a, b, data, offsets in _texts(batch):
        long = b == a + 1 and len(data) > _SLICE
        parts = _pieces(data) if long else [(data, 0)]
        words, features, weights = (np.zeros(b - a, "int64") for _ in range(3))
        counts = np.zeros(BUCKETS, "int64")
        for part, carried in parts:
            n_words, runs = _buckets(part, np.array([0, len(part)]) if long else offsets, carried)
            words += n_words - carried
            for per_text, buckets in runs:
                features += per_text
                if gains is None:
                    counts += np.bincount(buckets, minlength=BUCKETS)
                else:
                    summed = np.concatenate(([0], np.cumsum(gains[buckets])))
                    ends = np.cumsum(per_text)
                    weights += summed[ends] - summed[ends - per_text]
        yield (counts,) if gains is None else (words, features, weights)


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, "int64")
        for batch in batches:
            for (part,) in _measured(batch, None):
                counts += part
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype("int32")), pa.array(counts[at])],
                                         ["bucket", "n"])

    return (docs.select("text").mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, gain) of all ``BUCKETS`` buckets."""
    spark = docs.sparkSession
    own = materialize(bucket_counts(docs).withColumnRenamed("n", "s"), "corpus")
    other = materialize(bucket_counts(target).withColumnRenamed("n", "t"), "target")

    def total(df: DataFrame, column: str) -> Column:
        return df.agg(F.coalesce(F.sum(column), F.lit(0)).cast("double").alias("n")).scalar()

    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in "st")
    ratio = (t + 1) * (total(own, "s") + BUCKETS) / ((s + 1) * (total(other, "t") + BUCKETS))
    return (spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
            .join(own, "bucket", "left").join(other, "bucket", "left")
            .select("bucket", F.floor(F.log(ratio) * 1000).alias("gain")))


def weights(docs: DataFrame, gains: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_features, weight) of every document."""
    table = np.zeros(BUCKETS, "int64")
    for row in gains.collect():                 # BUCKETS rows
        table[row["bucket"]] = row["gain"]
    shared = docs.sparkSession.sparkContext.broadcast(table)
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(zip(*_measured(batch, shared.value)))
            columns = [pa.array(np.concatenate(p)) for p in parts] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns],
                                             ["key", "n_words", "n_features", "weight"])

    return (docs.select(F.col(key).alias("key"), "text")
            .mapInArrow(run, f"key {key_type}, n_words long, n_features long, weight long")
            .withColumnRenamed("key", key))


def perturbed(weight: Column, key: Column, seed: str = SEED) -> Column:
    """The weight plus Gumbel noise, in thousandths, drawn from the key."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT,
             min_words: int = MIN_WORDS, key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_features, weight, score, rank): every document; the
    drawn ones have a rank (1 is the highest score)."""
    found = weights(docs, bucket_gains(docs, target), key)
    rows = materialize(found.withColumn("score", perturbed(F.col("weight"), F.col(key))), "weights")
    long_enough = F.col("n_words") >= min_words
    placed = numbered(rows.where(long_enough).withColumn("__below", -F.col("score")),
                      ["__below", key, "weight", "n_features"], position="__place", size="__all")
    drawn = F.col("__place") < F.floor(F.col("__all") * percent / 100)
    return (placed.withColumn("rank", F.when(drawn, F.col("__place") + 1))
            .drop("__below", "__place", "__all")
            .unionByName(rows.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))))
