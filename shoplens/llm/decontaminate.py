"""Benchmark decontamination with spaced seeds.

Texts become lower-case word tokens (letters, digits, underscore), each one
a 64-bit hash.  A seed is the hash of the tokens that a fixed mask selects
around a place; positions under a zero are ignored, so a replaced word there
does not spoil the seed.  ``MASKS`` catch every placement of up to
two replaced words in a window of ``WINDOW`` tokens.  An item that is shorter
is compared as a whole; where ``MASKS`` miss a placement that the comparison
accepts, ``SHORT_MASKS`` add seeds for items of that length, down to single
words (all tested).  Documents get them only if the benchmark has such items.

Training and test seeds are joined by hash.  A hit names a diagonal: the
document place minus the item place.  Along it, tokens are compared one by
one; the pair is reported if a window of ``WINDOW`` consecutive tokens (or
the whole item, if shorter) agrees in at least four fifths of its places.

Only tokens around possible hits are stored: a fixed-size bitmap of all test
seeds thins out the training seeds before the join.  The join itself,
the diagonals and the comparison are ordinary shuffles; only a test side of
few tokens is broadcast, whose tables then have some hundred thousand rows.

Defined results: null, empty and wordless texts match nothing; an item of
fewer than five tokens matches wherever it stands word for word; items of
equal tokens are one item with the smallest of their ids (a null id last); rows that
share doc_id and text are one document; a null doc_id is reported as null; an empty table on
either side gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import bitmap
from shoplens.llm.common import dealt, document_name, materialize, slices

# Five selected tokens each, fewer in items of up to five.
MASKS = ("11111", "110111", "111011", "1011011", "1101101")
SHORT_MASKS = {1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",),
               5: ("1111", "10111", "11011", "11101"), 6: ("101111", "111101"),
               10: ("11000111",), 11: ("101111",)}
EVERY_MASK = tuple(dict.fromkeys(MASKS + sum(SHORT_MASKS.values(), ())))
WINDOW = 13
LEAST_TOKENS = 1
SMALL_TOKENS = 50_000       # of all items: up to here the test side is broadcast
BATCH_CHARS = 1 << 20
MEMO_WORDS = 100_000

_WORD = re.compile(r"\w+")
_OFFSETS = tuple(tuple(i for i, c in enumerate(m) if c == "1") for m in EVERY_MASK)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                     0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype="uint64")
SPAN = max(map(len, EVERY_MASK))


class _WordHashes(dict):
    """Word -> 64-bit hash, forgetting all when full."""

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) > MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_HASHES = _WordHashes()


def token_hashes(text: str | None) -> np.ndarray:
    words = _WORD.findall((text or "").lower())
    return np.fromiter(map(_HASHES.__getitem__, words), dtype="uint64", count=len(words))


def seeds(tokens: np.ndarray, mask: int) -> np.ndarray:
    """The seed hash of one mask at each place where it fits."""
    n = len(tokens) - len(EVERY_MASK[mask]) + 1
    if n <= 0:
        return np.zeros(0, dtype="uint64")
    total = np.full(n, mask + 1, dtype="uint64")
    for offset, factor in zip(_OFFSETS[mask], _FACTORS):
        total += tokens[offset:offset + n] * factor
    total ^= total >> np.uint64(31)
    total *= _FACTORS[0]
    return total ^ total >> np.uint64(29)


def masks_for(sizes: list[int]) -> list[int]:
    """The masks (places in ``EVERY_MASK``) that find items of these sizes."""
    names = {m for n in sizes for m in SHORT_MASKS.get(n, ())}
    if any(n >= len(MASKS[0]) for n in sizes):
        names |= set(MASKS)
    return [k for k, m in enumerate(EVERY_MASK) if m in names]


# -- test side ------------------------------------------------------------

def _tokens(benchmark: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [token_hashes(t).view("int64") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").cast(pa.int64()), pa.array(rows, pa.list_(pa.int64()))],
                ["item_id", "tokens"])
    return (benchmark.select("item_id", "text").mapInArrow(run, "item_id long, tokens array<long>")
            .where(F.size("tokens") >= LEAST_TOKENS))


def item_tokens(benchmark: DataFrame) -> DataFrame:
    """(item_id, copies, tokens), one row per distinct sequence of tokens: the
    smallest id that has it stands for all of them."""
    return _tokens(benchmark).groupBy("tokens").agg(
        F.min("item_id").alias("item_id"), F.count("*").alias("copies"))


def item_groups(benchmark: DataFrame) -> DataFrame:
    """(item_id, represented_by) of every benchmark item with a word."""
    own = _tokens(benchmark)
    return own.join(item_tokens(benchmark).select("tokens", F.col("item_id").alias("represented_by")),
                    "tokens").select("item_id", "represented_by")


def item_seeds(items: DataFrame) -> DataFrame:
    """(hash, item, at) of every seed of ``items(item, tokens)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, tokens in zip(batch.column("item").to_pylist(),
                                    batch.column("tokens").to_pylist()):
                own = np.array(tokens, dtype="int64").view("uint64")
                for mask in masks_for([len(own)]):
                    h = seeds(own, mask).view("int64")
                    if len(h):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h), pa.array(np.full(len(h), item)),
                             pa.array(np.arange(len(h), dtype="int32"))],
                            ["hash", "item", "at"])
    return items.select("item", "tokens").mapInArrow(run, "hash long, item long, at int")


# -- training side --------------------------------------------------------

SEGMENTS = ("doc_id long, text_hash long, start int, tokens array<long>, "
            "hits array<struct<hash:long,at:int>>")


def _segments(lengths: np.ndarray, tokens: np.ndarray, masks: list[int],
              maybe) -> Iterator[tuple]:
    """(document, start, tokens, hashes, places) around possible hits."""
    ends = np.cumsum(lengths)
    document = np.repeat(np.arange(len(lengths)), lengths)
    found_at, found_hash = [], []
    for mask in masks:
        h = seeds(tokens, mask)
        if not len(h):
            continue
        inside = document[:len(h)] == document[len(tokens) - len(h):]
        at = np.flatnonzero(maybe(h) & inside)
        found_at.append(at)
        found_hash.append(h[at])
    if not found_at or not sum(map(len, found_at)):
        return
    at, h = np.concatenate(found_at), np.concatenate(found_hash)
    order = np.argsort(at, kind="stable")
    at, h = at[order], h[order]
    new = np.flatnonzero((np.diff(at, prepend=at[0]) > 2 * WINDOW)
                         | (np.diff(document[at], prepend=document[at[0]]) != 0))
    for a, b in zip([0, *new], [*new, len(at)]):
        if a == b:
            continue
        doc = document[at[a]]
        begin = ends[doc] - lengths[doc]
        low = max(begin, at[a] - WINDOW)
        high = min(ends[doc], at[b - 1] + SPAN + WINDOW)
        yield doc, low - begin, tokens[low:high], h[a:b], at[a:b] - begin


def segments(docs: DataFrame, seen: np.ndarray, masks: list[int]) -> DataFrame:
    """Stretches of ``docs(doc_id, text_hash, text)`` with possible hits of
    the given masks."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)     # of fixed size

    def batched(texts: list[str | None]) -> Iterator[tuple[int, list]]:
        begin, size = 0, 0
        for k, t in enumerate(texts):
            size += len(t or "")
            if size > BATCH_CHARS:
                yield begin, texts[begin:k + 1]
                begin, size = k + 1, 0
        if begin < len(texts):
            yield begin, texts[begin:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())]))
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            hashes = batch.column("text_hash").to_pylist()
            for begin, texts in batched(batch.column("text").to_pylist()):
                own = [token_hashes(t) for t in texts]
                lengths = np.array([len(x) for x in own], dtype="int64")
                rows = list(_segments(lengths, np.concatenate(own), masks,
                                      lambda h: bitmap.contains(shared.value, h)))
                if rows:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[begin + r[0]] for r in rows], pa.int64()),
                        pa.array([hashes[begin + r[0]] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array([r[2].view("int64") for r in rows], pa.list_(pa.int64())),
                        pa.array([[{"hash": x, "at": y} for x, y in
                                   zip(r[3].view("int64").tolist(), r[4].tolist())]
                                  for r in rows], kind),
                    ], ["doc_id", "text_hash", "start", "tokens", "hits"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, SEGMENTS)


# -- verification ---------------------------------------------------------

def best_window(segment: np.ndarray, start: int, item: np.ndarray,
                diagonal: int) -> tuple[int, int, int]:
    """(equal tokens, window, document place) of the best window on a diagonal."""
    low = max(0, start - diagonal)
    high = min(len(item), start + len(segment) - diagonal)
    window = min(WINDOW, len(item))
    if high - low < window:
        return 0, window, 0
    same = segment[low + diagonal - start:high + diagonal - start] == item[low:high]
    run = np.concatenate(([0], np.cumsum(same)))
    sums = run[window:] - run[:-window]
    k = int(np.argmax(sums))
    return int(sums[k]), window, low + k + diagonal


def _arrays(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The rows of a list column as views of its values."""
    values, ends = column.values.to_numpy(), column.offsets.to_pylist()
    return (values[a:b] for a, b in zip(ends, ends[1:]))


def _verify(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [best_window(t, s, i, d) for s, t, i, d in zip(
                batch.column("start").to_pylist(), _arrays(batch.column("tokens")),
                _arrays(batch.column("item_tokens")), batch.column("diagonal").to_pylist())]
            same, window, place = (np.array(x, dtype="int32") for x in
                                   (zip(*best) if best else ((), (), ())))
            kept = pa.array(5 * same >= 4 * window)
            kept_columns = [batch.column(c) for c in ("doc_id", "text_hash", "item_id")]
            out = pa.RecordBatch.from_arrays(
                [*kept_columns, pa.array(same), pa.array(window), pa.array(place)],
                ["doc_id", "text_hash", "item_id", "matched", "window", "place"])
            yield out.filter(kept)
    return pairs.mapInArrow(run, "doc_id long, text_hash long, item_id long, "
                                 "matched int, window int, place int")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, copies, matched, window, place): the
    verified overlaps of ``docs(doc_id, text)`` with ``benchmark(item_id,
    text)``.  Items of equal tokens are found once, as the smallest of their
    ids; ``item_groups`` has the members."""
    items = materialize(item_tokens(benchmark)
                        .withColumn("item", F.monotonically_increasing_id()), "items")
    test = materialize(item_seeds(items), "test_seeds")
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"),
                        "text")
    sizes = (items.groupBy(F.least(F.size("tokens"), F.lit(WINDOW)).alias("n"))
             .agg(F.sum(F.size("tokens")).alias("total")).toArrow().to_pydict())  # at most WINDOW rows
    side = F.broadcast if sum(sizes["total"]) <= SMALL_TOKENS else dealt
    stretch = materialize(segments(keyed, bitmap.build(test, "hash"), masks_for(sizes["n"]))
                          .withColumn("segment", F.monotonically_increasing_id()), "segments")
    train = stretch.select("segment", F.explode("hits").alias("hit")).select(
        "segment", F.col("hit.hash").alias("hash"), F.col("hit.at").alias("doc_at"))
    hits = materialize(train.join(side(test), "hash").select(
        "segment", "item", (F.col("doc_at") - F.col("at")).alias("diagonal")).distinct(), "hits")
    # A hit takes along only the part of its segment that its item can cover.
    reach = items.select("item", F.size("tokens").alias("n"))
    low = F.greatest("start", "diagonal")
    high = F.least(F.col("start") + F.size("tokens"), F.col("diagonal") + F.col("n"))
    parts = hits.join(side(reach), "item").join(dealt(stretch.drop("hits")), "segment").select(
        "doc_id", "text_hash", "item", "diagonal", low.alias("start"),
        F.slice("tokens", low - F.col("start") + 1, high - low).alias("tokens"))
    sides = parts.join(
        side(items.select("item", "item_id", F.col("tokens").alias("item_tokens"))), "item")
    found = _verify(sides.select("doc_id", "text_hash", "item_id", "start", "tokens",
                                 "item_tokens", "diagonal"))
    best = F.max(F.struct("matched", (-F.col("place")).alias("back"), "window"))
    links = found.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("best"))
    copies = items.select(F.col("item_id").alias("_own"), "copies")
    return links.join(side(copies), F.col("item_id").eqNullSafe(F.col("_own"))).select(
        "doc_id", "text_hash", "item_id", "copies", F.col("best.matched").alias("matched"),
        F.col("best.window").alias("window"), (-F.col("best.back")).alias("place"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item."""
    bad = materialize(
        overlaps(docs, benchmark).select("doc_id", "text_hash").distinct().select(
            F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text"),
            document_name(F.col("doc_id"), F.col("text_hash")).alias("_name")), "contaminated")
    name = document_name(docs["doc_id"], F.xxhash64(docs["text"]))
    some, rest = bitmap.split(docs, name, bad, "_name")
    return some.join(dealt(bad), some["doc_id"].cast("long").eqNullSafe(bad["_id"])
                     & F.xxhash64(some["text"]).eqNullSafe(bad["_text"]), "left_anti").unionByName(rest)
