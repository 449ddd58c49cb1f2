import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shoplens.llm import line_dedup as L


def brute(rows):
    """The chunk method one by one: chunks seen before are extended against
    their first place; {(doc_id, text): (text, chunks seen before)}."""
    documents = sorted({(r[0] is not None, r[0] or 0, r[0], r[1]) for r in rows if r[1] is not None},
                       key=lambda d: d[:2])
    seen, out = {}, {}
    for n, (_, _, doc_id, text) in enumerate(documents):
        lines, gone = [x for x in text.encode().split(b"\n") if x.split()], set()
        for k, (a, b, low, high) in enumerate(cuts(lines)):
            body = tuple(lines[a:b + 1])
            if body not in seen:
                seen[body] = (n, a, lines[low:a], lines[b + 1:high])
                continue
            first, line, before, after = seen[body]
            while low < a and before and before[-1] == lines[a - 1]:
                a, before = a - 1, before[:-1]
            while b + 1 < high and after and after[0] == lines[b + 1]:
                b, after = b + 1, after[1:]
            start = next(x for i, (x, *_) in enumerate(cuts(lines)) if i == k)
            gone.add((a, b + 1, first, 0, start - line))
        out[doc_id, text] = (L.without(text, sorted(gone)), len(gone))
    return out


def cuts(lines):
    """(first, last, begin of the context, end of the context) of the chunks
    of a text, by first line and then length."""
    import xxhash
    n = len(lines)
    hashes = np.array([xxhash.xxh64_intdigest(x) for x in lines], "uint64")
    mark = L.boundaries(hashes, np.array([len(x.split()) for x in lines], "int64")).tolist()
    at = sorted({i for i in range(n) if mark[i]} | ({0, n - 1} if n else set()))
    at = sorted({x for i, a in enumerate(at) for x in range(a, (at + [a + 1])[i + 1] if i + 1 < len(at) else a + 1,
                                                            L.MAX_LINES)})
    out = []
    for i, a in enumerate(at):
        low = at[i - 1] + (1 if mark[at[i - 1]] else 0) if i else a
        for j in (i, i + 1):
            if j == i and len(lines[a].split()) <= L.LONG_LINE_WORDS or j == len(at):
                continue
            b = at[j]
            high = at[j + 1] + (0 if mark[at[j + 1]] else 1) if j + 1 < len(at) else b + 1
            out.append((a, b, low, high))
    return out


def vectors(lines):
    return (L._line_hashes(lines), np.array([len(x.split()) for x in lines], "int64"),
            np.array([len(lines)], "int64"))


def test_chunks_resist_shifts():
    """The same lines are cut alike, whatever stands around them."""
    rng = random.Random(1)
    passage = [" ".join(["shared"] * rng.randrange(1, 9) + [str(rng.random())]).encode() for _ in range(40)]
    found = []
    for k in range(6):
        lines = [f"own {k} {j}".encode() for j in range(k * 3 + 1)] + passage + [f"end {k}".encode()]
        cut = L.Cut(*vectors(lines))
        assert cut.first.min() == 0 and cut.last.max() == len(lines) - 1
        found.append({b"\n".join(lines[a:b + 1]) for a, b in zip(cut.first, cut.last)})
    common = set.intersection(*found)
    covered = {x for body in common for x in body.split(b"\n")}
    assert len(covered) >= 36 and all(b"\n" in body for body in common)
    assert len(common) < len(passage)            # chunks, not lines


def test_a_boundary_depends_on_its_line_alone():
    rng = random.Random(3)
    lines = [b" ".join([b"w%d" % rng.randrange(99)] * rng.randrange(1, 5)) for _ in range(400)]
    hashes, words, _ = vectors(lines)
    mark = L.boundaries(hashes, words)
    assert 0.3 < mark.mean() < 0.7
    order = rng.sample(range(400), 400)
    assert (L.boundaries(hashes[order], words[order]) == mark[order]).all()
    full = np.full(400, L.FULL_WORDS)
    assert L.boundaries(hashes, full).all()


def test_cuts_of_several_texts():
    rng = random.Random(5)
    texts = [[b" ".join([b"w%d" % rng.randrange(9)] * rng.choice([1, 2, 3, 60])) for _ in range(rng.randrange(30))]
             for _ in range(60)] + [[b"same"] * 100, [], [b"x" * 9], [b"b " * 51], []]
    lines = [x for t in texts for x in t]
    cut = L.Cut(L._line_hashes(lines), np.array([len(x.split()) for x in lines], "int64"),
                np.array([len(t) for t in texts], "int64"))
    low = cut.low[cut.owner]
    got = sorted(zip(cut.owner.tolist(), *((x - low).tolist() for x in (cut.first, cut.last, cut.before, cut.after))))
    assert got == sorted((k, *c) for k, t in enumerate(texts) for c in cuts(t))
    assert (cut.last - cut.first <= L.MAX_LINES).all()


def test_long_line_is_a_chunk():
    long = " ".join(["word"] * 51).encode()
    cut = L.Cut(*vectors([b"a", long, b"b"]))
    assert (1, 1) in set(zip(cut.first.tolist(), cut.last.tolist()))
    assert L.chunks([]) == [] and L.chunks([b""]) == [(0, 1)]


def test_round_trip(rows):
    for r in rows:
        assert L.without(r[1], []) == r[1]
        if r[1]:
            units = len(L.chunks(r[1].encode().split(b"\n")))
            whole = len(r[1].split()) > L.LONG_LINE_WORDS or units >= 2 and len(r[1].split()) >= L.MIN_WORDS
            assert L.without(r[1], [(0, units, 1, 2, 3)]) == ("" if whole else r[1])
            parts = [(k, k + 1, 1, 2, 3) for k in range(units)] + [(k, k + 2, 1, 2, 3) for k in range(units - 1)]
            assert L.without(r[1], parts) == ("" if whole else r[1])


def test_dedup(spark, docs, rows, no_docs):
    rng = random.Random(8)
    passage = "\n".join(f"a line of the shared passage number {k} with several words" for k in range(9))
    extra = [(7000 + k, "\n".join([f"intro {rng.random()}"] * 1) + "\n" + passage + f"\nend {k}")
             for k in range(12)]
    every = [(r[0], r[1]) for r in rows] + extra
    df = spark.createDataFrame(every, "doc_id long, text string").withColumn("gone", F.lit("x"))
    got = L.dedup_lines(df.withColumn("removed_chunks", F.lit("old")))
    assert got.columns == ["doc_id", "text", "gone", "removed_chunks"]
    want = brute(every)
    result = Counter((r.doc_id, r.text, r.removed_chunks) for r in got.collect())
    assert result == Counter((d, *(want[d, t] if t is not None else (None, 0))) for d, t in every)
    assert sum(n for (_, _, gone), n in result.items() if gone) >= 11
    assert L.dedup_lines(no_docs).count() == 0


def test_equal_hashes_are_not_enough(spark, monkeypatch):
    """Chunks are compared by bytes: a hash that always collides removes nothing."""
    texts = [(k, f"first line of document {k} has words\nsecond line of document {k} has words")
             for k in range(5)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = spark.createDataFrame(
        [(1, k, 0, 0, 1, t.encode(), b"", b"") for k, t in texts],
        "hash long, doc_id long, text_hash long, line int, last int, body binary, before binary, after binary")
    monkeypatch.setattr(L, "_chunk_rows", lambda docs, repeated: found)
    assert L.repeated_chunks(df).count() == 0


def test_the_count_may_have_another_name(spark, docs):
    df = docs.withColumn("removed_chunks", F.lit("mine"))
    out = L.dedup_lines(df, "n")
    assert out.columns == [*df.columns, "n"]
    assert {r.removed_chunks for r in out.select("removed_chunks").collect()} == {"mine"}
