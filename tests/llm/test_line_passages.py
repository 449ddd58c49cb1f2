"""op9 against brute force over maximal shared runs of lines."""

import random
from collections import Counter

import pytest

from shoplens.llm import line_dedup as L


def is_passage(lines):
    words = sum(len(x.split()) for x in lines)
    return words > 50 or len(lines) >= 2 and words >= 10


def brute(docs):
    """{doc_id: text}: every pair of places is extended line by line, and runs
    that stand at an earlier place go.  No blank lines in the texts."""
    order = [(d, t.split("\n")) for d, t in sorted(docs)]
    gone = {d: set() for d, _ in order}
    for y, (d, later) in enumerate(order):
        for x in range(y + 1):
            earlier = order[x][1]
            for j in range(len(later)):
                for i in range(len(earlier) if x < y else j):
                    if i and j and earlier[i - 1] == later[j - 1]:
                        continue                                # not the run's begin
                    n = 0
                    while (i + n < len(earlier) and j + n < len(later)
                           and earlier[i + n] == later[j + n]):
                        n += 1
                    if is_passage(later[j:j + n]):
                        gone[d] |= set(range(j, j + n))
    return {d: "\n".join(x for j, x in enumerate(lines) if j not in gone[d]) for d, lines in order}


def own(rng, words=12):
    return " ".join(f"o{rng.randrange(10 ** 9)}" for _ in range(words))


def dedup(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r.doc_id: r.text for r in L.dedup_lines(df).collect()}


@pytest.mark.parametrize("sizes", [(40, 30), (20, 20, 20), (15,) * 12, (60,)])
def test_passage_goes_whatever_stands_around_it(spark, sizes):
    rng = random.Random(sum(sizes))
    docs, kept = [], {}
    for pair in range(12):
        passage = [own(rng, n) for n in sizes]
        for k in (2 * pair, 2 * pair + 1):
            head, tail = ([own(rng) for _ in range(rng.randrange(1, 4))] for _ in "ab")
            docs.append((k, "\n".join(head + passage + tail)))
            kept[k] = "\n".join(head + tail) if k % 2 else docs[-1][1]
    assert dedup(spark, docs) == kept == brute(docs)


def test_runs_as_brute_force_finds_them(spark):
    rng = random.Random(4)
    stock = [own(rng, n) for n in (1, 1, 2, 3, 4, 5, 7, 9, 10, 11, 30, 49, 50, 51, 80)]
    docs = [(k, "\n".join(rng.choice(stock) if rng.random() < 0.8 else own(rng, rng.randrange(1, 60))
                          for _ in range(rng.randrange(1, 25)))) for k in range(80)]
    source = docs[7][1].split("\n") + docs[11][1].split("\n")
    for k in range(80, 110):
        a = rng.randrange(len(source))
        docs.append((k, "\n".join([own(rng), *source[a:a + rng.randrange(1, 15)], own(rng)])))
    want = brute(docs)
    assert 40 < sum(want[d] != t for d, t in docs) < 110
    got = dedup(spark, docs)
    words, missed = 0, 0
    for d, t in docs:
        gone = Counter(t.split("\n")) - Counter(got[d].split("\n"))
        should = Counter(t.split("\n")) - Counter(want[d].split("\n"))
        assert not gone - should                # nothing goes that has no earlier place
        words += sum(len(x.split()) * n for x, n in should.items())
        missed += sum(len(x.split()) * n for x, n in (should - gone).items())
    assert missed < 0.1 * words


def test_blank_lines_count_for_nothing(spark):
    """Paragraphs between blank lines go as a run, however they are spaced."""
    rng = random.Random(9)
    for words in (5, 20, 45):
        passage = [own(rng, words) for _ in range(12)]
        docs = [(0, "\n".join([own(rng), *passage, own(rng)])),
                (1, own(rng) + "\n\n" + "\n\n".join(passage) + "\n\n" + "end " + own(rng)),
                (2, "\n \n" + own(rng) + "\n" + "\n\t\n\n".join(passage) + "\n\n\nend " + own(rng)),
                (3, "\n\n" + "\n\n".join(passage) + "\n"), (4, "\n \n"), (5, "\n \n")]
        got = dedup(spark, docs)
        assert got[0] == docs[0][1] and got[3] == "" and got[4] == got[5] == "\n \n"
        for k, gap in ((1, "\n\n"), (2, "\n")):
            head, tail = docs[k][1].split(passage[0])[0], docs[k][1][docs[k][1].index("end "):]
            assert head.endswith(gap) and got[k] == head + tail


def test_length_is_judged_over_the_whole_run(spark):
    """Many short lines make one passage; each chunk of them would be too short."""
    notice = [f"n{k} n{k}" for k in range(12)]
    docs = [(k, "\n".join([f"own {k}", *notice, f"end {k}"])) for k in range(4)]
    assert dedup(spark, docs) == {k: t if k == 0 else f"own {k}\nend {k}" for k, t in docs}
