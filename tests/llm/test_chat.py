import hashlib
import random

import pyarrow as pa
from pyspark.sql import functions as F

from shoplens.llm import chat

PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\\\", " ", "[TEXT]", " [TEXT] ", "[ROLE]", "é", "x",
         "\n", "", "[ANS]", " </s>", "\U0001f642"]


def turns(seed=2, n=200):
    rng = random.Random(seed)
    return [(c if c else None, k, rng.choice(["user", "assistant", "system", "tool", " [TEXT] ", None, "<s>", "\\"]),
             rng.choice([None, "".join(rng.choice(PARTS) for _ in range(rng.randrange(9)))]))
            for c in range(n) for k in range(rng.randrange(1, 7))]


def digest(rows):
    rows = sorted(rows, key=lambda r: r[1])
    both = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows).encode()).hexdigest()
    loss = "".join(r[3] or "" for r in rows if r[2] == "assistant")
    return len(rows), both, len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_read_back(spark):
    rows = turns()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r)[1:5] for r in
           chat.read_back(chat.format_conversations(df.withColumn("part", F.lit(9)))).collect()}
    for c in {r[0] for r in rows}:
        assert got[c] == digest([r for r in rows if r[0] == c])
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_repeated_turns_and_long_texts(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", "long " * 200000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat.read_back(chat.format_conversations(df)).first()
    assert tuple(r)[1:5] == digest(rows)


def test_batches_and_parts_do_not_matter(monkeypatch):
    monkeypatch.setattr(chat, "PART_BYTES", 120)
    rng = random.Random(4)
    rows = [(c, rng.randrange(4), f"r{rng.randrange(3)}", "t" * rng.randrange(30) + str(k))
            for c in (None, 1, 2, 3, 4, 5) for k in range((1, 2, 3, 40)[(c or 0) % 4])]

    def batches(n):
        for k in range(0, len(rows), n):
            c = list(zip(*rows[k:k + n]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), pa.array(c[2]), pa.array(c[3])],
                ["conv_id", "kind", "role", "text"])
    first = None
    for n in (1, 2, 3, 7, 1000):
        out = pa.Table.from_batches(list(chat._format(batches(n)))).to_pylist()
        whole = {}
        for r in out:
            text, count, loss, parts = whole.setdefault(r["conv_id"], ["", 0, [], []])
            raw = r["formatted"].encode()
            parts.append(r["part"])
            loss += [raw[a:b] for a, b in zip(r["loss_start"], r["loss_end"])]
            whole[r["conv_id"]] = [text + r["formatted"], count + r["turns"], loss, parts]
        assert all(w[3] == list(range(len(w[3]))) for w in whole.values())
        now = {c: w[:3] for c, w in whole.items()}
        first = first or now
        assert now == first
        if n < 1000:
            assert len(out) > len(whole)


def test_escape_is_reversible(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", chat._escape("text").alias("e")).collect():
        assert chat.unescape(r.e) == r.text
        assert not chat.re.search(r"(?<!\\)" + chat.CONTROL, r.e)


def test_a_hot_conversation_is_formatted_by_many_tasks(spark):
    """A third of all turns in one conversation, and one without an id."""
    rng = random.Random(12)
    rows = [(rng.choice([7, 7, None, None, *range(100, 102)]) if k % 3 else 7, k, rng.choice(["user", "assistant"]), f"text {k} " * 20)
            for k in range(8000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    formatted = chat.format_conversations(df).persist()
    per_range = sorted(r.n for r in formatted.groupBy(F.shiftright("part", 32)).agg(F.sum("turns").alias("n")).collect())
    assert len(per_range) == 4 and per_range[-1] <= 2 * per_range[1]
    assert formatted.where("conv_id = 7").select(F.shiftright("part", 32)).distinct().count() >= 2
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
    assert got == {c: digest([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    formatted.unpersist()
