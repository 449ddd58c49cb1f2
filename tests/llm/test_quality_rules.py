import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shoplens.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    often = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(w)
    failed = n < 50 or 100 * len(covered) > 50 * n
    stop = {x for line in Q.STOP_WORDS.values() for x in line.split()}
    ratios = {
        "mean_word_length": sum(map(len, w)) / max(n, 1),
        "symbol_ratio": len(re.findall(r"[#*$%&|<>]", text)) / max(n, 1),
        "shout_ratio": text.count("!") / max(n, 1),
        "capital_ratio": sum(x.upper() == x and x.lower() != x for x in w) / max(n, 1),
        "stop_word_ratio": sum(x.strip(".,;:!?\"'()").lower() in stop for x in w) / max(n, 1),
        "dup_line_ratio": (len(lines) - len(set(lines))) / max(len(lines), 1),
        "repeat_ratio": len(covered) / max(n, 1)}
    kept = not failed and all((low is None or ratios[m] >= low) and (high is None or ratios[m] <= high)
                              for m, low, high in Q.RULES)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed, kept)


def test_rules(spark, docs, rows, no_docs):
    rng = random.Random(9)
    texts = [r[1] for r in rows]
    texts += [" ".join(rng.choice("abc") for _ in range(n)) for n in (3, 4, 5, 9, 40, 300)]
    texts += ["a b c", "a b c d", "a a a a", "\n".join(["same line here"] * 30),
              "THE END OF ALL! " * 40, "# " * 80, "x y z\x1cq\x0bw"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clash = df.withColumn("n_words", F.lit(-1)).withColumn("kept", F.lit(None).cast("string"))
    got = {r.doc_id: tuple(r.quality) for r in Q.apply_rules(clash).collect()}
    for k, t in enumerate(texts):
        assert got[k] == brute(t), (k, t and t[:80])
    assert Q.apply_rules(no_docs).count() == 0
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(brute(r[1])[-1] for r in rows)


def test_one_projection_without_user_functions(docs):
    plan = Q.apply_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("text", ["word " * 3000, "a b c d e " * 2000])
def test_long_repetitive_text(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    assert tuple(Q.apply_rules(df).first().quality) == brute(text)
