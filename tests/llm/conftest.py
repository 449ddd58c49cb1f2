"""A small corpus with the awkward rows every operator must take."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    words = []
    for k in range(n):
        w = f"w{rng.randrange(vocabulary)}" if rng.random() < 0.6 else rng.choice(
            ["the", "of", "and", "de", "la", "die", "und", "que", "to", "in"])
        words.append(w + ("." if rng.random() < 0.08 else ""))
        if rng.random() < 0.06:
            words.append("\n")
    return " ".join(words).replace(" \n ", "\n").strip()


def row(doc_id, text, lang="en", source="s"):
    return doc_id, text, lang, source, None if text is None else len(text)


def corpus(seed=5, n=60):
    rng = random.Random(seed)
    rows = [row(k, prose(rng, rng.randrange(5, 200)), rng.choice(["en", "fr", None]),
                rng.choice(["hot"] * 5 + [f"s{j}" for j in range(9)])) for k in range(n)]
    base = prose(rng, 120)
    rows += [row(1000 + k, base) for k in range(8)]                          # exact copies
    rows += [row(1100 + k, base + f"\nextra line number {k} of a copy") for k in range(4)]
    rows += [row(2000, None), row(2001, ""), row(2002, " \n\t "), row(2003, "one"),
             row(2004, "two words"), row(None, prose(rng, 60)), row(None, None),
             row(2005, prose(rng, 3000)),                                     # very long
             row(2006, "x" * 50000), row(2007, "<|endoftext|> a <|endoftext|>"),
             row(2008, "Ünï cödé    double  space\r\n\r\n\ttabs\x0b end \U0001f642")]
    rows += [row(3000, prose(random.Random(1), 80))] * 3                      # repeated rows
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
