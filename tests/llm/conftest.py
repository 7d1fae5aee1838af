import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, token string"
WORDS = "the of stream river granite copper window signal quartz meadow harbor lantern velvet orchid timber saffron".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def corpus():
    """Small texts with nulls, empty and very long ones, copies, ties, repeated rows, and columns with clashing names."""
    r = random.Random(5)
    base = [prose(r, 60) for _ in range(8)]
    passage = prose(r, 45)
    texts = [None, "", "  \n\t ", "one", "One", "two words here", "ééé ñ 日本語 \U0001f600", *base, base[0], base[0], base[1].upper()]
    for k in range(12):  # near copies with one or several words changed
        w = base[2].split(" ")
        for _ in range(1 + k % 5):
            w[r.randrange(len(w))] = "changed" + str(r.randrange(99))
        texts.append(" ".join(w))
    texts += [prose(r, 15) + "\n" + passage + "\n" + prose(r, 15) for _ in range(4)]
    texts += [("ab " * 400).strip(), "x" * 900, prose(r, 4000), "\n".join(["same line of text"] * 30)]
    texts += ["a b  c d　e", "tail  spaces  \n\n", "<|endoftext|> it's <|startoftext|>", "Licensed under the Apache License, Version 2.0.\nmore text here"]
    rows = [(k, t, "en", None if k % 7 == 0 else f"src{k % 3 if k % 2 else 0}", len(t or ""), k, "x") for k, t in enumerate(texts)]
    return rows + [rows[8], (None, base[3], "en", "src1", 1, 1, "y")]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
