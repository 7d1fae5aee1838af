"""Each stage of the pipeline against a plain version of it on the stage's own input."""

import os
import re
from collections import Counter

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from .test_operators import WORD, slow_components  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """{stage: ids and texts before and after}."""
    at, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(at / name))
        after = spark.read.parquet(str(at / name))
        assert k == 4 or after.columns == columns
        read = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
        out[name] = (read(docs), read(after) if k < 4 else after.collect())
        docs = after
    return out


def accepted(text):
    w = WORD.findall(text)
    twice = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if twice[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    lines, chars = [x for x in text.split("\n") if WORD.search(x)], sum(map(len, w))
    return len(w) >= 20 and 100 * len(covered) <= 30 * len(w) and 10 * len(re.findall(r"[#*$%&|<>]", text)) <= len(w) and 2 * (len(lines) - len(set(lines))) <= len(lines) and 2 * len(w) <= chars <= 15 * len(w) and marked(w, lines)


def marked(w, lines):
    bullets = sum(x.lstrip("\x20\t\n\v\f\r").startswith(("-", "*", "•")) for x in lines)
    ellipses = sum(x.rstrip("\x20\t\n\v\f\r").endswith(("...", "…")) for x in lines)
    return 10 * sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", x)) for x in w) >= 6 * len(w) and 10 * bullets <= 9 * len(lines) and 10 * ellipses <= 3 * len(lines)


def test_rules(steps):
    before, after = steps["quality_rules"]
    assert after == {k: t for k, t in before.items() if accepted(t)}


def test_classifier(spark, steps):
    before, after = steps["quality_classifier"]
    assert after.items() <= before.items()
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    known = [k for k in before if k in quality]
    assert sum((k in after) == quality[k] for k in known) > 0.95 * len(known)


def test_near_duplicates(steps):
    before, after = steps["ngram_jaccard"]
    assert after == {k: before[k] for k in {c for _, _, c in slow_components([(k, t) for k, t in before.items()])}}


def test_repeated_passages(steps):
    before, after = steps["suffix_array_dedup"]
    assert before.keys() == after.keys()
    seen = Counter(b[k : k + 200] for b in (t.encode() for t in before.values()) for k in range(len(b) - 199))
    for key, text in before.items():
        b = text.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        first = [k for k in range(len(b)) if b[k] & 0xC0 != 0x80] + [len(b)]
        whole = {k for s, e in zip(first, first[1:]) for k in range(s, e) if gone[s:e].all()}  # noqa: B905
        assert after[key] == bytes(x for k, x in enumerate(b) if k not in whole).decode()


def test_packing(steps):
    before, items = steps["best_fit_packing"]
    tokens, room = Counter(), Counter()
    for x in items:
        tokens[x["doc_id"]] += x["n_tokens"]
        room[x["bin_id"]] += x["n_tokens"]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokens == {k: len(t.encode(x, add_special_tokens=False).ids) + 1 for k, x in before.items()} and max(room.values()) <= 2048


def test_run_is_the_stages_in_order(spark, steps):
    key = lambda r: (r["doc_id"], r["piece"], r["n_tokens"])
    assert sorted(map(key, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(key, steps["best_fit_packing"][1]))
