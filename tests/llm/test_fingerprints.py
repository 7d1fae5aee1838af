"""Strings that a polynomial modulo 2**64 cannot tell apart, and what is built on fingerprints."""

import json
from collections import Counter

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from tickloom.llm import bpe, encode, kernels, memo, ngram_join, quality_rules, substrings, token_files  # noqa: E402

A = "a"
for _ in range(10):  # Thue-Morse
    A += A.translate({97: 98, 98: 97})
B = A.translate({97: 98, 98: 97})
PROSE = " ".join(f"word{k}" for k in range(40))
TEXTS = [f"{A} {B}", f"x {A} {B}", f"{A}\n{B}", f"{PROSE} {A}", f"{PROSE} {B}", f"{PROSE}\n{A}\n{A}", A, B, A[:600] + "c" + B, B[300:900]]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)


def test_strings_of_all_lengths():
    raw = np.random.default_rng(0).integers(97, 99, 3000, dtype=np.uint8)
    start, end = np.meshgrid(np.arange(0, 700, 7), np.arange(0, 1200, 13))
    start, end = start.ravel(), start.ravel() + end.ravel()
    at8 = kernels.wide(raw)
    h, other = kernels.strings(at8, raw, start, end), kernels.strings(at8, raw, start, end, seed=5)
    seen = {}
    for s, e, x, y in zip(start.tolist(), end.tolist(), h.tolist(), other.tolist(), strict=True):
        assert seen.setdefault(raw[s:e].tobytes(), (x, y)) == (x, y)
    assert len({x for x, _ in seen.values()}) == len({y for _, y in seen.values()}) == len(seen)
    moved = np.concatenate([raw[:5], raw])
    assert (kernels.strings(kernels.wide(moved), moved, start + 5, end + 5) == h).all()


@pytest.mark.parametrize("text", TEXTS)
def test_encoders(text):
    buf, off = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
    for model, name in ((bpe.bpe(public_tokenizers.path("word_bpe_49k.json")).texts, "word_bpe_49k.json"), (encode.byte_encoder(public_tokenizers.path("byte_bpe_50k.json")), "byte_bpe_50k.json")):
        assert model(buf, off)[0].tolist() == tokenizers.Tokenizer.from_file(public_tokenizers.path(name)).encode(text, add_special_tokens=False).ids


def test_a_unit_with_the_key_of_another_is_encoded_by_itself(monkeypatch):
    """All keys equal: only the second fingerprint tells units apart."""
    real = kernels.strings
    monkeypatch.setattr(kernels, "strings", lambda at8, buf, start, end, seed=0: real(at8, buf, start, end, seed) if seed else np.full(len(start), 7, np.uint64))

    def encoded(units):
        return np.concatenate([np.frombuffer(u, np.uint8) for u in units]).astype(np.uint16), np.array([len(u) for u in units])

    m, raw = memo.UnitMemo(encoded), np.frombuffer(b"ab cde ab f", np.uint8)
    for _ in range(2):
        ids, length = m.ids(raw, np.array([0, 3, 7, 10]), np.array([2, 6, 9, 11]))
        assert bytes(ids.astype(np.uint8)) == b"abcdeabf" and length.tolist() == [2, 3, 2, 1]


def test_quality_statistics(words):
    found = {r["doc_id"]: r for r in quality_rules.quality_report(words).collect()}
    assert [found[k]["n_dup_lines"] for k in range(6)] == [0, 0, 0, 0, 0, 1]


def test_joins_and_removal(words):
    from .test_operators import got, removed, slow_components

    assert got(ngram_join.link_components(words), "doc_id", "n_shingles", "component_id") == slow_components(list(enumerate(TEXTS)))
    want = sorted(((k, *x) for k, x in enumerate(removed(TEXTS))), key=str)
    assert got(substrings.remove_repeats(words), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_token_files(words):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = tokenizers.Tokenizer.from_file(path)
    want = [len(t.encode(x, add_special_tokens=False).ids) + 1 for x in TEXTS]
    read = {r["doc_id"]: r["n_tokens"] for r in token_files.read_token_shards(token_files.write_token_shards(words, path)).collect()}
    assert [read[k] for k in range(len(TEXTS))] == want
    blocks, listed = token_files.write_flat(words, path, 50256)
    counted = {r["doc_id"]: r["n_tokens"] for r in token_files.count_tokens(blocks, 50256).join(listed, ["stream", "ordinal"]).collect()}
    assert [counted[k] for k in range(len(TEXTS))] == want


def other_file(tmp_path, name, more, size=0):
    """A packaged vocabulary with other added tokens, and so many further vocabulary entries."""
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        spec = json.load(f)
    top = max(max(spec["model"]["vocab"].values()), *(t["id"] for t in spec["added_tokens"])) + 1
    spec["added_tokens"] += [{"id": top + size + k, "content": c, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True} for k, c in enumerate(more)]
    spec["model"]["vocab"] |= {f"☃{k}": top + k for k in range(size)}
    (tmp_path / name).write_text(json.dumps(spec), encoding="utf-8")
    return str(tmp_path / name)


@pytest.mark.parametrize("size", [0, 30_000])
def test_any_added_tokens_and_large_vocabularies(tmp_path, size):
    text = "x [PAD] <s>a [PAD][PAD] two words b </s> y two  words"
    buf, off = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    for name, model in (("word_bpe_49k.json", lambda p: bpe.Bpe(p).texts), ("byte_bpe_50k.json", encode.ByteEncoder)):
        path = other_file(tmp_path, name, ["[PAD]", "<s>", "two words"], size)
        want = tokenizers.Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
        assert model(path)(buf, off)[0].tolist() == want and (max(want) > 65_535) == (size > 0)


def test_a_null_id_is_not_the_least_long(spark):
    least = -(1 << 63)
    df = spark.createDataFrame([(least, "a b"), (None, "c"), (least + 1, "d e f")], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    read = token_files.read_token_shards(token_files.write_token_shards(df, path)).orderBy("start").collect()
    assert [r["doc_id"] for r in read] == [None, least, least + 1]
    assert Counter(r["doc_id"] for r in token_files.write_flat(df, path, 50256)[1].collect()) == Counter([None, least, least + 1])
