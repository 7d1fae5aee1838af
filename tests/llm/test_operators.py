"""Each operator against a plain version of itself on a small table of odd cases."""

import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from tickloom.llm import bpe, classifier, components, encode, kernels, key_filter, license_scan, media, ngram_join, packing, quality_rules, substrings, token_files  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def got(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def slow_components(rows):
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[root(k)] = min(least.get(root(k), r[0]), r[0])
    return sorted(((r[0], len(sets[k]), least.get(root(k))) for k, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [96, 3])
def test_ngram_components(docs, rows, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    assert got(ngram_join.link_components(docs), "doc_id", "n_shingles", "component_id") == slow_components(rows)


def test_ngram_join_keeps_one_of_each_group(docs, rows):
    groups = {c for _, _, c in slow_components(rows)}
    kept = ngram_join.keep_one(docs.withColumns({"row": F.lit(1), "id": F.lit("x"), "same": F.lit(2), "gone_id": F.lit(3), "__node": F.lit(4)}))
    assert kept.columns == [*docs.columns, "row", "id", "same", "gone_id", "__node"] and kept.where("row = 1 and same = 2 and gone_id = 3 and __node = 4").count() == kept.count()
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None} == groups - {None}


def test_a_shingle_of_very_many_texts_makes_no_cluster(spark):
    """Texts of one template that have too little else in common: neither their pairs nor a cluster come up."""
    template = list(range(1_000_000, 1_000_080))
    rows = [(k, 100, [9_000 + (k + j) // 2 for j in range(4)] + template) for k in range(2000)]  # 80 of 100 common, a few shared by two or three
    rows += [(5000 + k, 100, [50_000 + j for j in range(10)] + template) for k in range(2)]  # 90 common: linked
    ordered = spark.createDataFrame(rows, "node long, n long, tokens array<long>")
    assert got(ngram_join.clusters(ordered, 75), "node", "cluster") == [(5000, 5000), (5001, 5000)]


def test_pages_of_one_template_are_told_apart(spark):
    r = __import__("random").Random(6)
    from .conftest import prose

    head = prose(r, 60)
    texts = [f"{head} {prose(r, 18)}" for _ in range(120)]
    texts += [t + " more" for t in texts[:5]]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(ngram_join.link_components(df), "doc_id", "n_shingles", "component_id") == slow_components(rows)


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_ngram_components_without_bitmaps(docs, rows, monkeypatch, limit):
    monkeypatch.setattr(key_filter, "LIMIT_BITS", limit)
    monkeypatch.setattr(components, "EDGES", 3)
    assert got(ngram_join.link_components(docs), "doc_id", "n_shingles", "component_id") == slow_components(rows)


def test_keep_one_goes_by_rows(spark):
    """A repeated id on different texts: the clean one stays; of near texts with the same least id one stays."""
    from .conftest import prose

    r = __import__("random").Random(4)
    a, b, clean, c = (prose(r, 60) for _ in range(4))
    texts = [(1, a), (5, a + " x"), (5, clean), (7, b), (7, b + " y"), (8, c), (None, c + " z"), (None, "no id here"), (9, ""), (9, ""), (9, None)]
    kept = ngram_join.keep_one(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    found = Counter(tuple(x) for x in kept)
    sevens = [k for k in found if k[0] == 7]
    assert len(sevens) == 1 and sevens[0] in texts
    assert {k: v for k, v in found.items() if k[0] != 7} == {k: 1 for k in [(1, a), (5, clean), (8, c), (None, "no id here"), (9, ""), (9, None)]}


def test_prefix_tree_on_random_sets():
    r = np.random.default_rng(3)
    for _ in range(30):
        m = int(r.integers(2, 25))
        base = r.choice(1000, 30, replace=False)
        sets = [np.unique(np.concatenate([base[: int(r.integers(15, 31))], r.choice(1000, int(r.integers(0, 12)))])) for _ in range(m)]
        count = Counter(int(x) for s in sets for x in s)
        shared = [sorted((count[int(x)], int(x)) for x in s if count[int(x)] > 1) for s in sets]
        live = [k for k in range(m) if len(shared[k]) >= ngram_join.least_overlap(len(sets[k]))]
        if not live:
            continue
        tree = ngram_join.PrefixTree(np.array(live), np.array([len(sets[k]) for k in live]), [np.array([x for _, x in shared[k]]) for k in live], [np.array([f for f, _ in shared[k]]) for k in live], 75)
        edges = tree.join(np.ones(len(live), bool), np.ones(len(live), bool))
        parent = list(range(m))

        def root(k, parent=parent):
            while parent[k] != k:
                k = parent[k]
            return k

        for a, b in edges:
            assert 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))
            parent[root(a)] = root(b)
        for a in range(m):
            for b in range(a):
                if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b])):
                    assert root(a) == root(b)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(5, 5), (1, 2), (2, 1), (260, 140)]
    found = dict(components.components(spark.createDataFrame(edges, "u long, v long").repartition(4)).collect())
    assert found == {k: 100 for k in range(100, 141)} | {260: 100} | {k: 7 for k in [7, *range(200, 260)]} | {1: 1, 2: 1}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_token_shards_round_trip(docs, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = tokenizers.Tokenizer.from_file(path)
    shards = token_files.write_token_shards(docs, path)
    found = sorted(token_files.read_token_shards(shards).collect(), key=lambda r: r["start"])
    want = sorted(((r[0], t.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r["doc_id"] for r in found] == [k for k, _ in want]
    assert [r["n_tokens"] for r in found] == [len(x) for _, x in want]
    assert Counter(r["ids_crc32"] for r in found) == Counter(zlib.crc32(np.array(x, "<u4").tobytes()) for _, x in want)
    assert [r["start"] for r in found] == np.cumsum([0, *(len(x) for _, x in want)])[:-1].tolist()


def test_bit_packing_and_random_access():
    r = np.random.default_rng(0)
    for bits in (1, 7, 16, 17, 31):
        for n in (0, 1, 33, 5000):
            x = r.integers(0, 1 << bits, n).astype(np.uint32)
            assert (token_files.unpack(token_files.pack(x, bits), bits, n) == x).all()
            shard = token_files.Shard(token_files.write_shard(np.array([5, 6]), np.array([n // 2, n - n // 2]), x, bits, 128))
            assert (shard.document(1) == x[n // 2 :]).all() and (shard.read(n // 3, n) == x[n // 3 :]).all()
    with pytest.raises(ValueError):
        token_files.Shard(b"none" + bytes(40))


@pytest.mark.parametrize("block_bytes", [8, 64, 1 << 20])
def test_token_counts_across_blocks(docs, rows, block_bytes):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = tokenizers.Tokenizer.from_file(path)
    t.encode_special_tokens = True
    blocks, listed = token_files.write_flat(docs.where("length(text) < 3000 or text is null"), path, 50256, block_bytes=block_bytes)
    found = token_files.count_tokens(blocks, 50256).join(listed, ["stream", "ordinal"])
    want = sorted(((r[0], len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in rows if len(r[1] or "") < 3000), key=str)
    assert got(found, "doc_id", "n_tokens") == want


def test_token_counts_of_plain_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([5, 9, 9, 5, 5, 5, 9, 1], "<u2").tobytes())
    counts = token_files.count_tokens(token_files.read_flat(spark, str(tmp_path), 6), 9)
    assert got(counts, "ordinal", "start", "n_tokens") == [(0, 0, 2), (1, 2, 1), (2, 3, 4), (3, 7, 1)]


def test_ranges_of_large_flat_files(spark, tmp_path):
    """Files of many blocks, one of which is no whole number of blocks, and an empty one."""
    r = np.random.default_rng(4)
    x = {"a.bin": r.integers(0, 50, 40_000).astype("<u4"), "b.bin": r.integers(0, 50, 12_345).astype("<u4"), "c.bin": np.zeros(0, "<u4")}
    for name, ids in x.items():
        (tmp_path / name).write_bytes(ids.tobytes())
    counts = token_files.count_tokens(token_files.read_flat(spark, str(tmp_path), 4096), 7, 4)
    found = sorted((Path(r["stream"]).name, r["start"], r["n_tokens"]) for r in counts.collect())
    want = []
    for name, ids in x.items():
        ends = [0, *(np.flatnonzero(ids == 7) + 1).tolist(), *([len(ids)] if len(ids) and ids[-1] != 7 else [])]
        want += [(name, a, b - a) for a, b in zip(ends, ends[1:])]  # noqa: B905
    assert found == sorted(want)


def test_export_writes_whole_files(docs, rows, tmp_path):
    shards = token_files.write_token_shards(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.export(shards, str(tmp_path / "out")) == len(list((tmp_path / "out").glob("*.tkp"))) == len(list((tmp_path / "out").iterdir()))
    held = [token_files.Shard(f.read_bytes()) for f in sorted((tmp_path / "out").iterdir())]
    assert [x if k else None for s in held for x, k in zip(s.doc_ids.tolist(), s.known.tolist(), strict=True)] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))


def test_license_scan(docs, spark):
    import duckdb

    found = license_scan.license_scan(docs)
    plain = docs.select("doc_id", "text").toArrow()  # noqa: F841
    con = duckdb.connect()
    con.sql("create view documents as select * from plain")
    assert got(found, "doc_id", "license", "dice", "n_licenses") == sorted(con.sql(license_scan.oracle_sql()).fetchall(), key=str)
    mit = license_scan.TEMPLATES["MIT"][2]
    texts = [(1, "intro\n\n" + mit.replace("charge", "cost").replace(". ", ".\n") + "\n\nend"), (2, mit.upper()), (3, "Licenced under CC-BY-NC 4.0"), (4, mit[:300])]
    found = {r["doc_id"]: r["license"] for r in license_scan.license_scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found == {1: "MIT", 2: "MIT", 3: "CC-BY-NC-4.0", 4: None}
    assert "Python" not in license_scan.license_scan(docs)._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")


def slow_license(text, least=0.8):
    """Every window of the text against every template."""
    grams = license_scan.words_of(text or "")
    grams = [f"{a} {b}" for a, b in zip(grams, grams[1:])]  # noqa: B905
    found = {}
    for name, texts in license_scan.TEMPLATES.items():
        for b in (set(license_scan.bigrams_of(t)) for t in texts):
            for i in range(len(grams)):
                seen, hits = set(), 0
                for g in grams[i:]:
                    hits += g in b and g not in seen
                    seen.add(g)
                    if 2 * hits / (len(seen) + len(b)) >= least:
                        found[name] = max(found.get(name, 0), 2 * hits / (len(seen) + len(b)))
    return (*min(((-d, n) for n, d in found.items()), default=(0.0, None))[::-1], len(found))


def test_license_notices_in_longer_texts(spark):
    """Notices of several paragraphs at the head of code, and short ones within longer lines."""
    code = "\n\n".join(f"def f{k}(a, b{k}):\n    return a * {k} + b{k}" for k in range(60))
    head = lambda t, *at: re.sub("|".join(map(re.escape, at)), lambda m: "\n\n" + m[0], t)
    full = license_scan.TEMPLATES
    notices = {
        "MIT": "MIT License\n\nCopyright (c) 2020 X\n\n" + head(full["MIT"][2], "The above", "THE SOFTWARE IS"),
        "Apache-2.0": "Copyright 2020 X\n\n" + head(full["Apache-2.0"][1], "You may obtain", "Unless required"),
        "GPL-3.0": "X does Y.\n\n" + head(full["GPL-3.0"][1], "This program is distributed", "You should have"),
    }
    texts = [(k, notice + "\n\n" + code, name) for k, (name, notice) in enumerate(notices.items())]
    texts += [(10, "Licensed under the MIT License. See LICENSE for details.", "MIT"), (11, "# Copyright 2020 X. Licensed under the MIT License. All rights reserved, see below.", "MIT")]
    texts += [(12, code, None), (13, code[:900] + "\n\n" + notices["MIT"].replace("copies", "many good copies"), "MIT"), (14, None, None)]
    scan = license_scan.license_scan(spark.createDataFrame(texts, "doc_id long, text string, want string"))
    found = {r["doc_id"]: (r["license"], r["dice"], r["n_licenses"]) for r in scan.collect()}
    assert {k: v[0] for k, v in found.items()} == {k: name for k, _, name in texts}
    assert min(found[k][1] for k in range(3)) > 0.97
    for k, text, _ in texts:
        if k >= 10:
            name, neg, n = slow_license(text)
            assert found[k] == (name, round(-neg, 6), n)


def test_near_sibling_licenses_are_told_apart(spark):
    """Full texts and notices that differ by a few words from those of another license."""
    gnu = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {}General Public License for more details.\n\nYou should have received a copy of the GNU {}General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
    kinds = [("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3")]
    cases = [(name, gnu.format(a, v, a, a)) for name, a, v in kinds]
    cases += [(name, f"This work is licensed under a Creative Commons Attribution-{x} 4.0 International License.") for name, x in (("CC-BY-SA-4.0", "ShareAlike"), ("CC-BY-NC-SA-4.0", "NonCommercial-ShareAlike"), ("CC-BY-NC-ND-4.0", "NonCommercial-NoDerivatives"), ("CC-BY-ND-4.0", "NoDerivatives"))]
    two = license_scan.TEMPLATES["BSD-2-Clause"][1]
    third = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE"
    cases += [("BSD-2-Clause", two), ("BSD-3-Clause", two.replace("THIS SOFTWARE", third, 1))]
    texts = {name: license_scan.TEMPLATES[name][-1] for name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC0-1.0", "BSL-1.0", "Unlicense", "Zlib")}
    cases += [(name, "some code\n\n" + t + "\n\nmore code") for name, t in texts.items()]
    cases += [(name, re.sub(r"\bcovered\b", "included", t) + "\n\nmore code") for name, t in texts.items()]
    rows = [(k, t) for k, (_, t) in enumerate(cases)]
    found = {r["doc_id"]: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[k]["license"] for k, _ in rows] == [name for name, _ in cases]
    assert min(r["dice"] for r in found.values()) > 0.95
    assert all(len(license_scan.bigrams_of(texts[x])) > 500 for x in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"))


def test_key_words_hit_every_match():
    keys = license_scan.key_words(license_scan.TEMPLATES, 0.8)
    for texts in license_scan.TEMPLATES.values():
        for t in texts:
            grams = license_scan.bigrams_of(t)
            without = [g for g in grams if not any(k in w for k in keys for w in g.split())]
            assert len(without) < license_scan.size_bounds(len(grams), 0.8)[0]


def removed(texts):
    """(bytes, removed, runs, kept) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + 200] for b in raw for k in range(len(b) - 199))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        keep = bytes(x for x, g in zip(b, gone) if not g)  # noqa: B905
        out.append((len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(keep).hexdigest()))
    return out


def test_suffix_dedup(docs, rows):
    want = sorted(((r[0], *x) for r, x in zip(rows, removed([r[1] for r in rows]), strict=True)), key=str)
    assert got(substrings.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_suffix_dedup_on_random_overlaps(spark):
    import random

    r = random.Random(8)
    pool = "".join(r.choice("abcdé ") for _ in range(3000))
    texts = ["".join(pool[(s := r.randrange(2400)) : s + r.randrange(150, 420)] + r.choice("xyz") for _ in range(r.randrange(1, 5))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert got(substrings.remove_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(((k, *x) for k, x in enumerate(removed(texts))), key=str)
    kept = substrings.keep_unrepeated(df)
    assert kept.columns == df.columns and all("�" not in x["text"] for x in kept.collect())


@pytest.mark.parametrize("size", [450, 1000])
def test_suffix_dedup_of_texts_longer_than_a_slice(spark, docs, rows, monkeypatch, size):
    """Texts of any length: they are ranked in slices, whatever the anchors' own limit is."""
    import random

    monkeypatch.setattr(substrings, "SLICE", size)
    monkeypatch.setattr(substrings, "RANKED", 300)
    r = random.Random(9)
    pool = "".join(r.choice("abcdé ") for _ in range(3000))
    texts = ["".join(pool[(s := r.randrange(2400)) : s + r.randrange(150, 420)] + r.choice("xyz") for _ in range(r.randrange(1, 12))) for _ in range(20)]
    texts += texts[:2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for some, want in ((df, list(enumerate(texts))), (docs, [(r[0], r[1]) for r in rows])):
        found = got(substrings.remove_repeats(some), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert found == sorted(((k, *x) for (k, _), x in zip(want, removed([t for _, t in want]), strict=True)), key=str)


@pytest.mark.parametrize("limit", [0, 1 << 18])
def test_suffix_dedup_without_bitmaps(spark, docs, rows, monkeypatch, limit):
    """Beyond the size of a bitmap ranks are told by joins."""
    monkeypatch.setattr(key_filter, "LIMIT_BITS", limit)
    monkeypatch.setattr(key_filter, "BITS_A_KEY", 1 << 12 if limit else 8)
    want = sorted(((r[0], *x) for r, x in zip(rows, removed([r[1] for r in rows]), strict=True)), key=str)
    assert got(substrings.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_many_copies_and_columns_of_any_name(spark):
    """One text with copies in every partition, next to texts that share a passage; columns named like the operator's own."""
    r = __import__("random").Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    passage, common = " ".join(word() for _ in range(60)), " ".join(word() for _ in range(80))
    texts = [common] * 3000 + [f"{k} {passage} {word()}" for k in range(50)] + [" ".join(word() for _ in range(100)) for _ in range(50)]
    df = spark.createDataFrame([(k, t, k, "n", 1, [k], "a", 2) for k, t in enumerate(texts)], "doc_id long, text string, node long, row string, n_bytes int, all array<int>, __node string, __spans int").repartition(12)
    kept = substrings.keep_unrepeated(df)
    assert kept.columns == df.columns
    found = {x["doc_id"]: x for x in kept.collect()}
    assert all(found[k]["text"] == "" and found[k]["node"] == k and found[k]["all"] == [k] and found[k]["__spans"] == 2 for k in range(3000))
    assert all(passage[3:-3] not in found[k]["text"] and len(found[k]["text"]) < 20 for k in range(3000, 3050))
    assert all(found[k]["text"] == texts[k] for k in range(3050, 3100))


def test_no_text_is_too_long_for_the_anchors(monkeypatch):
    from tickloom.llm import anchors

    monkeypatch.setattr(anchors, "PLACE", 12)
    monkeypatch.setattr(substrings, "SLICE", 4000)
    monkeypatch.setattr(substrings, "RANKED", 4000)
    text = np.random.default_rng(2).integers(97, 123, 30_000, dtype=np.uint8)
    parts = list(substrings.slices(__import__("pyarrow").array([text.tobytes().decode()] * 50)))
    starts = []
    for lo, _, at, buf, off in parts:
        ranked = substrings.ranked(buf, off, [])
        starts += [(lo, at + x) for a, b in zip(ranked.first.tolist(), ranked.last.tolist()) for x in range(a, b + 1)]  # noqa: B905
    assert len(starts) == len(set(starts)) == 50 * (30_000 - 199)


def test_quality_rules(docs, rows):
    def slow(text):
        w = WORD.findall(text or "")
        twice = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {j for k in range(len(w) - 7) if twice[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    report = quality_rules.quality_report(docs)
    assert got(report, "doc_id", *names) == sorted(((r[0], *slow(r[1])) for r in rows), key=str)
    kept = report.where("kept").select("doc_id").collect()
    assert sorted(map(str, kept)) == sorted(str(r) for r in quality_rules.filter_quality(docs).select("doc_id").collect())
    assert quality_rules.filter_quality(docs).columns == docs.columns


def test_marks_of_lines_and_letters():
    texts = ["- a\n * b\n\n• c\nd", "x...\ny…  \n z ..\n…", "12 34 é5 -- a1", ""]
    t = quality_rules.Texts(*next(iter(kernels.text_chunks(__import__("pyarrow").array(texts))))[2:])
    assert [x.tolist() for x in t.line_marks] == [[3, 0, 0, 0], [0, 3, 0, 0]]
    assert t.lettered.tolist() == [5, 4, 2, 0] and t.line_counts[0].tolist() == [4, 4, 1, 0]
    part = t.only(np.array([False, True, True, False]))
    assert part.lettered.tolist() == [4, 2] and part.line_marks[1].tolist() == [3, 0] and part.n_words.tolist() == [5, 5]


def test_cascade_order_does_not_matter():
    t = quality_rules.Texts(*next(iter(kernels.text_chunks(__import__("pyarrow").array(["a b", "x " * 50, " ".join(f"w{k}" for k in range(60)), "# " * 40, " ".join(map(str, range(100, 160)))]))))[2:])
    verdicts = {tuple(quality_rules.cascade(t, tuple(order)).tolist()) for order in (quality_rules.RULES, quality_rules.RULES[::-1])}
    assert verdicts == {(False, False, True, False, False)}


def test_classifier_on_held_out_rows(spark):
    import random

    from .conftest import prose

    r = random.Random(2)
    good, bad = (lambda: prose(r, r.randrange(20, 90)) + "."), (lambda: " ".join(w.upper() + "!!" for w in prose(r, r.randrange(20, 90)).split()))
    y = [int(r.random() < 0.7) for _ in range(300)]
    docs = spark.createDataFrame([(k, good() if v else bad()) for k, v in enumerate(y)] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, v, None) for k, v in enumerate(y)] + [(5000, 1, 0), (901, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = classifier.fit(docs, labels.where(classifier.fold(F.col("doc_id")) != 1))
    found = {x["doc_id"]: x for x in classifier.score(docs, model).collect()}
    held = [k for k in range(300) if classifier.crc_fold(k) == 1]
    assert len(held) > 50 and all(found[k]["predicted"] == y[k] for k in held)
    assert 0 <= found[900]["score"] == found[901]["score"] <= 1
    assert classifier.fit(docs, labels.where("quality = 1")).only == 1.0 and classifier.fit(docs, labels.limit(0)).only == 0.5


def plain_scores(x, y, points, shrink=0.2, ridge=1e-3):
    """Quadratic discriminant analysis by its formulas: densities of two normal distributions, no factors kept."""
    mean = {c: x[y == c].mean(0) for c in (0, 1)}
    cov = {c: np.cov(x[y == c].T, bias=True) for c in (0, 1)}
    share = {c: float((y == c).mean()) for c in (0, 1)}
    pooled = share[0] * cov[0] + share[1] * cov[1]
    spread = np.diag(np.maximum(np.diag(pooled), 1e-6))
    log_density = {}
    for c in (0, 1):
        n, d = int((y == c).sum()), x.shape[1]
        weight = shrink + (1 - shrink) * d / (d + n)
        s = (1 - weight) * cov[c] + weight * (0.9 * pooled + 0.1 * spread) + ridge * spread
        diff = points - mean[c]
        log_density[c] = -0.5 * np.einsum("ij,ij->i", diff, np.linalg.solve(s, diff.T).T) - 0.5 * np.linalg.slogdet(s)[1] + np.log(share[c])
    return 1 / (1 + np.exp(log_density[0] - log_density[1]))


def test_classifier_equals_plain_discriminant_analysis(docs, rows):
    named = {r[0]: r[1] for r in rows if r[0] is not None}
    y = {k: int(k % 3 > 0) for k in named}
    labels = docs.sparkSession.createDataFrame(list(y.items()), "doc_id long, quality int")
    some = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    model = classifier.fit(some, labels)
    found = {r["doc_id"]: r for r in classifier.score(some, model).collect()}
    x = np.concatenate([classifier.vectors(quality_rules.Texts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))) for t in (named[k] or "" for k in sorted(named))])
    want = plain_scores(x, np.array([y[k] for k in sorted(named)]), x)
    assert np.allclose([found[k]["score"] for k in sorted(named)], want, atol=1e-9)
    assert all(found[k]["predicted"] == int(found[k]["score"] >= 0.5) for k in named)
    kept = classifier.keep_good(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} - {None} == {k for k in named if found[k]["score"] >= 0.5}


@pytest.mark.parametrize("vocabulary", [None, "byte_bpe_50k.json"])
def test_packing(docs, rows, vocabulary):
    path = vocabulary and public_tokenizers.path(vocabulary)
    count = (lambda t: len(tokenizers.Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids)) if path else (lambda t: len(WORD.findall(t)))
    items = packing.best_fit(docs, capacity=256, shard_items=20, vocabulary=path).collect()
    bins = {}
    for x in items:
        bins.setdefault(x["bin_id"], []).append(x)
    for held in bins.values():
        assert sum(x["n_tokens"] for x in held) <= 256
        assert len({x["source"] for x in held}) == len(held) == len({x["cluster"] for x in held})
    tokens = Counter()
    for r in rows:
        tokens[r[0]] += count(r[1] or "") + 1
    assert tokens == sum((Counter({x["doc_id"]: x["n_tokens"]}) for x in items), Counter())
    assert len({x["item"] for x in items}) == len(items)


def test_packing_equals_plain_best_fit_step_by_step():
    """At each step the room of the bin that was taken is that of plain best fit, given the bins so far."""
    r = np.random.default_rng(11)
    for _ in range(40):
        n, capacity = int(r.integers(1, 60)), 30
        length = np.sort(r.integers(1, capacity + 1, n))[::-1].copy()
        source, cluster = r.integers(0, 6, n), r.integers(0, 25, n)
        out = packing.pack(length, source, cluster, capacity)
        bins = {}
        for k in range(n):
            fit = [b for b, x in bins.items() if x["room"] >= length[k] and source[k] not in x["sources"] and cluster[k] not in x["clusters"]]
            if fit:
                assert out[k] in fit and bins[out[k]]["room"] == min(bins[b]["room"] for b in fit)
            else:
                assert out[k] not in bins
            x = bins.setdefault(out[k], {"room": capacity, "sources": set(), "clusters": set()})
            x["room"] -= length[k]
            x["sources"].add(source[k])
            x["clusters"].add(cluster[k])


def test_packing_of_very_many_equal_rows_and_counts_of_a_column(spark):
    df = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same text").alias("text"), F.lit("s").alias("source"), F.lit(9).alias("n"))
    items = packing.best_fit(df, capacity=32, shard_items=100, tokens_col="n").collect()
    assert len(items) == len({x["bin_id"] for x in items}) == 3000 and {x["n_tokens"] for x in items} == {10}
    assert len({x["bin_id"] >> 24 for x in items}) > 20


def test_packing_keeps_near_copies_apart_by_a_cluster_column(docs):
    linked = docs.where("doc_id is not null").join(ngram_join.link_components(docs).select("doc_id", "component_id").distinct(), "doc_id")
    items = packing.best_fit(linked, capacity=256, distinct_sources=False, cluster_col="component_id").collect()
    held = Counter((x["bin_id"], x["cluster"]) for x in items)
    near = Counter(x["cluster"] for x in items if x["piece"] == 0)
    assert max(held.values()) == 1 and near[9] > 3  # document 9 and near copies of it


def test_packing_takes_the_tightest_compatible_bin():
    assert packing.pack(np.array([6, 5, 4, 3]), np.array([0, 1, 0, 2]), np.arange(4), 10).tolist() == [0, 1, 1, 0]
    assert packing.pack(np.array([6, 4, 4]), np.array([0, 1, 2]), np.array([7, 7, 8]), 10).tolist() == [0, 1, 0]
    assert packing.pack(np.array([6, 4]), np.array([0, 0]), np.array([1, 2]), 10, distinct_sources=False).tolist() == [0, 0]


def plain_features(p):
    """By hand: a WAV file read by the standard library, and its samples one by one."""
    import io
    import math
    import wave

    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(8000)
        w.writeframes(p)
    v = [x - 128 for x in p]
    turns = sum((a < 0) != (b < 0) for a, b in zip(v, v[1:]))  # noqa: B905
    bins = [sum(32 * k <= x < 32 * k + 32 for x in p) for k in range(8)]
    return out.getvalue(), f"mean={sum(v) / len(v):.6f};rms={math.sqrt(sum(x * x for x in v) / len(v)):.6f};turns={turns};bins={','.join(map(str, bins))}"


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_media(docs, rows, monkeypatch, limit):
    monkeypatch.setattr(key_filter, "LIMIT_BITS", limit)
    want = []
    for r in rows:
        b = (r[1] or "").encode()
        p = b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
        file, feature = plain_features(p)
        want.append((r[0], len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(file), hashlib.sha256(file).hexdigest(), feature))
    assert got(media.media_report(docs), "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature") == sorted(want, key=str)


def test_lost_and_changed_chunks_are_errors(docs):
    stores = media.store_media(docs)
    assert stores["chunk"].count() > 0 and stores["medium"].where(~F.exists("own", lambda x: x.isNull())).count() > 0
    n = media.read_media(stores).count()
    lacking = media.read_media(stores | {"chunk": stores["chunk"].limit(0)})
    with pytest.raises(Exception, match="not in the store"):
        lacking.collect()
    zstandard = pytest.importorskip("zstandard")
    other = F.lit(zstandard.ZstdCompressor().compress(b"other bytes"))
    with pytest.raises(Exception, match="digest"):
        media.read_media(stores | {"chunk": stores["chunk"].withColumn("data", other)}).collect()
    assert n == stores["manifest"].select("media_sha256").distinct().count()


def test_media_chunks_are_content_defined():
    r = np.random.default_rng(1)
    body = r.integers(0, 256, 60_000, dtype=np.uint8)
    pieces = lambda x: set(media.pieces(x.tobytes(), media.cuts(media.gear_marks(x).tolist(), len(x))))
    shifted = np.concatenate([r.integers(0, 256, 77, dtype=np.uint8), body])
    assert len(pieces(body) & pieces(shifted)) > 0.8 * len(pieces(body))
    assert all(len(p) <= media.LONGEST for p in pieces(np.zeros(50_000, np.uint8)))


def test_bpe_equals_the_library(docs, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = tokenizers.Tokenizer.from_file(path)
    want = []
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    found = bpe.encode_decode(docs, path)
    assert got(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    one = found.where("doc_id = 5").first()
    assert bpe.bpe(path).decode(one["ids"]) == one["decoded"]


@pytest.mark.parametrize("text", ["ΑΣ ΟΔΟΣ Σ", "İstanbul", "é å ́x", "a\x1cb", "日本語 ½ ① ²3", "ß ẞ ǅ ﬁ", "١٢٣ 123", "I'LL don'T", "힣한", "﻿bom", "a  b\n\n c\t\td  ", "\n", "x​y"])
def test_both_encoders_on_odd_texts(text):
    buf, off = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
    for model, name in ((bpe.bpe(public_tokenizers.path("word_bpe_49k.json")).texts, "word_bpe_49k.json"), (encode.byte_encoder(public_tokenizers.path("byte_bpe_50k.json")), "byte_bpe_50k.json")):
        assert model(buf, off)[0].tolist() == tokenizers.Tokenizer.from_file(public_tokenizers.path(name)).encode(text, add_special_tokens=False).ids


def test_empty_tables(empty, spark):
    byte, word = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
    blocks, listed = token_files.write_flat(empty, byte, 50256)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    results = [
        ngram_join.link_components(empty), ngram_join.keep_one(empty), token_files.read_token_shards(token_files.write_token_shards(empty, byte)), license_scan.license_scan(empty),
        substrings.remove_repeats(empty), substrings.keep_unrepeated(empty), token_files.count_tokens(blocks, 50256), listed, classifier.score(empty, classifier.fit(empty, labels)),
        quality_rules.quality_report(empty), quality_rules.filter_quality(empty), classifier.keep_good(empty, classifier.fit(empty, labels)), packing.best_fit(empty), media.media_report(empty), bpe.encode_decode(empty, word),
    ]
    assert [df.count() for df in results] == [0] * len(results)
