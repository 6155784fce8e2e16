"""Merkle manifest, ranked search and SimHash components against brute force, edge cases included."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import TESTDATA
from pyspark.sql import functions as F

from martline.llm import lexical, merkle, simhash
from martline.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(digests):
    found = [digests]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return found


def climbed(rows):
    """Per row of (key, tree, digest, claim): key, leaf, subroot, root, proof and folded root."""
    trees = {}
    for key, tree, own, claim in rows:
        trees.setdefault(tree, []).append((key, own, claim or own))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    grown = {t: levels([r[1] for r in trees[t]]) for t in names}
    top = levels([grown[t][-1][0] for t in names])
    out = []
    for number, name in enumerate(names):
        for place, (key, own, claim) in enumerate(trees[name]):
            folded, proof = claim, ""
            for tree, at in ((grown[name], place), (top, number)):
                for level in tree[:-1]:
                    run, i = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    proof += "".join(run[:i] + run[i + 1 :])
                    folded, at = sha("".join(run[:i] + [folded] + run[i + 1 :])), at // 16
            out.append((key, own, grown[name][-1][0], top[-1][0], proof, folded))
    return out


@pytest.mark.parametrize(("n", "sources"), [(4500, 40), (300, 1), (17, 1), (1, 1), (20, 20)])
def test_climb_equals_plain_trees(spark, n, sources):
    rng = random.Random(n)
    names = [None, "hot", "é", "", "z"] + [f"s{i}" for i in range(sources)]
    pick = (lambda: rng.choice(names + ["hot"] * len(names))) if sources > 1 else (lambda: "one")
    rows = [(i, pick(), sha(str(i)), rng.choice([None, sha(f"claim {i}")])) for i in range(n)]
    frame = spark.createDataFrame(rows, "k long, src string, d string, c string").withColumn("tree", F.lit(1)).withColumn("idx", F.lit("x"))
    found = merkle.climb(merkle.build(frame, "src", "k", "d", "c")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(climbed(rows), key=repr)


def test_null_keys_and_repeated_rows(spark):
    rows = [(None, "a", sha(f"n{i}"), None) for i in range(40)] + [(5, "a", sha("same"), None)] * 50 + [(i, None, sha(str(i)), None) for i in range(3)]
    frame = spark.createDataFrame(rows, "k long, src string, d string, c string")
    found = [tuple(r) for r in merkle.climb(merkle.build(frame, "src", "k", "d", "c")).collect()]
    assert sorted(found, key=repr) == sorted(climbed(rows), key=repr)
    assert all(r[5] == r[3] for r in found)


def test_manifest_of_nothing_and_session_limit(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    empty = spark.createDataFrame([], "k long, src string, d string")
    assert merkle.climb(merkle.build(empty, "src", "k", "d")).collect() == []
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) == before


def test_fields_tell_null_from_text(spark):
    row = spark.createDataFrame([(1, None, "-", "é", "")], "a long, b string, c string, d string, e string")
    assert row.select(merkle.digest([F.col(c) for c in "abcde"]).alias("h")).first()["h"] == sha("1:1" + "-" + "1:-" + "2:é" + "0:")


# ranked search


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def best(items, docs, k):
    counts = [(i, Counter(words(t))) for i, t in docs]
    total = sum(1 for _, c in counts if c)
    length = sum(c.total() for _, c in counts)
    frequency = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in counts:
            m = 100 - 50 + (50 * c.total() * total) // length if length else 0
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * frequency[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(words(text)) if c[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, rank + 1, doc, -score) for rank, (score, _, doc) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def search_rows(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "x1", " ", "É"]
    docs = [(i * 3 % 101, " ".join(rng.choices(vocabulary, k=rng.randrange(40))).replace("w1 ", "W1,")) for i in range(n)]
    docs += [(None, docs[0][1]), (None, docs[1][1]), (500, None), (501, ""), (502, "--- ..."), *docs[:6], *docs[:6]]
    docs += [(503, "w2 " * 30_000 + "w3")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 25)))) for i in range(12)]
    return items + [items[0], (None, items[1][1]), (99, None), (98, "?!"), (97, "absent")], docs


@pytest.mark.parametrize("tight", [False, True])
def test_search_equals_scoring_all(spark, monkeypatch, tight):
    if tight:  # several blocks, tiles, column tiles and document tiles
        for name, value in {"ITEMS": 3, "TERMS": 4, "DOCUMENTS": 5, "BLOCK": 60, "TILE": 30}.items():
            monkeypatch.setattr(lexical, name, value)
    items, docs = search_rows(3, 120)
    item_frame = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(1)).withColumn("term", F.lit("t"))
    doc_frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS).withColumn("n", F.lit("x")).withColumn("score", F.lit(1))
    found = [tuple(r) for r in lexical.search(item_frame, doc_frame.repartition(3), k=10).collect()]
    assert sorted(found, key=repr) == sorted(best(items, docs, 10), key=repr)


def test_ties_go_to_smaller_ids(spark):
    docs = spark.createDataFrame([(i, "one two") for i in range(700, 0, -1)] + [(1000, "three")], "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(1, "TWO")], "item_id long, text string")
    assert [r["doc_id"] for r in lexical.search(items, docs).orderBy("rank").collect()] == list(range(1, 51))


def test_search_in_nothing(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert lexical.search(items, docs.limit(0)).collect() == []
    assert lexical.search(items.limit(0), docs).collect() == []
    assert lexical.search(items.where("false"), docs).columns == ["item_id", "rank", "doc_id", "score"]


def test_impacts_beyond_64_bits():
    n, tf = np.array([3_000_000, 10]), np.array([7, 1])
    documents, length = 10**12, 10**15
    expected = [(10**9 * t) // (1000 * t + 20 * (50 + (50 * m * documents) // length)) for t, m in zip([7, 1], [3_000_000, 10])]
    assert lexical.impacts(tf, n, documents, length).tolist() == expected


# SimHash


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                label[top(i)] = top(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[top(i)] = min(key, ids.get(top(i), key))
    return [(key, prints[i], ids.get(top(i))) for i, (key, _) in enumerate(rows)]


def test_fingerprint_of_odd_and_long_texts():
    for text in ("", None, " \n", "One", "a b c d", "Ä B c D é f g", "x " * 300 + "  y", "  a b"):
        assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)
    long = " ".join(f"w{i * i % 977}" for i in range(simhash.PART + 500))
    assert simhash.fingerprint(long) % 2**64 == plain_fingerprint(long) == simhash.fingerprint(long.replace(" ", "\t").upper()) % 2**64


def test_spark_hashes_alike(spark):
    texts = [(t,) for t in ("", "a", "a b c d", "é" * 50, "x" * 33)]
    rows = spark.createDataFrame(texts, "t string").select("t", F.xxhash64("t").alias("h")).collect()
    assert all(r["h"] % 2**64 == xxhash.xxh64_intdigest(r["t"].encode(), 42) for r in rows)


@pytest.mark.parametrize("direct", [1, 64, 1 << 13])
def test_trie_join_equals_all_pairs(monkeypatch, direct):
    monkeypatch.setattr(simhash, "DIRECT", direct)
    monkeypatch.setattr(simhash, "FEW", min(direct, 16))
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    rng = np.random.default_rng(direct)
    for n, same in ((700, True), (500, False), (1, True), (3, False)):
        base = rng.integers(0, 2**64, n // 8 + 1, dtype=np.uint64)
        a = base[rng.integers(0, len(base), n)]
        for _ in range(3):
            a = a ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
        a = np.unique(a)
        b = a if same else np.unique(np.concatenate([a[::3], rng.integers(0, 2**64, n // 2 + 1, dtype=np.uint64)]))
        found = [(i, j) for x, y in simhash.near(a, b, 4, same) for i, j in zip(x.tolist(), y.tolist())]
        close = np.bitwise_count(a[:, None] ^ b[None, :]) <= 4
        assert len(found) == len(set(found))
        assert set(found) == {(i, j) for i, j in zip(*map(list, np.nonzero(close))) if not same or i < j}


def test_upper_levels_are_all_near_prefixes(spark):
    found = {tuple(r) for r in simhash.node_pairs(spark.range(1), 7, 4).collect()}
    assert found == {(x, y) for x in range(128) for y in range(x, 128) if (x ^ y).bit_count() <= 4}


def near_texts(seed, groups):
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(2, 260))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = f"X{rng.randrange(9)}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts + [None, "", " \n", "one", "ONE", "one two", "A b\tc", "a b c", "é É", "é é"]


@pytest.mark.parametrize(("block", "least"), [(1 << 20, 1 << 12), (16, 4), (3, 1)])
def test_components_equal_all_pairs(spark, monkeypatch, block, least):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "LEAST", least)
    texts = near_texts(block, 40)
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "only null ids"), (None, "only null ids")]
    rows += [rows[3]] * 30
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).withColumn("fp", F.lit("x")).withColumn("label", F.lit(1))
    found = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.components(frame).collect()]
    assert sorted(found, key=repr) == sorted(plain_components(rows), key=repr)


def test_components_of_nothing(spark):
    assert simhash.components(spark.createDataFrame([], DOCS)).collect() == []


def test_query_equals_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    found = [tuple(r) for r in QUERIES["op13_simhash_duplicates"](spark, str(TESTDATA)).collect()]
    assert sorted(found) == sorted((key, f"{fp:016x}", top) for key, fp, top in plain_components(docs))
