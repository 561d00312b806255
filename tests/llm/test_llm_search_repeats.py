"""Lexical search and repeated substrings against plain versions."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from papertriage.llm import lexical_search as L
from papertriage.llm import suffix_dedup as S

# ---- lexical search ------------------------------------------------------------


def words(text):
    return [w for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]


def rank_plainly(docs, items, k=10):
    vectors = [(i, collections.Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    n, length = len(vectors), sum(x[2] for x in vectors)
    df = collections.Counter(t for _, tf, _ in vectors for t in tf)
    out = []
    for item, text in items:
        terms = {t for t in words(text) if t in df}
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in terms}
        rows = [(-sum(w[t] * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * (10 + 90 * m * n // length))) for t in terms if t in tf), i is None, i or 0, i) for i, tf, m in vectors]
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(x[:3] + (x[3],) for x in rows if x[0] < 0)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("leaf,chunk,block", [(2, 7, 60), (48, 4096, 1 << 18)])
def test_search_equals_full_scoring(spark, monkeypatch, leaf, chunk, block):
    monkeypatch.setattr(L, "LEAF_DOCS", leaf)
    monkeypatch.setattr(L, "CHUNK_DOCS", chunk)
    rng = random.Random(leaf)
    vocabulary = [f"W{i}é" for i in range(30)] + ["漢字", "½x", "a-b", "A1"]
    text = lambda n: " ".join(rng.choice(vocabulary[: rng.choice([3, 12, 34])]) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 40))) for i in range(150)] + [(200 + i, "W1é W2é w3é") for i in range(30)]
    docs += [(None, "w1é w5é"), (7, None), (8, ""), (9, "..."), (5, "W1é W2é w3é"), (10, "w4é " * 5000)]
    items = [(i, text(8)) for i in range(12)] + [(3, "nowhere"), (4, None), (None, "w4é 漢字"), (5, "w1é w2é"), (5, "w1é w2é")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("item", "score", "rank", "n", "terms")}).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("x"))
    got = sorted((tuple(r) for r in L.search_documents(df, bench, block_bytes=block).select("item_id", "rank", "doc_id", "score").collect()), key=repr)
    assert got == rank_plainly(docs, sorted(set(items), key=repr))


def test_bounds_are_never_below_scores_and_prune():
    rng = np.random.default_rng(3)
    paths = []
    for _ in range(900):
        ranks = np.unique(rng.integers(0, 60, rng.integers(1, 20)) ** 2 // 60)
        paths.append(L.Path(ranks, rng.integers(1, 9, len(ranks)), int(rng.integers(10, 400)), [len(paths)]))
    tree = L.FpTree(paths, 60)
    for _ in range(30):
        ranks = np.unique(rng.integers(0, 60, 6))
        w = rng.integers(0, 5000, len(ranks))
        score = lambda p: int(sum(x * ((10**9 * f) // (1000 * f + 8 * p.m)) for r, x in zip(ranks, w) for q, f in zip(p.ranks, p.tfs) if q == r))
        scores = [score(p) for p in tree.paths]
        bound = tree.bounds(ranks, w)
        assert all(max(scores[a:b]) <= bound[v] for v, (a, b) in enumerate(zip(tree.low, tree.high)))
        best = L.Best(5)
        seen = tree.search(ranks, w, best)
        assert sorted(-s for s, _ in best.rows) == sorted(-s for s in scores if s > 0)[: len(best.rows)] and seen <= len(paths)


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert L.search_documents(none, items).collect() == [] and L.search_documents(some, items.where("false")).collect() == []


# ---- repeated substrings -------------------------------------------------------


def repeats_plainly(texts):
    data = [(t or "").encode() for t in texts]
    met = collections.Counter(d[p : p + 200] for d in data for p in range(len(d) - 199))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - 199):
            if met[d[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    rng = random.Random(4)
    letters = lambda n, of="abcdefgh é\n": "".join(rng.choice(of) for _ in range(n))
    shared = [letters(n) for n in (199, 200, 201, 260, 900)]
    out = [letters(rng.randrange(50)) + rng.choice(shared) + letters(rng.randrange(400)) + rng.choice(shared)[rng.randrange(60) :] for _ in range(80)]
    out += ["x" * 199, "x" * 200, "y" * 450, "ab" * 300, None, "", out[0], out[0], letters(700, "z "), shared[4][:500], shared[4][300:]]
    return out


@pytest.mark.parametrize("group_runs", [1, 50_000])
def test_repeats_equal_brute_force(spark, monkeypatch, group_runs):
    texts = repeat_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit("x") for c in ("key", "core", "run", "n", "packed", "marks", "chosen")})
    out = S.remove_repeats(df.repartition(3), group_runs=group_runs).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in out] == repeats_plainly(texts)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and sum(r["spans"][1::2]) - sum(r["spans"][::2]) == r["n_removed"] for r in out)


def test_long_texts_are_parsed_in_pieces(monkeypatch):
    monkeypatch.setattr(S, "BUFFER", 2048)
    rng = random.Random(9)
    text = "".join(rng.choice("abcd") for _ in range(9000))
    import pyarrow as pa

    b = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
    seen = []
    for out in S._runs(False)([b]):
        for place in out.column("place").to_pylist():
            lo, span = place >> 16, place >> 8 & 255
            seen += range(lo, lo + span + 1)
    assert sorted(seen) == list(range(9000 - 199))


def test_repeats_of_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
