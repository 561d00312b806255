import hashlib

import numpy as np
from pyspark.sql import functions as F

from papertriage.functions.text import normalize_text
from papertriage.operators import encode as EN


def hashing_encoder(dim=EN.HASH_DIM):
    """The hashing encoder as a batch encoder over normalised texts."""

    def make():
        def enc(texts):
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for i, t in enumerate(texts):
                for tok in filter(None, t.split(" ")):
                    out[i, int(hashlib.md5(tok.encode("utf-8")).hexdigest()[:4], 16) % dim] += 1
            return out

        return enc

    return make


def test_hashing_jvm_path_equals_python_encoder(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    jvm = EN.hashing_embedding(docs, "text").select("doc_id", "embedding")
    normalised = docs.select("doc_id", normalize_text("text").alias("t"))
    py = normalised.select("doc_id", EN.encode_with("t", hashing_encoder(), batch_size=64).alias("embedding"))
    a = {r["doc_id"]: np.array(r["embedding"]) for r in jvm.collect()}
    b = {r["doc_id"]: np.array(r["embedding"]) for r in py.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert np.allclose(a[k], b[k], atol=1e-6)
        assert abs(np.linalg.norm(a[k]) - 1) < 1e-5


def test_encode_with_custom_model_and_nulls(spark):
    def make():
        def enc(texts):
            return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

        return enc

    df = spark.createDataFrame([("abc",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(EN.encode_with("t", make, batch_size=2)).collect()]
    assert got[1] is None
    assert np.allclose(got[0], np.array([3, 1]) / np.sqrt(10), atol=1e-6)
    assert np.allclose(got[2], [0, 1])


def test_histogram_counts(spark):
    df = spark.createDataFrame([([0, 1, 1, 63],), ([],), (None,)], "b array<int>")
    got = [r[0] for r in df.select(EN.hashing_counts("b")).collect()]
    assert got[0][:2] == [1, 2] and got[0][63] == 1 and sum(got[0]) == 4
    assert got[1] == [0] * 64 and got[2] is None


def test_batches_keep_row_order_and_bounds(spark):
    rng = np.random.default_rng(5)
    sizes = np.concatenate([rng.integers(0, 400, 300), [1_000_000, 1_000_000, 3]])
    plan = EN.plan_batches(sizes, 64, 20_000)
    assert sorted(np.concatenate(plan).tolist()) == list(range(len(sizes)))
    assert all(len(b) <= 64 and (len(b) == 1 or len(b) * sizes[b].max() <= 20_000) for b in plan)
    in_order = [np.arange(i, min(i + 64, 300)) for i in range(0, 300, 64)]
    assert EN.padded_share(sizes[:300], EN.plan_batches(sizes[:300], 64, 20_000)) < EN.padded_share(sizes[:300], in_order) / 3
    assert EN.plan_batches(np.empty(0, np.int64), 64) == []
    texts = [(i, "x" * int(n) if i % 9 else None) for i, n in enumerate(sizes[:300])] + [(900, "y" * 1_000_000)]
    df = spark.createDataFrame(texts, "id long, text string").repartition(2)

    def lengths():
        return lambda batch: np.array([[len(t), 1.0] for t in batch])

    got = {r["id"]: r["v"] for r in df.select("id", EN.encode_with("text", lengths, 16, 5_000).alias("v")).collect()}
    for i, t in texts:
        want = None if t is None else np.array([len(t), 1.0]) / np.hypot(len(t), 1.0)
        assert got[i] is None if want is None else np.allclose(got[i], want, atol=1e-6)
