"""Text encoders.

* ``encode_with``: the pluggable path. A user-supplied batch encoder
  (``list[str] -> float[n, d]``, e.g. a sentence-embedding model) runs inside
  an Iterator pandas UDF, so it is built once per Python worker and sees
  batches of ``batch_size`` texts; the output is L2-normalised ``array<float>``.
* ``hashing_counts`` / ``hashing_embedding``: the shipped default, a lexical
  feature-hashing encoder that needs no model: tokens of the normalised text
  (split on single spaces) are hashed in the JVM (``md5``, first four hex
  digits, modulo ``dim``) and one numpy ``bincount`` per Arrow batch turns the
  bucket lists into count vectors. It is lexical, not semantic: thresholds
  tuned for a neural encoder do not carry over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..functions import vectors as V

HASH_DIM = 64


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def token_buckets(text: Column | str, dim: int = HASH_DIM, normalise: bool = True) -> Column:
    """``array<int>``: one bucket per token, in the JVM."""
    t = TX.normalize_text(text) if normalise else _c(text)
    tokens = F.filter(F.split(t, " ", -1), lambda s: s != "")
    return F.transform(
        tokens, lambda s: F.pmod(F.conv(F.substring(F.md5(s), 1, 4), 16, 10).cast("int"), F.lit(dim))
    )


def hashing_counts(buckets: Column | str, dim: int = HASH_DIM) -> Column:
    """``array<int>`` of length ``dim``: bucket histogram per row."""

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def histogram(col: pa.Array) -> pa.Array:
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        n = len(col)
        lengths = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.repeat(np.arange(n, dtype=np.int64), lengths)
        counts = np.bincount(rows * dim + flat, minlength=n * dim).astype(np.int32)
        offsets = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32))
        null = ~np.asarray(col.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
        return pa.ListArray.from_arrays(offsets, pa.array(counts), mask=pa.array(null))

    return histogram.asNondeterministic()(_c(buckets))  # see score.similarity_struct


def hashing_embedding(df, text: str, out: str = "embedding", dim: int = HASH_DIM):
    """J1 default: add unit-norm ``array<float>`` ``out`` from the token
    histogram (the UDF result becomes a column before any lambda uses it)."""
    counts = df.withColumn("_counts", hashing_counts(token_buckets(text, dim), dim))
    return counts.withColumn(out, F.transform(V.l2_normalize("_counts"), lambda x: x.cast("float"))).drop("_counts")


# Bytes of one encoder batch, every text counted as long as its longest one.
BATCH_BYTES = 1 << 20


def plan_batches(sizes: np.ndarray, batch_size: int, batch_bytes: int = BATCH_BYTES) -> list[np.ndarray]:
    """Rows by size, cut into batches of at most ``batch_size`` rows whose
    padded size (rows times the longest) is at most ``batch_bytes``; a longer
    text is a batch by itself. Texts of one batch are of similar size, so
    little of what an encoder pads is wasted."""
    order = np.argsort(sizes, kind="stable")
    out, start = [], 0
    for i in range(1, len(order) + 1):
        if i == len(order) or i - start == batch_size or (i - start + 1) * int(sizes[order[i]]) > batch_bytes:
            out.append(order[start:i])
            start = i
    return out


def padded_share(sizes: np.ndarray, batches: list[np.ndarray]) -> float:
    """Share of padding in what an encoder is given in these batches."""
    given = sum(len(b) * int(sizes[b].max()) for b in batches)
    return 1 - float(sizes.sum()) / given if given else 0.0


def encode_with(
    text: Column | str,
    make_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int = 64,
    batch_bytes: int = BATCH_BYTES,
) -> Column:
    """Run a batch encoder over texts; ``make_encoder`` is called once per
    worker (load the model there). Texts of similar length are encoded at most
    ``batch_size`` at a time and within ``batch_bytes`` (``plan_batches``); the
    vectors come back in row order (E9)."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = make_encoder()
        for s in batches:
            texts = s.fillna("").tolist()
            rows = plan_batches(np.array([len(t.encode("utf-8")) for t in texts], np.int64), batch_size, batch_bytes)
            parts = [np.asarray(enc([texts[i] for i in b]), dtype=np.float32) for b in rows]
            mat = np.concatenate(parts, axis=0) if parts else np.zeros((0, 0), np.float32)
            if parts:
                mat = mat[np.argsort(np.concatenate(rows))]
            norms = np.maximum(np.linalg.norm(mat, axis=1, keepdims=True), V.NORM_EPS)
            mat = (mat / norms).astype(np.float32)
            out = pd.Series(list(mat))
            out[s.isna().to_numpy()] = None
            yield out

    return encode.asNondeterministic()(_c(text))  # see score.similarity_struct


Encoder = Callable[[], Callable[[list[str]], np.ndarray]]


def embed_papers(papers: DataFrame, encoder: Encoder | None = None, batch_size: int = 64) -> DataFrame:
    """Add ``embedding``: the encoded prompt of normalised title and abstract.
    Without ``encoder`` the hashing encoder is used."""
    prompt = TX.prompt_text(TX.normalize_text("title"), TX.normalize_text("abstract"))
    if encoder is None:
        counts = papers.withColumn("_counts", hashing_counts(token_buckets(prompt)))
        return counts.withColumn("embedding", V.l2_normalize("_counts")).drop("_counts")
    return papers.withColumn("embedding", encode_with(prompt, encoder, batch_size))
