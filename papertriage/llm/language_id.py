"""Language identification with a bidirectional gated recurrent network on bytes.

Two gated recurrent layers read a chunk's bytes forwards and backwards; every
position gets a distribution over the languages from both states, and a
document's distribution is the mean over its positions. The network is trained
in numpy by backpropagation through time on windows of a bounded sample of
labelled rows. Gates and states use piecewise linear activations (hard sigmoid
and hard tanh), which numpy evaluates about ten times as fast as exponentials.

Prediction is one narrow pass: whole texts are cut into chunks, chunks of many
documents run side by side, and only sums per document are kept, so a worker's
memory does not grow with a document's length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, slices, texts

UNDETERMINED = "und"
HIDDEN = 12
CHUNK = 128  # bytes that a state is carried over
BLOCK = 2048  # chunks that run side by side
# bounds of the training sample: about so many documents of each language and
# of all together, windows of CHUNK bytes from each document. Every language is
# learned; where there are very many, each has fewer documents.
SAMPLE_DOCS, SAMPLE_TOTAL, SAMPLE_WINDOWS = 300, 20_000, 4
STEPS, BATCH, RATE, SEED = 100, 256, 0.02, 7
PAD = 256  # a padding position holds the state
_LETTER = regex.compile(r"\p{L}")  # number signs such as one half are none


def _hard_sigmoid(x: np.ndarray) -> None:
    x *= 0.25
    x += 0.5
    np.clip(x, 0.0, 1.0, out=x)


@dataclass
class Direction:
    """Parameters of one reading direction; rows of ``e*`` belong to bytes."""

    ez: np.ndarray
    er: np.ndarray
    en: np.ndarray
    uz: np.ndarray
    ur: np.ndarray
    un: np.ndarray
    w: np.ndarray

    @staticmethod
    def fresh(rng: np.random.Generator, hidden: int, langs: int) -> "Direction":
        def m(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        d = Direction(
            *(m(PAD + 1, hidden, scale=0.5) for _ in range(3)),
            *(m(hidden, hidden, scale=hidden**-0.5) for _ in range(3)),
            m(hidden, langs, scale=hidden**-0.5),
        )
        d.hold_padding()
        return d

    def hold_padding(self) -> None:
        self.ez[PAD], self.er[PAD], self.en[PAD] = 64.0, 0.0, 0.0

    def all(self) -> list[np.ndarray]:
        return [self.ez, self.er, self.en, self.uz, self.ur, self.un, self.w]


def _states(d: Direction, x: np.ndarray) -> Iterator[np.ndarray]:
    """The state after each row of ``x`` (positions, chunks); one buffer is reused."""
    n, hidden = x.shape[1], d.uz.shape[0]
    h, z, r, c, t = (np.zeros((n, hidden), np.float32) for _ in range(5))
    for row in x:
        np.matmul(h, d.uz, out=z)
        np.take(d.ez, row, axis=0, out=t, mode="clip")
        z += t
        _hard_sigmoid(z)
        np.matmul(h, d.ur, out=r)
        np.take(d.er, row, axis=0, out=t, mode="clip")
        r += t
        _hard_sigmoid(r)
        r *= h
        np.matmul(r, d.un, out=c)
        np.take(d.en, row, axis=0, out=t, mode="clip")
        c += t
        np.clip(c, -1.0, 1.0, out=c)
        h -= c
        h *= z
        h += c
        yield h


@dataclass
class Model:
    langs: list[str]
    forward: Direction | None = None
    backward: Direction | None = None
    bias: np.ndarray | None = None

    def position_probabilities(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(position, probabilities (languages, chunks)), last position first."""
        ahead = np.empty((len(x), len(self.langs), x.shape[1]), np.float32)
        for i, h in enumerate(_states(self.forward, x)):
            np.matmul(self.forward.w.T, h.T, out=ahead[i])
        for i, h in zip(range(len(x) - 1, -1, -1), _states(self.backward, x[::-1])):
            p = ahead[i]
            p += self.backward.w.T @ h.T
            p += self.bias[:, None]
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            yield i, p

    def label_positions(self, text: str) -> list[str]:
        """The most probable language at each byte of the UTF-8 text."""
        if not self.langs or not text:
            return []
        x = to_chunks([text.encode("utf-8")])[0]
        best = np.empty(x.shape, np.int64)
        for i, p in self.position_probabilities(x.T):
            best[:, i] = p.argmax(axis=0)
        return [self.langs[k] for k in best.ravel()[: len(text.encode("utf-8"))]]

    def document_probabilities(self, data: list[bytes]) -> np.ndarray:
        """Mean distribution over the positions of each (not empty) text."""
        chunks, owner = to_chunks(data)
        total = np.zeros((len(data), len(self.langs)))
        for at in range(0, len(chunks), BLOCK):
            part = chunks[at : at + BLOCK]
            x = np.ascontiguousarray(part.T, dtype=np.intp)
            real = (x != PAD).astype(np.float32)
            sums = np.zeros((len(self.langs), len(part)), np.float32)
            for i, p in self.position_probabilities(x):
                p *= real[i]
                sums += p
            np.add.at(total, owner[at : at + BLOCK], sums.T.astype(np.float64))
        return total / total.sum(axis=1, keepdims=True)


def to_chunks(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(chunks of CHUNK byte values padded with PAD, index of the text of each)."""
    n = np.array([-(-len(b) // CHUNK) for b in data], np.int64)
    out = np.full((int(n.sum()), CHUNK), PAD, np.int16)
    at = 0
    for b, k in zip(data, n):
        out[at : at + k].reshape(-1)[: len(b)] = np.frombuffer(b, np.uint8)
        at += k
    return out, np.repeat(np.arange(len(data)), n)


# ---- training --------------------------------------------------------------


def _run_kept(d: Direction, x: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """All steps' (h before, z, r, c, h after, open z, open r, open c)."""
    h = np.zeros((x.shape[1], d.uz.shape[0]), np.float32)
    out = []
    for row in x:
        az = 0.25 * (d.ez[row] + h @ d.uz) + 0.5
        ar = 0.25 * (d.er[row] + h @ d.ur) + 0.5
        z, r = np.clip(az, 0, 1), np.clip(ar, 0, 1)
        ac = d.en[row] + (r * h) @ d.un
        c = np.clip(ac, -1, 1)
        new = c + z * (h - c)
        out.append((h, z, r, c, new, az == z, ar == r, ac == c))
        h = new
    return out


def _back(d: Direction, x: np.ndarray, steps: list[tuple[np.ndarray, ...]], g_states: np.ndarray) -> list[np.ndarray]:
    """Gradients of all parameters but ``w``, by backpropagation through time."""
    g = [np.zeros_like(p) for p in d.all()]
    gh = np.zeros_like(steps[0][0])
    for i in range(len(x) - 1, -1, -1):
        h, z, r, c, _, oz, orr, oc = steps[i]
        gh = gh + g_states[i]
        gc = gh * (1 - z) * oc
        gz = 0.25 * gh * (h - c) * oz
        grh = gc @ d.un.T
        gr = 0.25 * grh * h * orr
        g[5] += (r * h).T @ gc
        g[3] += h.T @ gz
        g[4] += h.T @ gr
        for k, v in ((0, gz), (1, gr), (2, gc)):
            np.add.at(g[k], x[i], v)
        gh = gh * z + grh * r + gz @ d.uz.T + gr @ d.ur.T
    return g


def train(windows: list[tuple[str, bytes]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> Model:
    """Train on (language, window) pairs; the loss is the mean cross entropy
    over all positions of a batch in which languages are equally frequent."""
    windows = sorted((lang, w) for lang, w in windows if w)
    langs = sorted({lang for lang, _ in windows})
    model = Model(langs)
    if not langs:
        return model
    rng = np.random.default_rng(seed)
    model.forward, model.backward = (Direction.fresh(rng, hidden, len(langs)) for _ in range(2))
    model.bias = np.zeros(len(langs), np.float32)
    chunks, owner = to_chunks([w for _, w in windows])
    y = np.array([langs.index(lang) for lang, _ in windows])[owner]
    of_lang = [np.flatnonzero(y == k) for k in range(len(langs))]
    params = [*model.forward.all(), *model.backward.all(), model.bias]
    m1, m2 = ([np.zeros_like(p) for p in params] for _ in range(2))
    span = 64
    for step in range(1, steps + 1):
        pick = np.array([rng.choice(of_lang[k]) for k in np.arange(batch) % len(langs)])
        start = int(rng.integers(0, CHUNK - span + 1))
        x = chunks[pick, start : start + span].T.astype(np.intp)
        real = (x != PAD).astype(np.float32)
        f = _run_kept(model.forward, x)
        b = _run_kept(model.backward, x[::-1])
        hf = np.stack([s[4] for s in f])
        hb = np.stack([s[4] for s in b])[::-1]
        logits = hf @ model.forward.w + hb @ model.backward.w + model.bias
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(batch), y[pick]] -= 1.0
        p *= real[:, :, None] / max(real.sum(), 1.0)
        gf = _back(model.forward, x, f, p @ model.forward.w.T)
        gb = _back(model.backward, x[::-1], b, (p @ model.backward.w.T)[::-1])
        gf[6] = np.einsum("tbh,tbk->hk", hf, p, optimize=True)
        gb[6] = np.einsum("tbh,tbk->hk", hb, p, optimize=True)
        grads = [*gf, *gb, p.sum(axis=(0, 1))]
        norm = np.sqrt(sum(float((v * v).sum()) for v in grads))
        shrink = min(1.0, 1.0 / (norm + 1e-12))
        now = rate * (1.0 - 0.9 * step / steps)
        for k, v in enumerate(grads):
            v = v * shrink
            m1[k] = 0.9 * m1[k] + 0.1 * v
            m2[k] = 0.99 * m2[k] + 0.01 * v * v
            params[k] -= (now * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        model.forward.hold_padding()
        model.backward.hold_padding()
    return model


# ---- Spark -----------------------------------------------------------------


def fold(id_col: Column) -> Column:
    """crc32 of the identifier's text modulo 4; null for a null identifier."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4


def _cut_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        lang, data = [], []
        for k, t in zip(b.column("lang").to_pylist(), texts(b, "text")):
            raw = t.encode("utf-8")
            n = min(SAMPLE_WINDOWS, -(-len(raw) // CHUNK))
            for i in range(n):  # spread evenly over the whole text
                at = i * max(0, len(raw) - CHUNK) // max(1, n - 1)
                lang.append(k)
                data.append(raw[at : at + CHUNK])
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(data, pa.binary())], names=["lang", "data"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on a bounded sample of the rows whose fold is not 2.

    About ``SAMPLE_DOCS`` documents of each language, and ``SAMPLE_TOTAL`` of
    all (one of each at least), give ``SAMPLE_WINDOWS`` windows each: about
    10 MB on the driver, whatever the table's size. Rows are chosen by a hash
    of the identifier.
    """
    sample = _sampled(docs, id_col, text_col, lang_col).mapInArrow(_cut_windows, "lang string, data binary")
    # in order, so that the same sample gives the same network
    return train(sorted((r["lang"], bytes(r["data"])) for r in sample.collect()))


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str, held_out: bool) -> DataFrame:
    """All labelled rows (id, text, lang) inside or outside of the held-out fold."""
    rows = bound_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return rows.where((F.coalesce(fold(F.col("id")) == 2, F.lit(False)) == held_out) & F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())


def _sampled(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The bounded sample (lang, text) of labelled rows outside of the held-out fold."""
    rows = _labelled(docs, id_col, text_col, lang_col, False)
    # one row a language: more of them than the sample has documents is an error
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size")).limit(SAMPLE_TOTAL + 1).collect()
    if len(sizes) > SAMPLE_TOTAL:
        raise ValueError(f"more than {SAMPLE_TOTAL} languages: raise SAMPLE_TOTAL")
    part = 1 << 20
    wanted = max(1, min(SAMPLE_DOCS, SAMPLE_TOTAL // max(1, len(sizes))))
    limits = docs.sparkSession.createDataFrame([(r["lang"], part * wanted // r["size"] + 1) for r in sizes], "lang string, least long")
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(SEED)), F.lit(part))
    return rows.join(F.broadcast(limits), "lang").where(draw < F.col("least")).select("lang", "text")


def predict(model: Model, batch_texts: list[str]) -> list[tuple[str, float]]:
    """(language, score) per text; ``und`` and 0 where there is no letter."""
    out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(batch_texts)
    with_letter = [i for i, t in enumerate(batch_texts) if model.langs and _LETTER.search(t)]
    if with_letter:
        # rounded, so that a text's result does not depend on its neighbours in a batch
        p = np.round(model.document_probabilities([batch_texts[i].encode("utf-8") for i in with_letter]), 4)
        for i, k, s in zip(with_letter, p.argmax(axis=1), p.max(axis=1)):
            out[i] = (model.langs[k], min(1.0, float(s)))
    return out


_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _predictor(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            lang, score = zip(*predict(model, texts(b, "text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], schema=_ARROW)

    return run


def identify_languages(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Without ``model`` one is fitted first. Null texts and texts without a
    letter are ``und`` with score 0, as is everything when no labelled row was
    there to learn from; equal probabilities go to the language first in
    order. A null identifier is not held out and never learned from; repeated
    rows are predicted each. An empty table gives no rows; other columns are
    not read.
    """
    model = fit(docs, id_col, text_col, lang_col) if model is None else model
    rows = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(F.col(id_col)) == 2, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predictor(model), "doc_id long, held_out boolean, lang_pred string, score double")


def rejection_level(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> float:
    """The score under which a text counts as being in no known language: half
    way from chance (one over the number of languages) to the lowest score of
    a rightly predicted text among all labelled held-out rows; without such
    rows a fifth above chance."""
    if len(model.langs) < 2:
        return 0.0
    chance = 1 / len(model.langs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = predict(model, texts(b, "text"))
            right = [s for (k, s), want in zip(found, b.column("lang").to_pylist()) if k == want]
            yield pa.RecordBatch.from_arrays([pa.array(right, pa.float64())], names=["score"])

    lowest = _labelled(docs, id_col, text_col, lang_col, True).mapInArrow(run, "score double").agg(F.min("score")).first()[0]
    return 1.2 * chance if lowest is None else chance + (lowest - chance) / 2


def keep_identified(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float | None = None) -> DataFrame:
    """The rows of ``docs`` in a recognised language, with all their columns:
    ``und`` goes (null, empty and letterless texts), and so do texts whose best
    language has under ``min_score`` (None: ``rejection_level``; a score at the
    level stays). Repeated rows share their fate; where nothing could be
    learned everything is ``und`` and goes; an empty table stays empty."""
    model = fit(docs, id_col, text_col, lang_col) if model is None else model
    level = rejection_level(docs, model, id_col, text_col, lang_col) if min_score is None else min_score

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            keep = [lang != UNDETERMINED and score >= level for lang, score in predict(model, texts(b, text_col))]
            yield b.filter(pa.array(keep, pa.bool_()))

    return bound_batches(docs).mapInArrow(run, docs.schema)
