"""Block x block scoring: papers against a reference set of any size.

Both sides are filed as numbered matrix blocks of at most ``block_bytes`` in
the shared scratch folder. A grid of cells pairs them: a cell holds the
reference blocks of one group (at most ``cell_bytes``) and a share of the paper
blocks, which stream past them one at a time, so a task's memory has a bound
that neither side's size changes. Papers are sent once per reference group and
references once per paper share; no pair becomes a row and no reference reaches
the driver.

A cell gives one mergeable state per paper *row*: sum and count of its
similarities and the ``top_k`` largest. The states of a row's reference groups
are combined in a tree of ``FAN_IN``; the rules are applied to what is left.
Rows are told apart by a key of their own, so repeated paper ids, repeated or
null reference ids and rows without an embedding are fine.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TriageConfig
from ..functions import vectors as V
from ..session import scratch_path
from .score import BLOCK_ELEMS, _dense_rows, relevance_rules, top_k_ascending

BLOCK_BYTES = 4 * 1024 * 1024
CELL_BYTES = 64 * 1024 * 1024
FAN_IN = 16
ROW = "_row"

_BLOCK = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("dim", pa.int32()), ("keys", pa.list_(pa.int64())), ("matrix", pa.binary())])
_BLOCK_DDL = "part int, seq long, dim int, keys array<long>, matrix binary"


def _one_row(values: tuple, schema: pa.Schema) -> pa.RecordBatch:
    as_column = lambda v, f: pa.ListArray.from_arrays([0, len(v)], v) if isinstance(v, pa.Array) else pa.array([v], f.type)
    return pa.RecordBatch.from_arrays([as_column(v, f) for v, f in zip(values, schema)], schema=schema)


def _filer(block_bytes: int):
    """Unit rows (key, embedding) as blocks, numbered within each partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            emb = b.column("embedding")
            sizes = emb.value_lengths().drop_null().unique().to_pylist()
            if len(sizes) > 1:
                raise ValueError(f"embeddings of {sorted(sizes)} values in one table")
            valid, dense = _dense_rows(emb, sizes[0] if sizes else 0)
            keys = b.column("key").filter(pa.array(valid))
            dense = dense / np.maximum(np.linalg.norm(dense, axis=1), V.NORM_EPS)[:, None]
            dim = dense.shape[1]
            step = max(1, block_bytes // (8 * max(dim, 1)))
            for at in range(0, len(keys), step):
                out = part, seq, dim, keys.slice(at, step), dense[at : at + step].tobytes()
                yield _one_row(out, _BLOCK)
                seq += 1

    return run


def _landed(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_blocks(rows: DataFrame, key_col: str, emb_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Matrix blocks of the rows that have an embedding, written to the scratch
    folder, so that a block keeps its number when a task runs again."""
    plain = rows.select(F.col(key_col).cast("long").alias("key"), F.col(emb_col).cast("array<double>").alias("embedding"))
    return _landed(plain.mapInArrow(_filer(block_bytes), _BLOCK_DDL), "blocks")


def _dimension(*sides: DataFrame) -> int:
    dims = sorted({d for s in sides for (d,) in s.select("dim").distinct().limit(2).collect()})
    if len(dims) > 1:
        raise ValueError(f"embeddings of {dims} values cannot be compared")
    return dims[0] if dims else 0


def _cells(papers: DataFrame, refs: DataFrame, block_bytes: int, cell_bytes: int) -> tuple[DataFrame, int]:
    """Both sides' blocks dealt to cells (g, h), references first in each.
    Returns the dealt blocks and the number of reference groups."""
    spark = papers.sparkSession
    # whole blocks of one partition make a group, so its size has a hard bound
    held = max(1, cell_bytes // block_bytes)
    group = F.floor(F.col("seq") / held)
    parts, subs = refs.agg(F.max("part"), F.max(group)).first()
    parts, subs = (parts or 0) + 1, int(subs or 0) + 1
    n_h = parts * subs
    bytes_p = papers.agg(F.sum(F.octet_length("matrix"))).first()[0] or 0
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_g = max(1, -(-bytes_p // cell_bytes), -(-shuffled // n_h))
    side = lambda df, s, g, h: df.select(g.alias("g"), h.alias("h"), F.lit(s).alias("side"), "part", "seq", "dim", "keys", "matrix")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    sent = side(refs, 0, every(n_g), (F.col("part") + parts * group).cast("long"))
    streamed = side(papers, 1, F.pmod(F.xxhash64("part", "seq"), F.lit(n_g)).cast("long"), every(n_h))
    n = max(shuffled, -(-n_g * n_h // 4))
    return sent.union(streamed).repartition(n, "g", "h").sortWithinPartitions("g", "h", "side", "part", "seq"), n_h


def _paired(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, list[tuple[pa.Array, np.ndarray]]]]:
    """Each paper block of a cell with the cell's reference blocks (keys, matrix)."""
    at, refs = None, []
    for b in batches:
        for i in range(b.num_rows):
            r = {c: b.column(c)[i].as_py() for c in ("g", "h", "side", "part", "seq", "dim")}
            if at != (r["g"], r["h"]):
                at, refs = (r["g"], r["h"]), []
            keys = b.column("keys")[i].values
            matrix = np.frombuffer(b.column("matrix")[i].as_buffer(), np.float64).reshape(len(keys), r["dim"])
            if r["side"] == 0:
                refs.append((keys, matrix.copy()))
            elif refs:
                yield r | {"keys": keys}, matrix, refs


_STATE = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("h", pa.int64()), ("n_ref", pa.int64()), ("keys", pa.list_(pa.int64())), ("sums", pa.binary()), ("top", pa.binary())])
_STATE_DDL = "part int, seq long, h long, n_ref long, keys array<long>, sums binary, top binary"


def _state_batch(part: int, seq: int, h: int, n_ref: int, keys: pa.Array, sums: np.ndarray, top: np.ndarray) -> pa.RecordBatch:
    return _one_row((part, seq, h, n_ref, keys, sums.tobytes(), np.ascontiguousarray(top).tobytes()), _STATE)


def _best(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    return top_k_ascending(np.concatenate([a, b], axis=1), k)


def _scorer(k: int, strict_float32: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, papers, refs in _paired(batches):
            sums, top = np.zeros(len(papers)), np.empty((len(papers), 0))
            for _, matrix in refs:
                step = max(1, BLOCK_ELEMS // max(1, len(matrix)))
                parts = []
                for at in range(0, len(papers), step):
                    sims = papers[at : at + step] @ matrix.T
                    if strict_float32:
                        sims = sims.astype(np.float32).astype(np.float64)
                    sums[at : at + step] += sims.sum(axis=1)
                    parts.append(top_k_ascending(sims, k))
                top = _best(top, np.concatenate(parts), k)
            yield _state_batch(r["part"], r["seq"], r["h"], sum(len(m) for _, m in refs), r["keys"], sums, top)

    return run


def _merger(k: int):
    """One state per (block, h) of states sorted by it; one is held."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            for i in range(b.num_rows):
                at, n_ref = tuple(b.column(c)[i].as_py() for c in ("part", "seq", "h")), b.column("n_ref")[i].as_py()
                keys = b.column("keys")[i].values
                sums, top = (np.frombuffer(b.column(c)[i].as_buffer(), np.float64) for c in ("sums", "top"))
                top = top.reshape(len(keys), -1)
                if held is not None and held[0] == at:
                    held = at, held[1] + n_ref, keys, held[3] + sums, _best(held[4], top, k)
                    continue
                if held is not None:
                    yield _state_batch(*held[0], *held[1:])
                held = at, n_ref, keys, sums.copy(), top.copy()
        if held is not None:
            yield _state_batch(*held[0], *held[1:])

    return run


def _rows_of(individual: float):
    out = pa.schema([(ROW, pa.int64()), ("mean_similarity", pa.float64()), ("n_top_above", pa.int32()), ("top_sims", pa.list_(pa.float64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                keys = b.column("keys")[i].values
                top = np.frombuffer(b.column("top")[i].as_buffer(), np.float64).reshape(len(keys), -1)
                mean = np.frombuffer(b.column("sums")[i].as_buffer(), np.float64) / b.column("n_ref")[i].as_py()
                with np.errstate(invalid="ignore"):
                    above = (top >= individual).sum(axis=1).astype(np.int32)
                offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * top.shape[1])
                yield pa.RecordBatch.from_arrays([keys, pa.array(mean), pa.array(above), pa.ListArray.from_arrays(offsets, pa.array(top.ravel()))], schema=out)

    return run


def _filed_refs(refs: DataFrame, ref_id_col: str, ref_emb_col: str, block_bytes: int, cell_bytes: int) -> DataFrame:
    """Reference blocks; their keys are the reference ids."""
    rows = refs.select(F.col(ref_id_col).cast("long").alias("ref_id"), F.col(ref_emb_col).alias("embedding"))
    size, missing = rows.agg(F.coalesce(F.sum(F.size("embedding").cast("long") * 8), F.lit(0)), F.count_if(F.col("embedding").isNull())).first()
    if missing:
        raise ValueError("reference rows must have an embedding")
    if not size:
        raise ValueError("empty reference set")
    # even partitions of half a group, so that groups are well filled
    return file_blocks(rows.repartition(max(1, -(-2 * size // cell_bytes))), "ref_id", "embedding", block_bytes)


def with_row_key(papers: DataFrame) -> DataFrame:
    """The papers written once with a key of their own for every row; an
    upstream encoder then runs a single time."""
    return _landed(papers.withColumn(ROW, F.monotonically_increasing_id()), "papers")


def score_blocks(
    papers: DataFrame,
    refs: DataFrame,
    cfg: TriageConfig,
    emb_col: str = "embedding",
    ref_id_col: str = "ref_id",
    ref_emb_col: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """Add ``mean_similarity, n_top_above, top_sims, is_related, reason`` to
    every row of ``papers``, for any number of references; the result equals
    ``score_papers`` (float32 mode sums the float32 similarities in double).

    Rows without an embedding have null scores and are not related. NaN
    similarities count as largest and never pass, as in ``score_papers``.
    """
    filed = with_row_key(papers) if ROW not in papers.columns else papers
    ref_blocks = _filed_refs(refs, ref_id_col, ref_emb_col, block_bytes, cell_bytes)
    blocks = file_blocks(filed, ROW, emb_col, block_bytes)
    _dimension(blocks, ref_blocks)
    dealt, n_h = _cells(blocks, ref_blocks, block_bytes, cell_bytes)
    states = _landed(dealt.mapInArrow(_scorer(cfg.top_k, cfg.strict_float32), _STATE_DDL), "states")
    n = int(papers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while n_h > 1:
        n_h = -(-n_h // FAN_IN)
        nearer = states.withColumn("h", F.floor(F.col("h") / FAN_IN))
        order = ["part", "seq", "h"]
        states = nearer.repartition(n, *order).sortWithinPartitions(*order).mapInArrow(_merger(cfg.top_k), _STATE_DDL)
    threshold = float(np.float32(cfg.individual_sim_threshold)) if cfg.strict_float32 else cfg.individual_sim_threshold
    scores = states.mapInArrow(_rows_of(threshold), f"{ROW} long, mean_similarity double, n_top_above int, top_sims array<double>")
    mean_rule, top_rule = relevance_rules(F.col("mean_similarity"), F.col("n_top_above"), cfg)
    joined = filed.join(scores, ROW, "left").withColumns({"_mean": mean_rule, "_top": top_rule})
    rules = {"is_related": F.col("_mean") | F.col("_top"), "reason": F.when(F.col("_mean"), "mean").when(F.col("_top"), "top_k")}
    return joined.withColumns(rules).drop("_mean", "_top", *([] if ROW in papers.columns else [ROW]))


_PAIR = pa.schema([(ROW, pa.int64()), ("ref_id", pa.int64()), ("similarity", pa.float64())])


def _pairs(strict_float32: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, papers, refs in _paired(batches):
            for ids, matrix in refs:
                step = max(1, (BLOCK_ELEMS >> 4) // max(1, len(matrix)))
                for at in range(0, len(papers), step):
                    sims = papers[at : at + step] @ matrix.T
                    if strict_float32:
                        sims = sims.astype(np.float32).astype(np.float64)
                    rows = np.repeat(r["keys"].slice(at, step).to_numpy(), len(ids))
                    names = ids.take(pa.array(np.tile(np.arange(len(ids)), len(sims))))
                    yield pa.RecordBatch.from_arrays([pa.array(rows), names, pa.array(sims.ravel())], schema=_PAIR)

    return run


def pair_similarities(
    papers: DataFrame,
    refs: DataFrame,
    cfg: TriageConfig,
    emb_col: str = "embedding",
    ref_id_col: str = "ref_id",
    ref_emb_col: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """Long form ``(_row, ref_id, similarity)`` of ``papers`` (with a ``_row``
    key, ``with_row_key``): for the few rows whose similarities are shown."""
    ref_blocks = _filed_refs(refs, ref_id_col, ref_emb_col, block_bytes, cell_bytes)
    blocks = file_blocks(papers, ROW, emb_col, block_bytes)
    _dimension(blocks, ref_blocks)
    dealt, _ = _cells(blocks, ref_blocks, block_bytes, cell_bytes)
    return dealt.mapInArrow(_pairs(cfg.strict_float32), f"{ROW} long, ref_id long, similarity double")


def related_detail(related: DataFrame, refs: DataFrame, cfg: TriageConfig, title_col: str = "title", **blocks) -> DataFrame:
    """Add ``detail``: the row's references by similarity descending, reference
    id ascending, as ``struct<ref_id, similarity, ref_title>``. Only related
    rows are paired; a row's detail is as long as the reference set, which is
    what the JSON output shows."""
    pairs = pair_similarities(related, refs, cfg, **blocks)
    titles = refs.select(F.col("ref_id"), F.col(title_col).alias("ref_title"))
    entry = F.struct((-F.col("similarity")).alias("key"), "ref_id", "ref_title", "similarity")
    packed = pairs.join(titles, "ref_id").groupBy(ROW).agg(F.sort_array(F.collect_list(entry)).alias("_detail"))
    shown = F.transform("_detail", lambda e: F.struct(e["ref_id"].alias("ref_id"), e["similarity"].alias("similarity"), e["ref_title"].alias("ref_title")))
    return related.join(packed, ROW, "left").withColumn("detail", shown).drop("_detail")
