"""Paper x reference similarity scoring and the two relevance rules.

Plan shape (single reference chunk, the normal case)::

    scan(embeddings) -> Filter -> ArrowEvalPython(score_batch) -> Project(rules)

No join and no shuffle: the reference matrix is a bounded broadcast (its size
is checked before it is collected), each Arrow batch of papers is multiplied
with it as one ``[b, d] x [d, m]`` numpy product. Reference sets above the
broadcast bound are scored block against block (``operators.blocks``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TriageConfig
from ..functions import vectors as V


class ReferenceSetTooLarge(ValueError):
    pass


@dataclass
class ReferenceSet:
    """A bounded reference matrix: ``ref_ids[i]`` names row ``i``.

    Rows are L2-normalised (cosine = dot product). Rows keep the order of
    ``ref_ids`` ascending, which is the order the similarity arrays use.
    """

    ref_ids: np.ndarray
    titles: list
    matrix: np.ndarray

    @property
    def size(self) -> int:
        return int(self.matrix.shape[0])

    @property
    def dim(self) -> int:
        return int(self.matrix.shape[1]) if self.matrix.ndim == 2 else 0


@dataclass(frozen=True)
class ReferenceStats:
    """What one aggregation knows of a reference table before any row of it
    is fetched."""

    rows: int
    dim: int
    title_bytes: int
    without_embedding: int

    @property
    def n_bytes(self) -> int:
        return self.rows * max(self.dim, 1) * 8 + self.title_bytes


def reference_stats(refs: DataFrame, emb_col: str = "embedding", title_col: str | None = None) -> ReferenceStats:
    titles = F.coalesce(F.sum(F.octet_length(title_col)), F.lit(0)) if title_col else F.lit(0)
    row = refs.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(emb_col)), F.lit(0)), titles, F.count_if(F.col(emb_col).isNull())).first()
    return ReferenceStats(*(max(0, int(x)) for x in row))


def _build_reference_set(rows: list, title_col: str | None, d: int) -> ReferenceSet:
    rows = sorted(rows, key=lambda r: r["ref_id"])
    ids = np.array([r["ref_id"] for r in rows], dtype=np.int64)
    if len(set(ids.tolist())) != len(ids):
        raise ValueError("reference ids must be unique")
    titles = [r["ref_title"] if title_col else None for r in rows]
    if rows:
        mat = np.array([r["embedding"] for r in rows], dtype=np.float64)
        norms = np.maximum(np.linalg.norm(mat, axis=1), V.NORM_EPS)
        mat = mat / norms[:, None]
    else:
        mat = np.zeros((0, d), dtype=np.float64)
    return ReferenceSet(ids, titles, mat)


def collect_reference_set(
    refs: DataFrame,
    id_col: str = "ref_id",
    emb_col: str = "embedding",
    title_col: str | None = None,
    max_bytes: int = TriageConfig.max_reference_bytes,
    stats: ReferenceStats | None = None,
) -> ReferenceSet:
    """Collect a reference table once an aggregation has shown that its
    matrix and titles are at most ``max_bytes``."""
    stats = reference_stats(refs, emb_col, title_col) if stats is None else stats
    if stats.without_embedding:
        raise ValueError(f"{stats.without_embedding} reference rows have no embedding")
    if stats.n_bytes > max_bytes:
        raise ReferenceSetTooLarge(
            f"{stats.rows} x {stats.dim} reference matrix and titles exceed {max_bytes} bytes: score with "
            "operators.blocks.score_blocks, or raise TriageConfig.max_reference_bytes"
        )
    cols = [F.col(id_col).alias("ref_id"), F.col(emb_col).alias("embedding")]
    if title_col:
        cols.append(F.col(title_col).alias("ref_title"))
    return _build_reference_set(refs.select(*cols).collect(), title_col, stats.dim)


SCORE_STRUCT = T.StructType(
    [
        T.StructField("sims", T.ArrayType(T.DoubleType(), False), True),
        T.StructField("mean_similarity", T.DoubleType(), True),
        T.StructField("n_top_above", T.IntegerType(), True),
        T.StructField("top_sims", T.ArrayType(T.DoubleType(), False), True),
    ]
)


def _dense_rows(emb: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(valid mask, [n_valid, dim] float64) from a list<float> Arrow array."""
    if isinstance(emb, pa.ChunkedArray):
        emb = emb.combine_chunks()
    valid = np.asarray(emb.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
    lengths = emb.value_lengths().fill_null(dim).to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != dim).any():
        bad = int(lengths[lengths != dim][0])
        raise ValueError(f"embedding of length {bad}, expected {dim}")
    flat = emb.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return valid, flat.reshape(-1, dim) if dim else flat.reshape(int(valid.sum()), 0)


def score_matrix(
    e: np.ndarray, r: np.ndarray, top_k: int, individual: float, strict_float32: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cosine block product and the per-paper rule inputs.

    Returns (sims [n,m], mean [n], count of top-k at or above the individual
    threshold [n], the top-k values ascending [n, <=k]). NaN sorts last and so
    occupies top-k slots without counting, as ``np.sort`` does.
    """
    norms = np.maximum(np.linalg.norm(e, axis=1), V.NORM_EPS)
    sims = (e / norms[:, None]) @ r.T
    if strict_float32:
        s32 = sims.astype(np.float32)
        mean = s32.mean(axis=1, dtype=np.float32).astype(np.float64) if s32.shape[1] else np.full(len(s32), np.nan)
        top = top_k_ascending(s32, top_k)
        n_top = (top >= np.float32(individual)).sum(axis=1)
        return s32.astype(np.float64), mean, n_top, top.astype(np.float64)
    mean = sims.mean(axis=1) if sims.shape[1] else np.full(len(sims), np.nan)
    top = top_k_ascending(sims, top_k)
    with np.errstate(invalid="ignore"):
        n_top = (top >= individual).sum(axis=1)
    return sims, mean, n_top, top


def top_k_ascending(s: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest values per row, ascending (NaN counts as largest, as
    in ``np.sort``). Partial selection when ``k`` is small against the row."""
    m = s.shape[1]
    if m <= 4 * k:
        return np.sort(s, axis=1)[:, -k:]
    part = np.partition(s, m - k, axis=1)[:, -k:]
    return np.sort(part, axis=1)


# Largest similarity block (papers x references) held at once in a task.
BLOCK_ELEMS = 1 << 22


def _list_array(values: np.ndarray, width: int, mask: np.ndarray) -> pa.Array:
    n = len(mask)
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1), type=pa.float64()), mask=pa.array(mask))


def _score_array(col: pa.Array, r: np.ndarray, dim: int, k: int, individual: float, strict: bool, with_sims: bool) -> pa.StructArray:
    """``SCORE_STRUCT`` of each embedding, in row blocks of at most BLOCK_ELEMS similarities."""
    m = len(r)
    width_top, width_sims = min(k, m), m if with_sims else 0
    rows_per_block = max(1, BLOCK_ELEMS // max(m, 1))
    valid, dense = _dense_rows(col, dim)
    n = len(valid)
    idx = np.flatnonzero(valid)
    sims = np.zeros((n, width_sims))
    mean = np.zeros(n)
    n_top = np.zeros(n, dtype=np.int32)
    top = np.zeros((n, width_top))
    for lo in range(0, len(dense), rows_per_block):
        rows = idx[lo : lo + rows_per_block]
        s, mu, c, t = score_matrix(dense[lo : lo + rows_per_block], r, k, individual, strict)
        mean[rows], n_top[rows], top[rows] = mu, c, t
        if with_sims:
            sims[rows] = s
    null = ~valid
    return pa.StructArray.from_arrays(
        [
            _list_array(sims, width_sims, null),
            pa.array(mean, type=pa.float64(), mask=null),
            pa.array(n_top, type=pa.int32(), mask=null),
            _list_array(top, width_top, null),
        ],
        names=[f.name for f in SCORE_STRUCT.fields],
        mask=pa.array(null),
    )


def similarity_struct(
    emb: Column | str, refs: ReferenceSet, cfg: TriageConfig, spark, with_sims: bool = True
) -> Column:
    """Arrow UDF column ``struct<sims, mean_similarity, n_top_above, top_sims>``.

    ``sims`` follows ``refs.ref_ids`` order; with ``with_sims=False`` it is
    left empty (the rules need only mean and top-k). The reference matrix
    travels as a broadcast variable, once per executor. A batch is scored in
    row blocks of at most ``BLOCK_ELEMS`` similarities, so task memory stays
    bounded for any reference count under the broadcast bound.
    """
    bc = spark.sparkContext.broadcast(refs.matrix)
    dim, k = refs.dim, cfg.top_k
    individual, strict = cfg.individual_sim_threshold, cfg.strict_float32

    @F.arrow_udf(SCORE_STRUCT)
    def score_batch(col: pa.Array) -> pa.Array:
        return _score_array(col, bc.value, dim, k, individual, strict, with_sims)

    # nondeterministic only to pin the evaluation point: Catalyst would otherwise
    # copy filters on the result below exchanges and run the product twice
    return score_batch.asNondeterministic()(F.col(emb) if isinstance(emb, str) else emb)


def score_columns_sql(papers: DataFrame, emb: str, refs: ReferenceSet, cfg: TriageConfig) -> DataFrame:
    """Add ``sims, mean_similarity, n_top_above, top_sims`` with JVM
    higher-order functions only (no Python worker).

    Staged projections keep each array computed once per row: a value used by
    several later expressions is a column of an earlier projection, which
    Catalyst does not inline again when it is referenced more than once."""
    k = cfg.top_k
    mat = V.literal_matrix(refs.matrix.tolist())
    e = F.col(emb)
    norm = F.greatest(V.l2_norm(e), F.lit(V.NORM_EPS))
    dots = F.transform(mat, lambda r: V.dot(e, r))
    sims = F.when(e.isNotNull(), V.divide_by(dots, norm))
    if cfg.strict_float32:
        sims = F.transform(sims, lambda s: s.cast("float").cast("double"))
    # ``spark_partition_id() >= 0`` is always true but nondeterministic: it is
    # an optimisation barrier that keeps the relevance filter from being
    # substituted below this projection, where every use of ``sims`` in the
    # rules would recompute the higher-order functions
    df = papers.withColumn("sims", F.when(F.spark_partition_id() >= 0, sims))
    size = F.size("sims")
    mean = F.when(size > 0, F.aggregate("sims", F.lit(0.0).cast("double"), lambda a, x: a + x) / size)
    if cfg.strict_float32:
        mean = mean.cast("float").cast("double")
    df = df.withColumn("mean_similarity", mean).withColumn("_sorted", F.array_sort("sims"))
    df = df.withColumn("top_sims", F.slice("_sorted", F.greatest(F.size("_sorted") - k + 1, F.lit(1)), k))
    t = F.lit(cfg.individual_sim_threshold)
    if cfg.strict_float32:
        t = t.cast("float").cast("double")
    n_top = F.size(F.filter("top_sims", lambda s: (s >= t) & ~F.isnan(s)))
    return df.withColumn("n_top_above", F.when(e.isNotNull(), n_top.cast("int"))).drop("_sorted")


def relevance_rules(mean: Column, n_top: Column, cfg: TriageConfig) -> tuple[Column, Column]:
    """(mean rule, top-k rule). Mean rule is strict ``>``; NaN never passes."""
    thr = F.lit(cfg.similarity_threshold)
    m = mean
    if cfg.strict_float32:
        thr, m = thr.cast("float"), mean.cast("float")
    mean_rule = F.coalesce(~F.isnan(mean) & (m > thr), F.lit(False))
    top_rule = F.coalesce(n_top >= F.lit(cfg.min_top_papers), F.lit(False))
    return mean_rule, top_rule


# Largest similarity array (bytes) a Python worker returns at once.
MAX_SIMS_BATCH_BYTES = 1 << 28


def _scored_in_slices(papers: DataFrame, refs: ReferenceSet, cfg: TriageConfig, emb_col: str, rows: int) -> DataFrame:
    """Add ``_score`` with all similarities, in Arrow batches of ``rows`` rows:
    a wide reference set makes an input batch's similarities too large for one."""
    bc = papers.sparkSession.sparkContext.broadcast(refs.matrix)
    dim, k, individual, strict = refs.dim, cfg.top_k, cfg.individual_sim_threshold, cfg.strict_float32

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                score = _score_array(part.column(emb_col), bc.value, dim, k, individual, strict, True)
                yield pa.RecordBatch.from_arrays([*part.columns, score], names=[*part.schema.names, "_score"])

    return papers.mapInArrow(run, T.StructType([*papers.schema.fields, T.StructField("_score", SCORE_STRUCT)]))


def score_papers(
    papers: DataFrame,
    refs: ReferenceSet,
    cfg: TriageConfig,
    emb_col: str = "embedding",
    plan: str = "arrow",
    keep_sims: bool = True,
) -> DataFrame:
    """Add ``sims, mean_similarity, n_top_above, top_sims, is_related, reason``.

    ``plan='arrow'`` runs the numpy block product in an Arrow UDF;
    ``plan='sql'`` stays in the JVM (interpreted lambdas, no Python).
    """
    if plan == "arrow":
        rows = max(1, MAX_SIMS_BATCH_BYTES // (8 * max(refs.size, 1)))
        if keep_sims and rows < int(papers.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")):
            with_score = _scored_in_slices(papers, refs, cfg, emb_col, rows)
        else:
            s = similarity_struct(emb_col, refs, cfg, papers.sparkSession, with_sims=keep_sims)
            with_score = papers.select(*papers.columns, s.alias("_score"))
        mean, n_top = F.col("_score.mean_similarity"), F.col("_score.n_top_above")
        mean_rule, top_rule = relevance_rules(mean, n_top, cfg)
        # one projection for the outputs and the rules (fewer plan analyses)
        return with_score.select(
            *papers.columns,
            F.col("_score.sims").alias("sims"),
            mean.alias("mean_similarity"),
            n_top.alias("n_top_above"),
            F.col("_score.top_sims").alias("top_sims"),
            (mean_rule | top_rule).alias("is_related"),
            F.when(mean_rule, F.lit("mean")).when(top_rule, F.lit("top_k")).alias("reason"),
        )
    if plan != "sql":
        raise ValueError(f"unknown plan {plan!r}")
    scored = score_columns_sql(papers, emb_col, refs, cfg)
    mean_rule, top_rule = relevance_rules(F.col("mean_similarity"), F.col("n_top_above"), cfg)
    return scored.withColumn("is_related", mean_rule | top_rule).withColumn(
        "reason", F.when(mean_rule, F.lit("mean")).when(top_rule, F.lit("top_k"))
    )


def collapse_reference_titles(
    refs: DataFrame, pos_col: str = "ref_id", title_col: str = "title", abstract_col: str = "abstract"
) -> DataFrame:
    """E5 for the reference set: references whose normalised titles are equal
    collapse to one entry, keeping the last abstract and the first position
    (dict semantics in input order). One partially aggregated ``groupBy``."""
    from ..functions.text import normalize_text

    keyed = refs.withColumn("_norm_title", normalize_text(title_col))
    return keyed.groupBy("_norm_title").agg(
        F.min(pos_col).alias(pos_col),
        F.min_by(title_col, pos_col).alias(title_col),
        F.max_by(abstract_col, pos_col).alias(abstract_col),
    ).drop("_norm_title")


def exclude_reference_papers(papers: DataFrame, refs: ReferenceSet, title_col: str = "title") -> DataFrame:
    """V15 option: drop corpus papers that are themselves reference papers
    (normalised titles equal). The original scores them like any other.

    The reference titles are a bounded list (the reference set passed its
    size check); they are normalised by the same Spark expression, collected,
    and applied as a literal ``IN`` filter, so no join is needed."""
    from ..functions.text import normalize_text

    titles = [t for t in refs.titles if t is not None]
    if not titles:
        return papers
    spark = papers.sparkSession
    tdf = spark.createDataFrame([(t,) for t in titles], "t string")
    keys = sorted({r[0] for r in tdf.select(normalize_text("t")).collect()})
    return papers.filter(~F.coalesce(normalize_text(title_col).isin(keys), F.lit(False)))


def exclude_titles(papers: DataFrame, refs: DataFrame, title_col: str = "title") -> DataFrame:
    """V15 option for any number of references: an anti join on the normalised title."""
    from ..functions.text import normalize_text

    keys = refs.select(normalize_text(title_col).alias("_key")).where("_key IS NOT NULL").distinct()
    return papers.withColumn("_key", normalize_text(title_col)).join(keys, "_key", "left_anti").drop("_key")


def related_only(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("is_related"))


def ref_ids_column(refs: ReferenceSet) -> Column:
    return F.array(*[F.lit(int(i)).cast("bigint") for i in refs.ref_ids])


def pairwise_long(scored: DataFrame, refs: ReferenceSet, id_col: str = "paper_id") -> DataFrame:
    """Long form ``(paper_id, ref_id, similarity)``: one row per pair.

    A narrow ``posexplode`` of the per-paper array; the output grows with
    papers x references, which is the operator's result, not a join.
    """
    ids = ref_ids_column(refs)
    # posexplode_outer: the size() > 0 filter Catalyst infers for posexplode
    # would be pushed below the scoring UDF and evaluate it a second time
    exploded = scored.select(id_col, F.posexplode_outer("sims").alias("ref_idx", "similarity"))
    return exploded.filter(F.col("ref_idx").isNotNull()).select(
        id_col, F.element_at(ids, F.col("ref_idx") + 1).alias("ref_id"), "similarity"
    )


def sorted_detail(scored: DataFrame, refs: ReferenceSet, id_col: str = "paper_id") -> DataFrame:
    """Per paper, references ordered by similarity descending, ref id ascending.

    Adds ``detail: array<struct<ref_id bigint, similarity double>>`` sorted
    inside each row (no shuffle).
    """
    pairs = F.arrays_zip(ref_ids_column(refs).alias("ref_id"), F.col("sims").alias("similarity"))

    def cmp(a, b):
        return (
            F.when(a["similarity"] > b["similarity"], F.lit(-1))
            .when(a["similarity"] < b["similarity"], F.lit(1))
            .when(a["ref_id"] < b["ref_id"], F.lit(-1))
            .when(a["ref_id"] > b["ref_id"], F.lit(1))
            .otherwise(F.lit(0))
        )

    return scored.withColumn("detail", F.array_sort(pairs, cmp))


# --- large reference sets -------------------------------------------------


def reference_centroid(refs: DataFrame, emb_col: str = "embedding") -> list[float]:
    """Mean of the unit reference vectors, as a distributed aggregate.

    On unit vectors ``avg_j(u . r_j) == u . avg_j(r_j)`` (centroid rewrite),
    so the mean rule needs only this d-vector, whatever the reference count.
    Only ``d`` numbers reach the driver.
    """
    unit = refs.select(V.l2_normalize(emb_col).alias("u"))
    per_dim = unit.select(F.posexplode("u").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("c"))
    rows = per_dim.orderBy("i").collect()
    return [float(r["c"]) for r in rows]


def centroid_mean(emb: Column | str, centroid: list[float]) -> Column:
    """Mean cosine to all references via the centroid rewrite (JVM only)."""
    emb = F.col(emb) if isinstance(emb, str) else emb
    norm = F.greatest(V.l2_norm(emb), F.lit(V.NORM_EPS))
    return V.dot(emb, V.literal_vector(centroid)) / norm
