"""Ranked outputs: report rows, output ordering and the percentile cut
(A13, B6, B7, B8, F3, F4, F5, F7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TriageConfig
from ..functions import text as TX
from . import ranking
from .score import ReferenceSet, sorted_detail


def reason_text(reason, mean, n_top, cfg: TriageConfig):
    """C7 text: the mean rule wins when both rules hold."""
    return F.when(
        reason == "mean",
        F.concat(F.lit("mean similarity "), TX.fmt4(mean), F.lit(f" > {cfg.similarity_threshold}")),
    ).when(
        reason == "top_k",
        F.concat(
            n_top.cast("string"),
            F.lit(f" of top {cfg.top_k} similarities >= {cfg.individual_sim_threshold}"),
        ),
    )


def top_refs_text(detail_col: str, refs: ReferenceSet | None, n: int = 3):
    """``title (0.1234); ...`` for the ``n`` most similar references
    (without ``refs`` the detail entries carry their ``ref_title``)."""
    if refs is None:
        show = lambda d: F.concat(F.coalesce(d["ref_title"], F.lit("None")), F.lit(" ("), TX.fmt4(d["similarity"]), F.lit(")"))
        return F.concat_ws("; ", F.transform(F.slice(F.col(detail_col), 1, n), show))
    titles = F.array(*[F.lit(t).cast("string") for t in refs.titles])
    ids = [int(i) for i in refs.ref_ids]
    index = F.create_map(*[x for i, ref in enumerate(ids) for x in (F.lit(ref), F.lit(i + 1))])

    def fmt(d):
        title = F.coalesce(F.element_at(titles, F.element_at(index, d["ref_id"])), F.lit("None"))
        return F.concat(title, F.lit(" ("), TX.fmt4(d["similarity"]), F.lit(")"))

    return F.concat_ws("; ", F.transform(F.slice(F.col(detail_col), 1, n), fmt))


def related_report(
    related: DataFrame,
    refs: ReferenceSet,
    docs: DataFrame | None,
    cfg: TriageConfig,
    id_col: str = "paper_id",
) -> DataFrame:
    """One report row per related paper: running number in input order (F5),
    title, mean at 4 decimals, reason, 100-character snippet, top 3.

    Titles and abstracts come with ``related``, or from ``docs`` (one row per
    id): the snippet is cut before anything is joined or exchanged."""
    detail = sorted_detail(related, refs, id_col)
    return numbered_report(detail, refs, cfg, id_col, docs)


def numbered_report(detail: DataFrame, refs: ReferenceSet | None, cfg: TriageConfig, id_col: str = "paper_id", docs: DataFrame | None = None) -> DataFrame:
    """``related_report`` of rows that have their ``detail``."""
    if docs is not None:
        short = docs.select(id_col, "title", TX.snippet("abstract").alias("snippet"))
        detail = detail.drop("title", "abstract").join(short, id_col, "left")
    else:
        detail = detail.withColumn("snippet", TX.snippet("abstract"))
    numbered = ranking.global_row_number(
        detail.select(id_col, "title", "snippet", "mean_similarity", "n_top_above", "reason", "detail"), [F.col(id_col)], "related_no"
    )
    return numbered.select(
        id_col,
        F.col("related_no").cast("bigint").alias("related_no"),
        "title",
        TX.fmt4("mean_similarity").alias("mean_text"),
        reason_text(F.col("reason"), F.col("mean_similarity"), F.col("n_top_above"), cfg).alias("reason_text"),
        "snippet",
        top_refs_text("detail", refs).alias("top_refs"),
    )


def ranked_output(related: DataFrame, id_col: str = "paper_id") -> DataFrame:
    """mean similarity descending, ties by id (a range-partitioned sort)."""
    return related.orderBy(F.col("mean_similarity").desc(), F.col(id_col))


def top_percentile(df: DataFrame, group_cols: list[str], pct: float, id_col: str = "paper_id") -> DataFrame:
    """keep rows whose ``percent_rank`` by mean similarity (descending)
    within their group is at most ``pct`` percent."""
    ranked = ranking.grouped_rank(
        df, group_cols, [F.col("mean_similarity").desc()], ["mean_similarity"], id_col
    )
    return ranked.filter(F.col("percent_rank") <= F.lit(pct) / F.lit(100.0))
