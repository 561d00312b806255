"""Scoring queries over ``embeddings`` (papers: ``vec_id >= 23``; the 23
reference papers: ``vec_id < 23``) with the fixture thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE_CONFIG, REFERENCE_COUNT, TriageConfig
from ..functions import text as TX
from ..operators import blocks as BL
from ..operators import ranking as RK
from ..operators import report as RP
from ..operators import score as SC
from ..sources.tables import read_table
from .registry import query

CFG = FIXTURE_CONFIG
R = REFERENCE_COUNT


def papers_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.filter(F.col("vec_id") >= R).select(
        F.col("vec_id").alias("paper_id"), "embedding", F.col("label").alias("venue")
    )


def refs_frame(spark: SparkSession, sf_dir: str, with_titles: bool = False) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    refs = emb.filter(F.col("vec_id") < R).select(F.col("vec_id").alias("ref_id"), "embedding")
    if with_titles:
        docs = read_table(spark, sf_dir, "documents").select(
            F.col("doc_id").alias("ref_id"), TX.first_line("text").alias("ref_title")
        )
        refs = refs.join(docs.filter(F.col("ref_id") < R), "ref_id", "left")
    return refs


def reference_set(spark: SparkSession, sf_dir: str, cfg: TriageConfig = CFG, with_titles: bool = False):
    refs = refs_frame(spark, sf_dir, with_titles)
    return SC.collect_reference_set(
        refs, "ref_id", "embedding", "ref_title" if with_titles else None, max_bytes=cfg.max_reference_bytes
    )


def scored_papers(
    spark: SparkSession,
    sf_dir: str,
    cfg: TriageConfig = CFG,
    plan: str = "arrow",
    with_titles: bool = False,
    keep_sims: bool = True,
):
    refs = reference_set(spark, sf_dir, cfg, with_titles)
    return SC.score_papers(papers_frame(spark, sf_dir), refs, cfg, plan=plan, keep_sims=keep_sims), refs


def _related_out(df: DataFrame) -> DataFrame:
    return df.select(
        "paper_id",
        F.round("mean_similarity", 6).alias("mean_similarity"),
        F.col("n_top_above").cast("bigint").alias("n_top_above"),
        "reason",
    )


# --- oracle SQL pieces ------------------------------------------------------

_PAIRS_SQL = f"""
WITH p AS (SELECT vec_id AS paper_id, label AS venue, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id >= {R}),
r AS (SELECT vec_id AS ref_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id < {R}),
s AS (SELECT p.paper_id, p.venue, r.ref_id, list_cosine_similarity(p.e, r.e) AS sim FROM p CROSS JOIN r),
agg AS (
  SELECT paper_id, any_value(venue) AS venue, avg(sim) AS mean_sim,
         least({CFG.top_k}, count(*) FILTER (WHERE sim >= {CFG.individual_sim_threshold})) AS n_top
  FROM s GROUP BY paper_id),
rel AS (
  SELECT *, CASE WHEN mean_sim > {CFG.similarity_threshold} THEN 'mean' ELSE 'top_k' END AS reason
  FROM agg WHERE mean_sim > {CFG.similarity_threshold} OR n_top >= {CFG.min_top_papers})
"""

RELATED_SQL = (
    _PAIRS_SQL
    + """SELECT paper_id, round(mean_sim, 6) AS mean_similarity, CAST(n_top AS BIGINT) AS n_top_above, reason FROM rel"""
)


@query("related_papers", RELATED_SQL, "A6 B6 D3 D4 H12 H13 E1 E2 F1 C6 C7 (flagship, Arrow block product)")
def related_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = scored_papers(spark, sf_dir, keep_sims=False)
    return _related_out(SC.related_only(scored))


@query("related_papers_jvm", RELATED_SQL, "same result, JVM higher-order functions only")
def related_papers_jvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = scored_papers(spark, sf_dir, plan="sql")
    return _related_out(SC.related_only(scored))


@query("related_papers_chunked", RELATED_SQL, "same result, references and papers as matrix blocks paired in a grid of cells")
def related_papers_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    # small blocks: several reference groups, states merged in a tree
    scored = BL.score_blocks(papers_frame(spark, sf_dir), refs_frame(spark, sf_dir), CFG, block_bytes=16 * 64 * 8, cell_bytes=16 * 64 * 8)
    return _related_out(SC.related_only(scored))


@query(
    "related_papers_blocks",
    f"""WITH p AS (SELECT vec_id, vec_id // 3 AS paper_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id >= {R}),
r AS (SELECT CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label % 2 = 0),
agg AS (SELECT vec_id, any_value(paper_id) AS paper_id, avg(list_cosine_similarity(p.e, r.e)) AS mean_sim,
  least({CFG.top_k}, count(*) FILTER (WHERE list_cosine_similarity(p.e, r.e) >= 0.6)) AS n_top FROM p CROSS JOIN r GROUP BY vec_id)
SELECT paper_id, round(mean_sim, 6) AS mean_similarity, CAST(n_top AS BIGINT) AS n_top_above, CASE WHEN mean_sim > 0.02 THEN 'mean' ELSE 'top_k' END AS reason
FROM agg WHERE mean_sim > 0.02 OR n_top >= {CFG.min_top_papers}""",
    "A6 D3 E1 E2 C6 (a reference set that grows with the table, repeated paper ids)",
)
def related_papers_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    papers = emb.filter(F.col("vec_id") >= R).select(F.floor(F.col("vec_id") / 3).alias("paper_id"), "embedding")
    refs = emb.filter(F.col("label") % 2 == 0).select(F.col("vec_id").alias("ref_id"), "embedding")
    scored = BL.score_blocks(papers, refs, CFG.with_(similarity_threshold=0.02, individual_sim_threshold=0.6))
    return _related_out(SC.related_only(scored))


@query(
    "pairwise_cosine",
    _PAIRS_SQL + "SELECT paper_id, ref_id, round(sim, 6) AS similarity FROM s",
    "D3 D4 H12 H13 (long form of every paper x reference cosine)",
)
def pairwise_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, refs = scored_papers(spark, sf_dir)
    return SC.pairwise_long(scored, refs).select(
        "paper_id", "ref_id", F.round("similarity", 6).alias("similarity")
    )


MEAN_SQL = _PAIRS_SQL + "SELECT paper_id, round(mean_sim, 6) AS mean_similarity FROM agg"


@query("mean_similarity", MEAN_SQL, "E1")
def mean_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = scored_papers(spark, sf_dir, keep_sims=False)
    return scored.select("paper_id", F.round("mean_similarity", 6).alias("mean_similarity"))


@query("centroid_mean", MEAN_SQL, "E1 via the centroid rewrite (any reference count, JVM only)")
def centroid_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = SC.reference_centroid(refs_frame(spark, sf_dir))
    papers = papers_frame(spark, sf_dir)
    return papers.select("paper_id", F.round(SC.centroid_mean("embedding", c), 6).alias("mean_similarity"))


@query(
    "similarity_detail",
    _PAIRS_SQL
    + """SELECT s.paper_id,
       CAST(row_number() OVER (PARTITION BY s.paper_id ORDER BY s.sim DESC, s.ref_id) AS BIGINT) AS rank,
       s.ref_id, round(s.sim, 6) AS similarity
FROM s JOIN rel USING (paper_id)""",
    "E8 F2 A11 (per related paper, references by similarity desc)",
)
def similarity_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, refs = scored_papers(spark, sf_dir)
    detail = SC.sorted_detail(SC.related_only(scored), refs)
    # posexplode_outer: a plain posexplode makes Catalyst infer a size() > 0
    # filter that it pushes below the UDF's exchange, evaluating the UDF twice
    exploded = detail.select("paper_id", F.posexplode_outer("detail").alias("pos", "d"))
    return exploded.filter(F.col("d").isNotNull()).select(
        "paper_id",
        (F.col("pos") + 1).cast("bigint").alias("rank"),
        F.col("d.ref_id").alias("ref_id"),
        F.round("d.similarity", 6).alias("similarity"),
    )


@query(
    "score_summary",
    _PAIRS_SQL
    + f"""SELECT CAST(count(*) AS BIGINT) AS n_papers,
       CAST(count(*) FILTER (WHERE mean_sim > {CFG.similarity_threshold} OR n_top >= {CFG.min_top_papers}) AS BIGINT) AS n_related,
       CAST(count(*) FILTER (WHERE mean_sim > {CFG.similarity_threshold}) AS BIGINT) AS n_mean_rule,
       CAST(count(*) FILTER (WHERE n_top >= {CFG.min_top_papers}) AS BIGINT) AS n_top_rule,
       CAST(count(*) FILTER (WHERE mean_sim > {CFG.similarity_threshold} AND n_top >= {CFG.min_top_papers}) AS BIGINT) AS n_both
FROM agg""",
    "A15 E7 (run summary counts)",
)
def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = scored_papers(spark, sf_dir, keep_sims=False)
    mean_rule, top_rule = SC.relevance_rules(F.col("mean_similarity"), F.col("n_top_above"), CFG)
    return scored.agg(
        F.count(F.lit(1)).alias("n_papers"),
        F.count_if(F.col("is_related")).alias("n_related"),
        F.count_if(mean_rule).alias("n_mean_rule"),
        F.count_if(top_rule).alias("n_top_rule"),
        F.count_if(mean_rule & top_rule).alias("n_both"),
    )


_T = CFG.similarity_threshold
_I = CFG.individual_sim_threshold
_K = CFG.top_k

REPORT_SQL = (
    _PAIRS_SQL
    + f""",
top3 AS (
  SELECT q.paper_id,
         string_agg(printf('%s (%.4f)', split_part(d.text, chr(10), 1), q.sim), '; ' ORDER BY q.sim DESC, q.ref_id) AS top_refs
  FROM (SELECT s.*, row_number() OVER (PARTITION BY s.paper_id ORDER BY s.sim DESC, s.ref_id) AS rn
        FROM s JOIN rel USING (paper_id)) q
  LEFT JOIN documents d ON d.doc_id = q.ref_id
  WHERE q.rn <= 3
  GROUP BY q.paper_id)
SELECT rel.paper_id,
       CAST(row_number() OVER (ORDER BY rel.paper_id) AS BIGINT) AS related_no,
       split_part(d.text, chr(10), 1) AS title,
       printf('%.4f', rel.mean_sim) AS mean_text,
       CASE WHEN rel.reason = 'mean' THEN 'mean similarity ' || printf('%.4f', rel.mean_sim) || ' > {_T}'
            ELSE CAST(rel.n_top AS VARCHAR) || ' of top {_K} similarities >= {_I}' END AS reason_text,
       CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(substr(d.text, strpos(d.text, chr(10)) + 1), 1, 100) || '...' END AS snippet,
       top3.top_refs
FROM rel LEFT JOIN documents d ON d.doc_id = rel.paper_id LEFT JOIN top3 USING (paper_id)"""
)


@query("related_report", REPORT_SQL, "A13 B7 B8 F3 F5 (ranked report with titles from documents)")
def related_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, refs = scored_papers(spark, sf_dir, with_titles=True)
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("paper_id"), TX.first_line("text").alias("title"), TX.after_first_line("text").alias("abstract")
    )
    return RP.related_report(SC.related_only(scored), refs, docs, CFG)


@query(
    "ranked_related",
    _PAIRS_SQL
    + """SELECT paper_id, row_number() OVER (ORDER BY mean_sim DESC, paper_id) AS rank, row_number() OVER (ORDER BY paper_id) AS related_no,
       round(mean_sim, 6) AS mean_similarity FROM rel""",
    "F4 F5 (rank by mean similarity and running number in input order, both read back)",
)
def ranked_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = scored_papers(spark, sf_dir, keep_sims=False)
    related = SC.related_only(scored).select("paper_id", "mean_similarity")
    ranked = RK.global_row_number(related, [F.col("mean_similarity").desc(), F.col("paper_id")], "rank")
    numbered = RK.global_row_number(ranked, [F.col("paper_id")], "related_no")
    return numbered.select("paper_id", "rank", "related_no", F.round("mean_similarity", 6).alias("mean_similarity"))


@query(
    "top_percentile",
    _PAIRS_SQL
    + f"""SELECT paper_id, venue, round(mean_sim, 6) AS mean_similarity, round(pr, 6) AS percent_rank FROM (
  SELECT *, percent_rank() OVER (PARTITION BY venue ORDER BY mean_sim DESC) AS pr FROM agg) t
WHERE pr <= {CFG.top_percentile} / 100.0""",
    "F7 (top percentile of mean similarity per venue; the original flag is never applied)",
)
def top_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = scored_papers(spark, sf_dir, keep_sims=False)
    cut = RP.top_percentile(scored.select("paper_id", "venue", "mean_similarity"), ["venue"], CFG.top_percentile)
    return cut.select(
        "paper_id",
        "venue",
        F.round("mean_similarity", 6).alias("mean_similarity"),
        F.round("percent_rank", 6).alias("percent_rank"),
    )
