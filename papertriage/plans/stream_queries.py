"""Incremental queries driven by Structured Streaming file sources over
files that Spark derives from the given tables (I1, I2)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import papers as PP
from ..operators import score as SC
from ..session import scratch_path
from ..streaming import incremental as INC
from . import encode_queries as EQ
from . import scoring as SQ
from . import sqlfrag as S
from .registry import query
from .text_queries import kept_papers
from . import pages_queries as PQ
from ..sources.tables import read_table

_KEYED = "WITH " + S.PAPERS_CTE.strip() + f", keyed AS (SELECT *, {S.title_key('title')} AS title_key FROM kept)"

_INGEST_SQL = (
    _KEYED
    + """,
en_first AS (SELECT title_key, min(paper_id) AS paper_id FROM keyed WHERE lang = 'en' GROUP BY title_key),
all_first AS (SELECT title_key, min(paper_id) AS paper_id FROM keyed GROUP BY title_key)
SELECT paper_id, title_key FROM en_first
UNION ALL
SELECT paper_id, title_key FROM all_first WHERE title_key NOT IN (SELECT title_key FROM en_first)"""
)


@query(
    "incremental_ingest",
    _INGEST_SQL,
    "I1 E4 D2 (file stream, two drops, availableNow runs; replay adds nothing)",
)
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = PP.with_title_key(kept_papers(spark, sf_dir).select("paper_id", "title", "lang"))
    keyed = keyed.select("paper_id", "title_key", "lang")
    root = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    src, target, ckpt = f"{root}/incoming", f"{root}/papers", f"{root}/_checkpoint"
    # the target's key-bucket count is sized to the table (256 by default);
    # these test tables hold thousands of rows, so 8 buckets
    def run():
        INC.run_to_end(INC.ingest_stream(spark, src, keyed.schema, target, ckpt, buckets=8))

    # first drop: the English collection; second drop: a re-crawl of everything
    keyed.filter(F.col("lang") == "en").write.parquet(f"{src}/drop=1")
    run()
    keyed.write.parquet(f"{src}/drop=2")
    run()
    run()  # a run with nothing new must not change the target
    return spark.read.parquet(target).select("paper_id", "title_key")


@query(
    "incremental_score",
    SQ.RELATED_SQL,
    "I2 (embedding file stream scored per micro-batch against broadcast references)",
)
def incremental_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = SQ.papers_frame(spark, sf_dir)
    refs = SQ.reference_set(spark, sf_dir)
    root = scratch_path(spark, f"score-{uuid.uuid4().hex}")
    src, sink, ckpt = f"{root}/incoming", f"{root}/related", f"{root}/_checkpoint"
    papers.filter(F.col("venue") < 5).write.parquet(f"{src}/drop=1")
    INC.run_to_end(INC.score_stream(spark, src, papers.schema, refs, SQ.CFG, sink, ckpt))
    papers.filter(~(F.col("venue") < 5)).write.parquet(f"{src}/drop=2")
    INC.run_to_end(INC.score_stream(spark, src, papers.schema, refs, SQ.CFG, sink, ckpt))
    out = spark.read.parquet(sink)
    return SQ._related_out(out)


@query(
    "incremental_pages",
    f"""WITH f AS (
  SELECT page_id, url, {PQ.PAGE_TITLE_SQL} AS title, {PQ.PAGE_ABSTRACT_SQL} AS abstract FROM pages)
SELECT page_id, url, title, abstract FROM f WHERE title <> '' AND abstract <> ''""",
    "I1 J2 C5 D1 (stored-page file stream -> extraction -> usable rows -> append-if-new by URL)",
)
def incremental_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    root = scratch_path(spark, f"pages-{uuid.uuid4().hex}")
    src, target, ckpt = f"{root}/incoming", f"{root}/papers", f"{root}/_checkpoint"

    def run():
        INC.run_to_end(INC.pages_stream(spark, src, target, ckpt, buckets=8))

    # first drop: the English pages; second drop: a re-crawl of every page
    pages.filter(F.col("url").contains("/en/")).write.parquet(f"{src}/drop=1")
    run()
    pages.write.parquet(f"{src}/drop=2")
    run()
    return spark.read.parquet(target).select("page_id", "url", "title", "abstract")


@query(
    "incremental_triage",
    EQ._TRIAGE_SQL,
    "I2 J1 B2 C5 (paper text file stream -> prompts -> encoder -> scores, references encoded once)",
)
def incremental_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    papers = PP.papers_from_documents(docs, S.URL_PREFIX).select("paper_id", "title", "abstract", "lang")
    refs = SC.collect_reference_set(
        EQ.encoded_papers(spark, sf_dir, refs_only=True), "paper_id", "embedding", max_bytes=EQ.HASH_CFG.max_reference_bytes
    )
    root = scratch_path(spark, f"triage-{uuid.uuid4().hex}")
    src, sink, ckpt = f"{root}/incoming", f"{root}/related", f"{root}/_checkpoint"
    english = F.col("lang").eqNullSafe("en")
    for k, drop in enumerate((papers.filter(english), papers.filter(~english)), 1):
        drop.write.parquet(f"{src}/drop={k}")
        INC.run_to_end(INC.triage_stream(spark, src, papers.schema, refs, EQ.HASH_CFG, sink, ckpt))
    return spark.read.parquet(sink).select(
        "paper_id",
        F.round("mean_similarity", 6).alias("mean_similarity"),
        F.col("n_top_above").cast("bigint").alias("n_top_above"),
        "reason",
    )


@query(
    "incremental_rejects",
    PQ.STORED_CTE + """
SELECT page_id, url, CASE WHEN title = '' THEN 'missing title' ELSE 'missing abstract' END AS reason
FROM f WHERE title = '' OR abstract = ''""",
    "I1 A14 (stored-page file stream: unusable pages to the rejects table, once per URL)",
)
def incremental_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = PQ.stored_pages(spark, sf_dir)
    root = scratch_path(spark, f"rejects-{uuid.uuid4().hex}")
    src, target, rejects, ckpt = (f"{root}/{x}" for x in ("incoming", "papers", "rejects", "_checkpoint"))
    # first drop: the English pages; second drop: a re-crawl of every page
    for k, drop in enumerate((pages.filter(F.col("url").contains("/en/")), pages), 1):
        drop.write.parquet(f"{src}/drop={k}")
        INC.run_to_end(INC.pages_stream(spark, src, target, ckpt, buckets=8, rejects_path=rejects))
    return spark.read.parquet(rejects).select("page_id", "url", "reason")
