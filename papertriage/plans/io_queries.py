"""Source/sink queries: CSV round trip with header aliases, appends onto an
absent table, venue partitions, triage output tables (A1-A3, A7-A12, B6, G1)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..jobs import write_triage_outputs
from ..operators import score as SC
from ..session import scratch_path
from ..sources import csv as CS
from ..operators.papers import not_already_saved
from ..sources.tables import read_or_empty
from . import scoring as SQ
from . import sqlfrag as S
from .registry import query
from .text_queries import kept_papers

_WITH = "WITH " + S.PAPERS_CTE.strip()


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query(
    "csv_round_trip",
    _WITH + "\nSELECT title, abstract, url FROM kept",
    "A1 A2 A8 V1 (pandas-style CSV with Title/Abstract headers, multi-line fields)",
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_papers(spark, sf_dir)
    path = _scratch(spark, "csv")
    CS.write_paper_csv(kept.select(F.col("title").alias("Title"), F.col("abstract").alias("Abstract"), "url"), path)
    return CS.read_paper_csv(spark, path)


PAPER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CS.PAPER_COLUMNS])


@query(
    "csv_append",
    _WITH + "\nSELECT title, url FROM kept",
    "A3 A9 A10 G1 (append-if-new onto an absent table, then onto its stored rows)",
)
def csv_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_papers(spark, sf_dir).select(*CS.PAPER_COLUMNS, "lang")
    path = _scratch(spark, "append")
    run = kept.select(*CS.PAPER_COLUMNS)
    for new in (run.filter(kept["lang"] == "en"), run):  # first onto an absent table, then onto stored rows
        existing = read_or_empty(spark, path, PAPER_SCHEMA, fmt="csv")
        CS.write_paper_csv(not_already_saved(new, existing, "url").select(*CS.PAPER_COLUMNS), path, mode="append")
    return CS.read_paper_csv(spark, path).select("title", "url")


@query(
    "venue_partitions",
    _WITH + "\nSELECT venue, CAST(count(*) AS BIGINT) AS n_papers FROM kept GROUP BY venue",
    "A7 A8 (one dataset partitioned by venue; partition discovery on read)",
)
def venue_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_papers(spark, sf_dir).select(*CS.PAPER_COLUMNS, "venue")
    path = _scratch(spark, "venues")
    kept.write.mode("overwrite").partitionBy("venue").parquet(path)
    back = spark.read.option("basePath", path).parquet(path)
    return back.groupBy(F.col("venue").cast("string").alias("venue")).agg(F.count(F.lit(1)).alias("n_papers"))


_RELATED_JSON_SQL = (
    SQ._PAIRS_SQL
    + """,
best AS (SELECT paper_id, max(sim) AS best FROM s GROUP BY paper_id)
SELECT split_part(d.text, chr(10), 1) AS title, round(rel.mean_sim, 6) AS mean_abstract_similarity,
       (SELECT CAST(count(DISTINCT split_part(text, chr(10), 1)) AS INTEGER) FROM documents WHERE doc_id < 23) AS n_refs,
       round(best.best, 6) AS best_similarity
FROM rel JOIN best USING (paper_id) LEFT JOIN documents d ON d.doc_id = rel.paper_id"""
)


@query(
    "related_outputs",
    _RELATED_JSON_SQL,
    "A11 A12 B6 F4 (scored/related/detailed/report tables; detailed JSON read back)",
)
def related_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, refs = SQ.scored_papers(spark, sf_dir, with_titles=True)
    docs = SQ.read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("paper_id"),
        TX.first_line("text").alias("title"),
        TX.after_first_line("text").alias("abstract"),
    )
    root = _scratch(spark, "outputs")
    paths = write_triage_outputs(spark, scored, refs, root, SQ.CFG, texts=docs)
    schema = "title string, abstract string, mean_abstract_similarity double, detailed_similarities map<string,double>"
    back = spark.read.schema(schema).json(paths["related_detailed"])
    return back.select(
        "title",
        F.round("mean_abstract_similarity", 6).alias("mean_abstract_similarity"),
        F.size("detailed_similarities").cast("int").alias("n_refs"),
        F.round(F.array_max(F.map_values("detailed_similarities")), 6).alias("best_similarity"),
    )



@query(
    "csv_mixed_headers",
    _WITH + "\nSELECT title, abstract, url FROM kept",
    "A1 A2 A7 (files with other column orders and header names in one folder)",
)
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_papers(spark, sf_dir).select(*CS.PAPER_COLUMNS, "lang")
    path = _scratch(spark, "mixed")
    english = F.col("lang").eqNullSafe("en")
    plain, other = kept.filter(english).drop("lang"), kept.filter(~english).drop("lang")
    CS.write_paper_csv(plain, path, mode="append")
    CS.write_paper_csv(other.select("url", F.col("abstract").alias("Abstract"), F.col("title").alias("Title")), path, mode="append")
    return CS.read_paper_csv(spark, path)
