"""Text normalisation queries over ``documents`` (H1, H5, H6, B1, B2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import papers as PP
from ..sources.tables import read_table
from . import sqlfrag as S
from .registry import query


def kept_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    kept, _ = PP.split_usable(PP.papers_from_documents(docs, S.URL_PREFIX))
    return kept


@query(
    "normalize_text",
    f"SELECT doc_id, {S.normalize('text')} AS normalized FROM documents",
    "H1 over every whole document",
)
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", TX.normalize_text("text").alias("normalized"))


_PROMPT_SQL = (
    "WITH "
    + S.PAPERS_CTE.strip()
    + f"""
SELECT paper_id,
       'Instruct: Retrive papers in similar fields to Queries.' || chr(10) || 'Queries: ' || chr(10) || 'Title: '
       || {S.normalize('title')} || chr(10) || 'Abstract: ' || {S.normalize('abstract')} AS prompt
FROM kept"""
)


@query("prompt_text", _PROMPT_SQL, "B2 (normalised title and abstract in the encoder instruction)")
def prompt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_papers(spark, sf_dir)
    return kept.select(
        "paper_id", TX.prompt_text(TX.normalize_text("title"), TX.normalize_text("abstract")).alias("prompt")
    )


_SEC = "'Abstract' || chr(10) || text"
_ECCV = "'Abstract: ' || text"


def _h5_sql(x: str) -> str:
    t = f"regexp_replace({x}, '{S.WS}{{2,}}', ' ', 'g')"
    t = f"replace({t}, 'Abstract:', '')"
    t = f"replace({t}, chr(10), ' ')"
    return S.strip(t)


def _h6_sql(x: str) -> str:
    s = S.strip(x)
    return f"CASE WHEN starts_with({s}, 'Abstract') THEN {S.strip(f'substr({s}, 9)')} ELSE {s} END"


@query(
    "abstract_cleanup",
    f"SELECT doc_id, {_h5_sql(_ECCV)} AS cleaned, {_h6_sql(_SEC)} AS label_stripped FROM documents",
    "H5 H6 (detail-page abstract clean-up on labelled document text)",
)
def abstract_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        TX.abstract_cleanup(F.concat(F.lit("Abstract: "), "text")).alias("cleaned"),
        TX.strip_label_prefix(F.concat(F.lit("Abstract\n"), "text")).alias("label_stripped"),
    )
