"""Paper-table queries: build, rejects, keep-first per key, already-saved
membership and append (B1, B3, C5, A14, E3, E4, D1, D2, G1, G2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import papers as PP
from ..sources.tables import read_table
from . import sqlfrag as S
from .registry import query


def _tagged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = read_table(spark, sf_dir, "documents")
    return PP.split_usable(PP.papers_from_documents(docs, S.URL_PREFIX))


_WITH = "WITH " + S.PAPERS_CTE.strip()


@query(
    "papers_build",
    _WITH + "\nSELECT paper_id, title, abstract, url, venue, title || ': ' || abstract AS document FROM kept",
    "B1 B3 C5 (documents -> usable paper rows)",
)
def papers_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = _tagged(spark, sf_dir)
    return kept.select(*PP.PAPER_COLUMNS, TX.paper_text("title", "abstract").alias("document"))


@query(
    "papers_rejects",
    _WITH + "\nSELECT paper_id, title, reason FROM tagged WHERE reason IS NOT NULL",
    "A14 C5 (rows that are not usable, with a reason)",
)
def papers_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = _tagged(spark, sf_dir)
    return rejects.select("paper_id", "title", "reason")


_KEYED = _WITH + f", keyed AS (SELECT *, {S.title_key('title')} AS title_key FROM kept)"


@query(
    "title_key_dedupe",
    _KEYED
    + """
SELECT title_key, min(paper_id) AS paper_id, arg_min(title, paper_id) AS title, CAST(count(*) AS BIGINT) AS n_rows
FROM keyed GROUP BY title_key""",
    "H2 E3 E4 (keep the first paper per title key)",
)
def title_key_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = _tagged(spark, sf_dir)
    keyed = PP.with_title_key(kept.select("paper_id", "title"))
    return PP.keep_first_per_key(keyed, "title_key", "paper_id", count_col="n_rows")


@query(
    "title_key_dedupe_unicode",
    _WITH
    + """, some_signs AS (SELECT * REPLACE (CASE WHEN paper_id % 50 = 0 THEN '*** ...' ELSE title END AS title) FROM kept),
keyed AS (SELECT *, lower(regexp_replace(title, '[^\\p{L}\\p{N}]', '', 'g')) AS title_key FROM some_signs)
SELECT title_key, min(paper_id) AS paper_id, arg_min(title, paper_id) AS title, CAST(count(*) AS BIGINT) AS n_rows
FROM keyed WHERE title_key <> '' GROUP BY title_key
UNION ALL SELECT title_key, paper_id, title, 1 FROM keyed WHERE title_key = ''""",
    "H2 E4 V11 (Unicode title keys; rows with an empty key match nothing and all stay)",
)
def title_key_dedupe_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = _tagged(spark, sf_dir)
    # every 50th title is signs only, so that empty keys occur
    title = F.when(F.col("paper_id") % 50 == 0, F.lit("*** ...")).otherwise(F.col("title"))
    keyed = PP.with_title_key(kept.select("paper_id", title.alias("title")), unicode_key=True)
    return PP.keep_first_nonempty(keyed, "title_key", "paper_id", count_col="n_rows")


_ANTI_KEY_SQL = (
    _KEYED
    + """,
firsts AS (SELECT title_key, min(paper_id) AS paper_id FROM keyed GROUP BY title_key)
SELECT f.paper_id, f.title_key FROM firsts f
WHERE f.title_key NOT IN (SELECT title_key FROM keyed WHERE lang = 'en')"""
)


def _saved_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Already-saved papers (the English collection) and a new run over all
    papers, keep-first per title key."""
    kept, _ = _tagged(spark, sf_dir)
    keyed = PP.with_title_key(kept.select("paper_id", "title", "lang"))
    saved = keyed.filter(F.col("lang") == "en").select("paper_id", "title_key")
    run = PP.keep_first_per_key(keyed.select("paper_id", "title_key"), "title_key", "paper_id")
    return saved, run


@query("anti_by_key", _ANTI_KEY_SQL, "D2 G2 E4 (new papers whose title key is not saved yet)")
def anti_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved, run = _saved_and_new(spark, sf_dir)
    return PP.not_already_saved(run, saved, "title_key").select("paper_id", "title_key")


@query(
    "append_if_new",
    _ANTI_KEY_SQL.replace(
        "SELECT f.paper_id, f.title_key FROM firsts f",
        "SELECT paper_id, title_key FROM keyed WHERE lang = 'en'\nUNION ALL\nSELECT f.paper_id, f.title_key FROM firsts f",
    ),
    "G1 (saved rows plus the unseen new rows)",
)
def append_if_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved, run = _saved_and_new(spark, sf_dir)
    return PP.append_new(saved, run, "title_key")


@query(
    "anti_by_url",
    """SELECT page_id, url FROM pages
WHERE url NOT IN (SELECT url FROM pages WHERE url LIKE '%/en/%')""",
    "D1 G2 (pages whose URL is not saved yet)",
)
def anti_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    saved = pages.filter(F.col("url").contains("/en/"))
    return PP.not_already_saved(pages, saved, "url")
