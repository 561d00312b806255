"""Submission-note queries on notes derived from ``documents``
(A4, B3, B4, B5, H3, C1, A15, E7, H10, H11)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import notes as NT
from ..session import scratch_path
from ..sources.notes import TEST_VENUES, notes_from_documents, read_notes
from ..sources.tables import read_table
from .registry import query


def _sql_str(v):
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


_VENUE_LIST = "[" + ", ".join(_sql_str(v) for v in TEST_VENUES) + "]"

_NOTES_SQL = f"""WITH n AS (
  SELECT 'n' || CAST(doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title,
         CAST({_VENUE_LIST}[doc_id % 8 + 1] AS VARCHAR) AS venue,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END AS abstract,
         source
  FROM documents),
f AS (
  SELECT *, CASE WHEN venue IS NULL THEN NULL
                 WHEN contains(lower(venue), 'oral') THEN 'Accepted(Oral)'
                 WHEN contains(lower(venue), 'spotlight') THEN 'Accepted(Spotlight)'
                 WHEN contains(lower(venue), 'poster') THEN 'Accepted(Poster)'
                 WHEN contains(lower(venue), 'withdrawn') THEN 'Withdrawn'
                 WHEN contains(lower(venue), 'desk rejected') THEN 'Desk Rejected'
                 WHEN contains(lower(venue), 'submitted') THEN 'Rejected'
                 ELSE 'None' END AS decision,
         'https://openreview.net/forum?id=' || id AS url
  FROM n)"""


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NT.flatten_notes(notes_from_documents(read_table(spark, sf_dir, "documents")))


@query(
    "note_decision",
    _NOTES_SQL + "\nSELECT id, venue, decision, url FROM f",
    "A4 B3 B4 H3 (nested note -> flat row with decision)",
)
def note_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir).select("id", "venue", "decision", "url")


@query(
    "note_scan",
    _NOTES_SQL + "\nSELECT id, title, abstract, venue, decision, url FROM f",
    "A4 B4 (JSON note dump written from documents and scanned with the nested schema)",
)
def note_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, f"notes-{uuid.uuid4().hex}")
    notes_from_documents(read_table(spark, sf_dir, "documents")).select("id", "content").write.json(path)
    return NT.flatten_notes(read_notes(spark, path)).select("id", "title", "abstract", "venue", "decision", "url")


@query(
    "accepted_only",
    _NOTES_SQL + "\nSELECT title, abstract, url FROM f WHERE contains(decision, 'Accepted')",
    "C1 B5 (accepted notes, decision dropped)",
)
def accepted_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NT.accepted(_flat(spark, sf_dir)).select("title", "abstract", "url")


@query(
    "decision_counts",
    _NOTES_SQL
    + """
SELECT source, CAST(count(*) AS BIGINT) AS n_notes,
       CAST(count(*) FILTER (WHERE contains(decision, 'Accepted')) AS BIGINT) AS n_accepted,
       CAST(count(*) FILTER (WHERE decision IS NULL) AS BIGINT) AS n_missing_venue
FROM f GROUP BY source""",
    "A15 E7 (found vs accepted per source)",
)
def decision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NT.decision_counts(_flat(spark, sf_dir), ["source"])


@query(
    "note_rejects",
    _NOTES_SQL + "\nSELECT id, title, 'missing venue' AS reason FROM f WHERE decision IS NULL",
    "A14 (notes without a venue become rejects)",
)
def note_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NT.note_rejects(_flat(spark, sf_dir))


# Conferences assigned to test documents by ``doc_id % 3``.
TEST_CONFERENCES = ["ICLR", "ICML", "NeurIPS"]


@query(
    "venue_fan_in",
    f"""WITH v AS (
  SELECT doc_id, {"[" + ", ".join(_sql_str(c) for c in TEST_CONFERENCES) + "]"}[doc_id % 3 + 1] || '.cc/20'
         || CAST(23 + (doc_id // 3) % 3 AS VARCHAR) || '/Conference' AS venue_id
  FROM documents),
k AS (
  SELECT CASE WHEN len(string_split(venue_id, '/')) >= 2
              THEN lower(split_part(string_split(venue_id, '/')[1], '.', 1)) || '_' || string_split(venue_id, '/')[2]
              ELSE 'openreview' END AS venue_key, venue_id
  FROM v)
SELECT venue_key, any_value(venue_id) AS venue_id, CAST(count(*) AS BIGINT) AS n_papers FROM k GROUP BY venue_key""",
    "A7 H10 H11 (venue id building, conference key, fan-in per venue)",
)
def venue_fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    confs = F.array(*[F.lit(c) for c in TEST_CONFERENCES])
    conf = F.element_at(confs, (F.pmod("doc_id", F.lit(3)) + 1).cast("int"))
    yy = (F.lit(23) + F.pmod(F.expr("doc_id div 3"), F.lit(3))).cast("string")
    v = docs.select(TX.venue_id(conf, yy).alias("venue_id"))
    k = v.select(TX.conference_info("venue_id").alias("venue_key"), "venue_id")
    return k.groupBy("venue_key").agg(F.any_value("venue_id").alias("venue_id"), F.count(F.lit(1)).alias("n_papers"))


_LISTING_BASE = "https://listing.example.org/"


@query(
    "listing_urls",
    f"""SELECT source, '{_LISTING_BASE}' || source || '20' || lpad(CAST(doc_id % 7 + 19 AS VARCHAR), 2, '0') || '?day=all' AS listing_url,
       source || '.cc/20' || CAST(doc_id % 7 + 19 AS VARCHAR) || '/Conference' AS venue_id, CAST(count(*) AS BIGINT) AS n
FROM documents GROUP BY ALL""",
    "H11 (conference and year to listing URL and venue id)",
)
def listing_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    yy = (F.col("doc_id") % 7 + 19).cast("string")
    docs = read_table(spark, sf_dir, "documents").select("source", TX.listing_url("source", yy, _LISTING_BASE).alias("listing_url"), TX.venue_id("source", yy).alias("venue_id"))
    return docs.groupBy("source", "listing_url", "venue_id").agg(F.count(F.lit(1)).alias("n"))
