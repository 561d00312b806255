"""Listing pages, track lists and detail-page joins (H8, E5, D5, C2, C3, C4,
E6, F6).

The ordered take-while over an issue archive (C3) is written as two
aggregations per archive (``venue``) plus filters, not as a running window:
a window ordered over a whole archive would put that archive in one task.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from ..session import scratch_path
from ..sources import pages as PG


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """H8: ``(page_id, pos, link_text, href)`` in page order (narrow explode)."""
    # posexplode_outer avoids an inferred size() > 0 filter that would run the
    # regex extraction twice
    exploded = pages.select(id_col, F.posexplode_outer(PG.anchors(html_col)).alias("p", "a"))
    return exploded.filter(F.col("a").isNotNull()).select(
        id_col,
        (F.col("p") + 1).cast("int").alias("pos"),
        F.col("a.text").alias("link_text"),
        F.col("a.href").alias("href"),
    )


def scoped_links(pages: DataFrame, layout: str, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """H8 within a layout's listing container only (``PageRules.links_in``):
    ``(page_id, pos, link_text, href)`` in page order, texts and addresses
    with their character references decoded."""
    exploded = pages.select(id_col, F.explode_outer(PG.extract_fields(html_col, layout)["links"]).alias("a"))
    return exploded.filter(F.col("a.href").isNotNull()).select(id_col, "a.pos", F.col("a.text").alias("link_text"), "a.href")


def page_link_dict(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """E5 + H8: the link dict of each page. The page's anchors are extracted
    once and exploded, then aggregated per (page, text) with partial
    aggregation, so a page of thousands of links takes linear time."""
    return link_dict(page_links(pages, id_col, html_col), id_col).select(id_col, "link_text", "href", "pos")


def link_dict(links: DataFrame, id_col: str = "page_id") -> DataFrame:
    """E5: dict semantics of ``{text: href}`` built in page order: the last
    ``href`` wins, the entry keeps its first position."""
    return links.groupBy(id_col, "link_text").agg(
        F.max_by("href", "pos").alias("href"), F.min("pos").alias("pos")
    )


def walk_next(pages: DataFrame, starts: DataFrame, max_pages: int = 10_000) -> DataFrame:
    """H9: the listing pages reached from each start by following the
    next-page link: ``(start, step, url)``.

    ``pages``: ``(url, html)``, ``starts``: ``(url)``. Links are extracted once;
    a step is one join of all walks at once. A walk ends where there is no next
    link, where its page is not stored or where it has been already."""
    spark = pages.sparkSession
    base = scratch_path(spark, f"walk-{uuid.uuid4().hex}")
    pages.select("url", PG.next_page_url("html").alias("next")).dropDuplicates(["url"]).write.parquet(f"{base}/links")
    links = spark.read.parquet(f"{base}/links")
    at = starts.select("url").distinct().join(links, "url", "left_semi").select(F.col("url").alias("start"), F.lit(0).alias("step"), "url")
    for step in range(max_pages):
        at.write.parquet(f"{base}/steps/at={step}")
        seen = spark.read.schema("start string, step int, url string").parquet(f"{base}/steps").select("start", "step", "url")
        last = seen.where(F.col("step") == step)
        if last.isEmpty():
            return seen
        following = last.join(links.where("next IS NOT NULL"), "url").select("start", F.lit(step + 1).alias("step"), F.col("next").alias("url"))
        at = following.join(links, "url", "left_semi").join(seen.select("start", "url"), ["start", "url"], "left_anti").select("start", "step", "url")
    raise RuntimeError(f"a walk is longer than {max_pages} pages")


def detail_join(listing: DataFrame, details: DataFrame, key: str = "url") -> tuple[DataFrame, DataFrame]:
    """Listing rows joined to stored detail pages; (matched, rejects).

    ``details`` holds one row per stored page (extract its fields first, so
    the join shuffles those and not the HTML). A left join keeps every
    listing row; rows without a stored page become rejects with a reason.
    Shuffle on ``key``; AQE splits skewed keys."""
    joined = listing.join(details.withColumn("_stored", F.lit(True)), key, "left")
    stored = F.coalesce(F.col("_stored"), F.lit(False))
    matched = joined.filter(stored).drop("_stored")
    rejects = (
        joined.filter(~stored)
        .select(*listing.columns)
        .withColumn("reason", F.lit("page not stored"))
    )
    return matched, rejects


def technical_tracks(tracks: DataFrame, title_col: str = "track_title", url_col: str = "track_url") -> DataFrame:
    """C4: link text contains ``Technical Tracks`` and an href is present."""
    return tracks.filter(F.col(title_col).contains("Technical Tracks") & F.col(url_col).isNotNull())


def route_tracks(tracks: DataFrame, target: int, title_col: str = "track_title") -> DataFrame:
    """H4 + C2: ``year`` and ``route`` in {process, skip, stop}."""
    yr = TX.year_from_label(title_col)
    return tracks.withColumn("year", yr).withColumn("route", TX.year_route(F.col("year"), target))


def _before(page: Column, pos: Column, stop: Column) -> Column:
    """(page, pos) strictly before the struct ``stop``; NULL stop = no stop."""
    return stop.isNull() | (page < stop["page_no"]) | ((page == stop["page_no"]) & (pos < stop["pos"]))


def take_while(routed: DataFrame, target: int, archive_cols: list[str]) -> DataFrame:
    """Tracks processed by the ordered crawl of each archive.

    Visiting order is ``(page_no, pos)``. The first older track stops the
    crawl; a page holding a target-year track is the last page visited.
    Equal and unknown years are processed, later years skipped.

    One aggregation per archive finds the first older track (the stop) and
    the first target-year track; the target page ends the crawl only when
    that track comes before the stop (if the first one does not, none does).
    The per-archive row joins back; no ordered window is needed.
    """
    pos = F.struct("page_no", "pos")
    bounds = routed.groupBy(*archive_cols).agg(
        F.min(F.when(F.col("year") < F.lit(target), pos)).alias("_stop"),
        F.min(F.when(F.col("year") == F.lit(target), pos)).alias("_first_target"),
    )
    first = F.col("_first_target")
    last_page = F.when(
        first.isNotNull() & _before(first["page_no"], first["pos"], F.col("_stop")), first["page_no"]
    )
    # a null archive is an archive too: joined null-safe, it stops like others
    same_archive = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in archive_cols))
    kept = (
        routed.filter(F.col("route") == "process")
        .join(bounds.select(*[F.col(c).alias(f"_{c}") for c in archive_cols], "_stop", "_first_target"), same_archive, "left")
        .withColumn("_last_page", last_page)
        .filter(_before(F.col("page_no"), F.col("pos"), F.col("_stop")))
        .filter(F.col("_last_page").isNull() | (F.col("page_no") <= F.col("_last_page")))
    )
    return kept.drop("_stop", "_first_target", "_last_page", *[f"_{c}" for c in archive_cols])


def page_flags(routed: DataFrame, target: int, archive_cols: list[str]) -> DataFrame:
    """Per archive page, whether a target-year track and an older track
    appear, and the track count."""
    return routed.groupBy(*archive_cols, "page_no").agg(
        F.coalesce(F.bool_or(F.col("year") == F.lit(target)), F.lit(False)).alias("found_target"),
        F.coalesce(F.bool_or(F.col("year") < F.lit(target)), F.lit(False)).alias("any_older"),
        F.count(F.lit(1)).alias("n_tracks"),
    )
