"""Queries over stored ``pages``: extraction, links, listing -> detail join,
and an issue archive whose track labels are derived from ``page_id``
(A5, J2, H7, H8, H9, E5, D5, A14, H4, C2, C3, C4, E6, F6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..jobs import CVF, ECCV, collect_job, collect_sequential
from ..operators import listing as LS
from ..operators import papers as PP
from ..session import scratch_path
from ..sources import pages as PG
from ..sources.tables import read_table
from ..streaming import collector as COL
from . import sqlfrag as S
from .registry import query

TARGET_YEAR = 24
TRACKS_PER_PAGE = 8


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages")


@query(
    "page_extract",
    """SELECT page_id,
       nullif(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '') AS title_raw,
       nullif(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), '') AS html_title,
       nullif(regexp_extract(html, '<html[^>]*lang="([A-Za-z-]+)"', 1), '') AS lang,
       nullif(regexp_extract(regexp_extract(html, '<a\\s(?:[^>]*\\s)?(?:rel|class)="(?:[^"]*\\s)?next(?:\\s[^"]*)?"[^>]*>'), '\\shref="([^"]*)"', 1), '') AS next_url
FROM pages""",
    "A5 H7 H9 (regex fast path over stored pages)",
)
def page_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pages(spark, sf_dir)
    return p.select(
        "page_id",
        PG.first_h1_raw("html").alias("title_raw"),
        F.nullif(F.regexp_extract("html", PG.TITLE_PATTERN, 1), F.lit("")).alias("html_title"),
        PG.page_lang("html").alias("lang"),
        PG.next_page_url("html").alias("next_url"),
    )


def _decode(x: str) -> str:
    """Entity decoding for the oracle: the references present in the pages,
    including the legacy forms without ``;`` that HTML (and html.parser)
    decode; ``&amp`` last so decoded ampersands are not decoded again."""
    pairs = (
        ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''"),
        ("&quot", '"'), ("&lt", "<"), ("&gt", ">"),
        ("&amp;", "&"), ("&amp", "&"),
    )
    for ent, ch in pairs:
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


_ARTICLE = "regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1)"
_ARTICLE_TEXT = (
    f"regexp_replace(regexp_replace({_ARTICLE}, '(?s)<h1[^>]*>.*?</h1>', '', 'g'), '<[^>]*>', '', 'g')"
)
_NAV = "regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1)"


PAGE_TITLE_SQL = S.strip(_decode("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"))
PAGE_ABSTRACT_SQL = S.strip(_decode(_ARTICLE_TEXT))

PAGE_FIELDS_SQL = f"""SELECT page_id,
       {PAGE_TITLE_SQL} AS title,
       {PAGE_ABSTRACT_SQL} AS abstract,
       CAST(len(regexp_extract_all({_NAV}, '<a ', 0)) AS INTEGER) AS n_links
FROM pages"""


@query(
    "page_fields",
    PAGE_FIELDS_SQL,
    "J2 H7 (html.parser extraction with entity decoding, Arrow-batched UDF)",
)
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pages(spark, sf_dir)
    f = p.select("page_id", PG.extract_fields("html", "generic").alias("f"))
    return f.select("page_id", "f.title", "f.abstract", F.size("f.links").cast("int").alias("n_links"))


_LINKS_SQL = """WITH l AS (
  SELECT page_id,
         regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
         regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts
  FROM pages),
x AS (SELECT page_id, CAST(i AS INTEGER) AS pos, hrefs[i] AS href, texts[i] AS link_text
      FROM l, range(1, len(hrefs) + 1) AS t(i))
SELECT page_id, link_text, arg_max(href, pos) AS href, min(pos) AS pos FROM x GROUP BY page_id, link_text"""


@query("page_links", _LINKS_SQL, "H8 E5 (anchor list in order, dict semantics per link text)")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LS.page_link_dict(_pages(spark, sf_dir))


_LISTING_SQL = """WITH listing AS (
  SELECT page_id AS listing_id, 0 AS variant, url FROM pages
  UNION ALL
  SELECT page_id AS listing_id, 1 AS variant, regexp_replace(url, '[?#].*$', '') AS url FROM pages),
detail AS (SELECT url, nullif(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '') AS title FROM pages)
SELECT l.listing_id, CAST(l.variant AS INTEGER) AS variant, l.url, d.title,
       CASE WHEN d.url IS NULL THEN 'page not stored' ELSE 'ok' END AS status
FROM listing l LEFT JOIN detail d ON l.url = d.url"""


@query("listing_detail_join", _LISTING_SQL, "D5 A14 (listing rows -> stored detail pages, unmatched to rejects)")
def listing_detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pages(spark, sf_dir)
    # both listing variants of a page come from one scan (narrow explode)
    variants = F.array(F.col("url"), F.regexp_replace("url", r"[?#].*$", ""))
    listing = p.select(F.col("page_id").alias("listing_id"), F.posexplode(variants).alias("variant", "url"))
    # extract before the join so only (url, title) is shuffled, not the html
    detail = p.select("url", PG.first_h1_raw("html").alias("title"))
    matched, rejects = LS.detail_join(listing, detail)
    return matched.select("listing_id", "variant", "url", "title", F.lit("ok").alias("status")).unionByName(
        rejects.select("listing_id", "variant", "url", F.lit(None).cast("string").alias("title"), F.col("reason").alias("status"))
    )


# --- the collector, on listing pages derived from pages -----------------------

LINKS_PER_LISTING = 20

# Stored detail pages of the collector queries: some have lost their content.
STORED_CTE = f"""WITH pages_ AS (
  SELECT page_id, url, CASE WHEN page_id % 9 = 4 THEN regexp_replace(html, '(?s)<article.*</article>', '') ELSE html END AS html
  FROM pages),
f AS (SELECT page_id, url, {PAGE_TITLE_SQL} AS title, {PAGE_ABSTRACT_SQL} AS abstract FROM pages_)"""


def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.regexp_replace("html", "(?s)<article.*</article>", "")
    html = F.when(F.col("page_id") % 9 == 4, cut).otherwise(F.col("html")).alias("html")
    return _pages(spark, sf_dir).select("page_id", "url", html)


def listing_pages(pages: DataFrame) -> DataFrame:
    """Listing pages ``(listing_id, html)``: ``LINKS_PER_LISTING`` entries each;
    some entries link to a page's address without query and fragment, some
    are there twice."""
    pid = F.col("page_id")
    href = F.when(pid % 7 == 3, F.regexp_replace("url", r"[?#].*$", "")).otherwise(F.col("url"))
    entry = F.concat(F.lit('<dt class="ptitle"><a class="link" href="'), href, F.lit('"><b>paper</b> '), pid.cast("string"), F.lit("</a></dt>"))
    entry = F.when(pid % 5 == 0, F.concat(entry, entry)).otherwise(entry)
    # at most LINKS_PER_LISTING rows of a group by its definition
    entries = F.transform(F.array_sort(F.collect_list(F.struct(pid, entry.alias("e")))), lambda x: x["e"])
    groups = pages.groupBy(F.expr(f"page_id div {LINKS_PER_LISTING}").alias("listing_id"))
    return groups.agg(F.concat(F.lit("<html><body><dl>"), F.array_join(entries, "\n"), F.lit("</dl></body></html>")).alias("html"))


_COLLECT_SQL = (
    STORED_CTE
    + f""",
k AS (SELECT *, {S.title_key('title')} AS title_key FROM f),
saved AS (SELECT url, title_key FROM k WHERE page_id % 10 = 0 AND title <> '' AND abstract <> ''),
entry AS (SELECT page_id AS place, CASE WHEN page_id % 7 = 3 THEN regexp_replace(url, '[?#].*$', '') ELSE url END AS url FROM pages),
todo AS (SELECT url, min(place) AS place FROM entry WHERE url NOT IN (SELECT url FROM saved) GROUP BY url),
one AS (SELECT * FROM k WHERE page_id = (SELECT min(o.page_id) FROM k o WHERE o.url = k.url)),
done AS (
  SELECT t.url, t.place, title, abstract, title_key,
         CASE WHEN one.url IS NULL THEN 'page not stored' WHEN title = '' THEN 'missing title'
              WHEN abstract = '' THEN 'missing abstract' END AS reason
  FROM todo t LEFT JOIN one ON one.url = t.url),
fresh AS (SELECT * FROM done WHERE reason IS NULL AND (title_key = '' OR title_key NOT IN (SELECT title_key FROM saved)))"""
)


def _collected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = stored_pages(spark, sf_dir)
    f = pages.filter(F.col("page_id") % 10 == 0).select("url", PG.extract_fields("html", "generic").alias("f"))
    f = f.select("url", "f.title", "f.abstract").filter("title <> '' AND abstract <> ''")
    saved = PP.with_title_key(f).select("url", "title_key")
    return collect_job(spark, listing_pages(_pages(spark, sf_dir)), pages, saved)


@query(
    "collect_pages",
    _COLLECT_SQL
    + """
SELECT url, title, abstract FROM fresh a
WHERE title_key = '' OR place = (SELECT min(b.place) FROM fresh b WHERE b.title_key = a.title_key)""",
    "H8 D1 D5 J2 C5 E4 D2 (the collector: listing pages -> links -> stored pages -> new papers)",
)
def collect_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collected(spark, sf_dir)[0].select("url", "title", "abstract")


@query("collect_rejects", _COLLECT_SQL + "\nSELECT url, reason FROM done WHERE reason IS NOT NULL", "A14 D5 C5 (rejects of the collector)")
def collect_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collected(spark, sf_dir)[1]


@query(
    "collect_stream",
    _COLLECT_SQL
    + """
SELECT url, title, abstract, NULL AS reason FROM fresh a
WHERE title_key = '' OR place = (SELECT min(b.place) FROM fresh b WHERE b.title_key = a.title_key)
UNION ALL SELECT url, NULL, NULL, reason FROM done WHERE reason IS NOT NULL""",
    "I1 H8 D5 D2 A14 (the collector as a stream: links and pages arrive in parts and in either order)",
)
def collect_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = stored_pages(spark, sf_dir)
    f = pages.filter(F.col("page_id") % 10 == 0).select("url", PG.extract_fields("html", "generic").alias("f"))
    saved = PP.with_title_key(f.select("url", "f.title", "f.abstract").filter("title <> '' AND abstract <> ''")).select("url", "title_key")
    listings = listing_pages(_pages(spark, sf_dir))
    root = scratch_path(spark, f"collector-{uuid.uuid4().hex}")
    first = F.col("page_id") % 3 == 0
    for k, (some_pages, some_listings) in enumerate(((first, F.col("listing_id") % 2 == 0), (~first, F.col("listing_id") % 2 == 1))):
        pages.where(some_pages).write.parquet(f"{root}/pages/drop={k}")
        listings.where(some_listings).write.parquet(f"{root}/listings/drop={k}")
        COL.collect_stream(spark, f"{root}/listings", f"{root}/pages", f"{root}/rows", f"{root}/_checkpoint").awaitTermination()
    papers, rejects = COL.collected(spark, f"{root}/rows", saved)
    return papers.select("url", "title", "abstract").unionByName(rejects, allowMissingColumns=True)


@query(
    "scoped_links",
    f"""WITH l AS (SELECT page_id, regexp_extract_all({_NAV}, '<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1, 's') AS hrefs,
  regexp_extract_all({_NAV}, '<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2, 's') AS texts FROM pages),
x AS (SELECT page_id, CAST(i AS INTEGER) AS pos, hrefs[i] AS h, regexp_replace(texts[i], '<[^>]*>', '', 'g') AS t FROM l, range(1, len(hrefs) + 1) AS r(i))
SELECT page_id, pos, {_decode("t")} AS link_text, {_decode("h")} AS href FROM x""",
    "H8 (links of the listing container only)",
)
def scoped_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LS.scoped_links(_pages(spark, sf_dir), "generic")


# --- the sequential collectors and the next-page walk ---------------------------


def _retitled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Listing and detail pages whose titles depend on each other: entry
    ``page_id`` is called Title ``page_id % 50``, its page Title ``page_id * 7 % 60``."""
    pid = F.col("page_id")
    p = stored_pages(spark, sf_dir)
    heading = F.concat(F.lit("<h1>Title "), (pid * 7 % 60).cast("string"), F.lit("</h1>"))
    html = F.regexp_replace("html", F.lit("(?s)<h1[^>]*>.*?</h1>"), heading)
    link = F.concat(F.lit('<a href="/'), pid.cast("string"), F.lit('">Title '), (pid % 50).cast("string"), F.lit("</a>"))
    return p.select(pid.alias("listing_id"), link.alias("html")), p.select("page_id", F.concat(F.lit("/"), pid.cast("string")).alias("url"), html.alias("html"))


def _sequential_sql(page_title: str, missing_title: str) -> str:
    return f"""
WITH RECURSIVE {STORED_CTE.removeprefix("WITH ")},
e AS (SELECT row_number() OVER (ORDER BY page_id) AS i, '/' || page_id AS url, 'Title ' || (page_id % 50) AS link, {page_title} AS title,
  CASE WHEN {missing_title} THEN 'missing title' WHEN abstract = '' THEN 'missing abstract' END AS reason FROM f),
w AS (
  SELECT CAST(0 AS BIGINT) AS i, ['title3', 'title11'] AS seen, false AS taken
  UNION ALL
  SELECT e.i, CASE WHEN NOT list_contains(seen, lower(replace(link, ' ', ''))) AND reason IS NULL THEN list_append(seen, lower(replace(title, ' ', ''))) ELSE seen END,
    NOT list_contains(seen, lower(replace(link, ' ', '')))
  FROM w JOIN e ON e.i = w.i + 1
)
SELECT url, title, reason FROM w JOIN e USING (i) WHERE taken"""


def _sequential(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    listings, pages = _retitled(spark, sf_dir)
    saved = spark.createDataFrame([("title3",), ("title11",), ("",)], "title_key string")
    papers, rejects = collect_sequential(spark, listings, pages, saved, rule, layout="generic")
    number = F.regexp_extract("url", "[0-9]+", 0).cast("long")
    title = number * 7 % 60 if rule == CVF else number % 50
    shown = rejects.select("url", F.concat(F.lit("Title "), title.cast("string")).alias("title"), "reason")
    return papers.select("url", "title", F.lit(None).cast("string").alias("reason")).unionByName(shown)


@query("collect_cvf", _sequential_sql("'Title ' || (page_id * 7 % 60)", "f.title = ''"), "E4 D2 D5 A14 (sequential keys: the page's title is added after each save)")
def collect_cvf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sequential(spark, sf_dir, CVF)


@query("collect_eccv", _sequential_sql("'Title ' || (page_id % 50)", "false"), "E4 D2 D5 A14 (sequential keys: title and key from the listing)")
def collect_eccv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sequential(spark, sf_dir, ECCV)


@query(
    "next_page_walk",
    f"""WITH RECURSIVE n AS (SELECT page_id AS id, CASE WHEN page_id % {TRACKS_PER_PAGE} <> 7 THEN page_id + 1 END AS nxt FROM pages),
w AS (
  SELECT id AS first, 0 AS step, id FROM n WHERE id % {TRACKS_PER_PAGE} = 0
  UNION ALL SELECT w.first, w.step + 1, m.id FROM w JOIN n ON n.id = w.id JOIN n m ON m.id = n.nxt
)
SELECT '/list/' || first AS start, CAST(step AS INTEGER) AS step, '/list/' || id AS url FROM w""",
    "H9 (archives of listing pages followed by their next-page links)",
)
def next_page_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    pid = F.col("page_id")
    to = F.concat(F.lit("/list/"), (pid + 1).cast("string"))
    # the link's attributes in both orders, next as one of several class words
    link = F.when(pid % 2 == 0, F.concat(F.lit('<a rel="next" href="'), to, F.lit('">'))).otherwise(F.concat(F.lit('<a href="'), to, F.lit('" class="page next">')))
    html = F.concat(F.lit("<nav>"), F.when(pid % TRACKS_PER_PAGE != 7, link).otherwise(F.lit("")), F.lit("</nav>"), F.coalesce("html", F.lit("")))
    pages = _pages(spark, sf_dir).select(F.concat(F.lit("/list/"), pid.cast("string")).alias("url"), html.alias("html"), "page_id")
    return LS.walk_next(pages, pages.where(pid % TRACKS_PER_PAGE == 0))


# --- issue archive derived from pages ----------------------------------------


def tracks_from_pages(pages: DataFrame) -> DataFrame:
    """One track link per page: archive ``venue`` = page language, archive
    page ``page_no`` and in-page ``pos`` from ``page_id``, a label whose year
    falls with the page number, and a missing href on some rows."""
    pid = F.col("page_id")
    page_no = F.expr(f"page_id div {TRACKS_PER_PAGE}") + 1
    pos = pid % TRACKS_PER_PAGE + 1
    yy = (F.lit(26) - F.expr(f"((page_id div {TRACKS_PER_PAGE} + 1) div 3) % 11")).cast("string")
    kind = pid % 5
    title = (
        F.when(kind == 0, F.concat(F.lit("AAAI-"), yy, F.lit(" Technical Tracks "), pos.cast("string")))
        .when(kind == 1, F.concat(F.lit("Technical Tracks Vol. "), pid.cast("string"), F.lit(" (20"), yy, F.lit(")")))
        .when(kind == 2, F.lit("Technical Tracks Special Issue"))
        .when(kind == 3, F.concat(F.lit("Student Abstracts 20"), yy))
        .otherwise(F.concat(F.lit("AAAI-"), yy, F.lit(" Technical Tracks Posters")))
    )
    return pages.select(
        F.coalesce(PG.page_lang("html"), F.lit("")).alias("venue"),
        page_no.alias("page_no"),
        pos.alias("pos"),
        title.alias("track_title"),
        F.when(pid % 11 == 10, F.lit(None).cast("string")).otherwise(F.col("url")).alias("track_url"),
    )


_TRACKS_SQL = f"""WITH t AS (
  SELECT coalesce(nullif(regexp_extract(html, '<html[^>]*lang="([A-Za-z-]+)"', 1), ''), '') AS venue,
         page_id // {TRACKS_PER_PAGE} + 1 AS page_no,
         page_id % {TRACKS_PER_PAGE} + 1 AS pos,
         CAST(26 - ((page_id // {TRACKS_PER_PAGE} + 1) // 3) % 11 AS VARCHAR) AS yy,
         page_id % 5 AS kind, page_id, url
  FROM pages),
t2 AS (
  SELECT venue, page_no, pos,
         CASE kind WHEN 0 THEN 'AAAI-' || yy || ' Technical Tracks ' || CAST(pos AS VARCHAR)
                   WHEN 1 THEN 'Technical Tracks Vol. ' || CAST(page_id AS VARCHAR) || ' (20' || yy || ')'
                   WHEN 2 THEN 'Technical Tracks Special Issue'
                   WHEN 3 THEN 'Student Abstracts 20' || yy
                   ELSE 'AAAI-' || yy || ' Technical Tracks Posters' END AS track_title,
         CASE WHEN page_id % 11 = 10 THEN NULL ELSE url END AS track_url
  FROM t),
f AS (SELECT * FROM t2 WHERE track_title LIKE '%Technical Tracks%' AND track_url IS NOT NULL),
r AS (
  SELECT *, CAST(coalesce(nullif(regexp_extract(track_title, 'AAAI-([0-9]{{2}})', 1), ''),
                          nullif(regexp_extract(track_title, '20([0-9]{{2}})', 1), '')) AS INTEGER) AS year
  FROM f),
r2 AS (
  SELECT *, CASE WHEN year IS NULL OR year = {TARGET_YEAR} THEN 'process'
                 WHEN year > {TARGET_YEAR} THEN 'skip' ELSE 'stop' END AS route
  FROM r)"""


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = LS.technical_tracks(tracks_from_pages(_pages(spark, sf_dir)))
    return LS.route_tracks(tracks, TARGET_YEAR)


@query(
    "issue_year_route",
    _TRACKS_SQL + "\nSELECT venue, page_no, pos, track_title, year, route FROM r2",
    "H4 C2 C4 (track label -> year -> process/skip/stop)",
)
def issue_year_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select("venue", "page_no", "pos", "track_title", "year", "route")


@query(
    "issue_take_while",
    _TRACKS_SQL
    + f""",
alive AS (
  SELECT * FROM r2 a WHERE NOT EXISTS (
    SELECT 1 FROM r2 o WHERE o.venue = a.venue AND o.year < {TARGET_YEAR}
      AND (o.page_no < a.page_no OR (o.page_no = a.page_no AND o.pos <= a.pos)))),
last_page AS (SELECT venue, min(page_no) AS lp FROM alive WHERE year = {TARGET_YEAR} GROUP BY venue)
SELECT a.venue, a.page_no, a.pos, a.track_title, a.year
FROM alive a LEFT JOIN last_page l ON a.venue = l.venue
WHERE (l.lp IS NULL OR a.page_no <= l.lp) AND a.route = 'process'""",
    "C3 F6 (ordered crawl with early stop, as aggregations per archive)",
)
def issue_take_while(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = LS.take_while(_routed(spark, sf_dir), TARGET_YEAR, ["venue"])
    return kept.select("venue", "page_no", "pos", "track_title", "year")


@query(
    "issue_page_flags",
    _TRACKS_SQL
    + f"""
SELECT venue, page_no, coalesce(bool_or(year = {TARGET_YEAR}), false) AS found_target,
       coalesce(bool_or(year < {TARGET_YEAR}), false) AS any_older, CAST(count(*) AS BIGINT) AS n_tracks
FROM r2 GROUP BY venue, page_no""",
    "E6 (any/all flags per archive page)",
)
def issue_page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LS.page_flags(_routed(spark, sf_dir), TARGET_YEAR, ["venue"])
