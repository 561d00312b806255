"""URL filter: host/path rules first, link-graph trust for the rest.

The longest rule that fits a url decides it. For the other urls the host
decides: trust flows from hosts with allowed urls along links (personalised
PageRank), distrust flows from hosts with blocked urls against the links (who
links to a blocked host is itself suspect). Both run as joins and aggregations
over the host edge table. A step moves only what the step before has moved and
adds it to the hosts' standing; steps go on until no further host is reached
and what still moves is under ``TOLERANCE`` of the seeds' mass. Damping shrinks
that mass in every step, so this ends; ``MAX_STEPS`` raises an error instead of
giving a half-way result.

Host edges come from the hyperlinks in the pages; ``www.x`` and ``x`` are also
joined both ways, as one owner's. Other parent domains are not: a name such as
``co.uk`` or a hosting site is shared by hosts that have nothing in common.
Edges are aggregated to one row per (source, target) first: a host that a third of
all links touch has as many edges as it has neighbours, and its sums are
aggregated before the exchange.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


# The base rules.
RULES = (
    UrlRule("net", "/", False),
    UrlRule("example.net", "/en/", True),
    UrlRule("example.com", "/de/", False),
    UrlRule("org", "/fr/", True),
)
DAMPING = 0.85
TOLERANCE = 1e-3
STEPS_A_JOB = 6  # between two checkpoints
MAX_STEPS = 3000
# a host is blocked at this share of distrust in its total standing
BLOCK_SHARE = 0.5
# an edge between www.x and x counts as so many links
OWNER_WEIGHT = 1.0

_AFTER = r"(?s)^.*?://"
_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']?([^"'\s>]+)"""


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/ ? #`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, _AFTER + r"([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, _AFTER + r"[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """struct(rule, allow) of the longest fitting rule, else null; of equally
    long ones the earlier fits."""
    ordered = sorted(rules, key=lambda r: -len(r.text))
    return F.coalesce(
        *(
            F.when(
                ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
                F.struct(F.lit(r.text).alias("rule"), F.lit(r.allow).alias("allow")),
            )
            for r in ordered
        ),
        F.lit(None).cast("struct<rule:string,allow:boolean>"),
    )


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Host edges (src, dst, w): hyperlinks between hosts, and those of one owner.

    w is the share of src's links that go to dst. Links inside a host carry
    nothing between hosts and are left out before any exchange.
    """
    src = url_host(F.col(url_col))
    target = F.when(F.startswith("href", F.lit("//")), F.concat(F.lit("x:"), F.col("href"))).otherwise(F.col("href"))
    links = (
        pages.select(src.alias("src"), F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_HREF), F.lit(1))).alias("href"))
        .where(F.contains("href", F.lit("//")))
        .select("src", url_host(target).alias("dst"))
        .where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("n"))
    )
    hosts = links.select(F.col("src").alias("host")).union(links.select("dst")).union(pages.select(src)).where("host <> ''").distinct()
    bare = F.regexp_extract("host", r"^www\.([^.]+\..+)$", 1)
    owned = hosts.select(F.col("host").alias("src"), bare.alias("dst")).where("dst <> ''")
    both = owned.union(owned.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    edges = links.union(both.distinct().withColumn("n", F.lit(OWNER_WEIGHT))).groupBy("src", "dst").agg(F.sum("n").alias("n"))
    total = edges.groupBy("src").agg(F.sum("n").alias("total"))
    return edges.join(total, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("w"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS) -> DataFrame:
    """Trust and distrust per host: (host, trust, distrust).

    ``seeds``: (host, trusted, blocked) with non-negative weights, one row per
    host. Each vector starts from its seeds scaled to sum 1 and is damped back
    to them. Distrust goes over the reversed edges, whose weights are shared
    out anew per target. Mass at hosts without edges is not passed on.
    """
    edges = cut_lineage(edges)
    back_total = edges.groupBy("dst").agg(F.sum("w").alias("total"))
    # one edge table for both directions: kind 0 trust, kind 1 distrust
    forward = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("w"), F.lit(0).alias("way"))
    backward = edges.join(back_total, "dst").select(F.col("dst").alias("a"), F.col("src").alias("b"), (F.col("w") / F.col("total")).alias("w"), F.lit(1).alias("way"))
    table = cut_lineage(forward.union(backward))
    sums = seeds.agg(F.sum("trusted").alias("t"), F.sum("blocked").alias("d")).first()
    scale = (1.0 / sums["t"] if sums["t"] else 0.0, 1.0 / sums["d"] if sums["d"] else 0.0)
    base = cut_lineage(
        seeds.select(F.col("host"), F.lit(0).alias("kind"), (F.col("trusted") * scale[0]).alias("s"))
        .union(seeds.select("host", F.lit(1), F.col("blocked") * scale[1]))
        .where("s > 0")
    )
    rank = moving = cut_lineage(base.select("host", "kind", (F.col("s") * (1 - damping)).alias("r")))
    reached = rank.count()
    for _ in range(0, max_steps, STEPS_A_JOB):
        steps = [moving]
        for _ in range(STEPS_A_JOB):
            flow = steps[-1].join(table, (F.col("host") == F.col("a")) & (F.col("kind") == F.col("way")))
            steps.append(flow.groupBy(F.col("b").alias("host"), "kind").agg((F.sum(F.col("r") * F.col("w")) * damping).alias("r")))
        tagged = [s.withColumn("last", F.lit(k == STEPS_A_JOB)) for k, s in enumerate(steps) if k]
        moved = cut_lineage(reduce(DataFrame.union, tagged))
        moving = moved.where("last").drop("last")
        rank = cut_lineage(rank.union(moved.drop("last")).groupBy("host", "kind").agg(F.sum("r").alias("r")))
        before, (reached, left) = reached, rank.select(F.lit(1).alias("one"), F.lit(0.0).alias("r")).union(moving.select(F.lit(0), "r")).agg(F.sum("one"), F.coalesce(F.sum("r"), F.lit(0.0))).first()
        if reached in (None, before) and left <= tolerance:
            break
    else:
        raise RuntimeError(f"standing did not settle in {max_steps} steps")
    return rank.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == 0, F.col("r"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == 1, F.col("r"))), F.lit(0.0)).alias("distrust"),
    )


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, distrust_share.

    A url without ``://`` or a null url has empty host and path, fits no rule
    and is allowed. Seeds are the hosts' shares of urls that rules allow or
    block. A host without rule is blocked when distrust makes up at least
    ``BLOCK_SHARE`` of its standing and is positive; a host that no flow
    reaches is allowed. Null html has no links; null or repeated page ids and
    repeated rows are judged row by row (a repeated row counts again among the
    links and seeds). An empty table gives no rows; other columns are not read.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    judged = src.select("page_id", host.alias("host"), path.alias("path")).withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    share = lambda cond: F.avg(F.when(cond, 1.0).otherwise(0.0))
    seeds = judged.where("host <> ''").groupBy("host").agg(share(F.col("fit.allow")).alias("trusted"), share(~F.col("fit.allow")).alias("blocked"))
    standing = propagate(link_edges(src), seeds)
    # rounding keeps the verdict free of the order in which sums were added
    part = F.round(F.col("distrust") / (F.col("trust") + F.col("distrust")), 9)
    by_host = standing.where("trust + distrust > 0").select("host", part.alias("distrust_share"))
    verdict = (
        F.when(F.col("fit.allow"), "allow")
        .when(F.col("fit").isNotNull(), "block")
        .when(F.col("distrust_share") >= BLOCK_SHARE, "block")
        .otherwise("allow")
    )
    return judged.join(by_host, "host", "left").select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "distrust_share")


def _sql(least: float = 1e-7) -> str:
    """The same judgement as SQL: a recursion over the walks' length, which
    goes on while more than ``least`` of the mass moves."""
    url = "coalesce(url, '')"
    host = f"translate(regexp_extract({url}, '^.*?://([^/?#]*)', 1, 's'), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    path = f"regexp_extract({url}, '^.*?://[^/?#]*([^?#]*)', 1, 's')"
    ordered = sorted(RULES, key=lambda r: -len(r.text))
    fits = [(f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))", r) for r in ordered]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r.text}'" for c, r in fits) + " END"
    allow = "CASE " + " ".join(f"WHEN {c} THEN {str(r.allow).lower()}" for c, r in fits) + " END"
    href = "<a\\s(?:[^>]*?\\s)?href\\s*=\\s*[\"'']?([^\"''\\s>]+)"
    return f"""
    WITH RECURSIVE h AS MATERIALIZED (SELECT page_id, html, {host} AS host, {path} AS path FROM pages),
    j AS MATERIALIZED (SELECT page_id, host, path, {rule} AS rule, {allow} AS allow FROM h),
    raw AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '{href}', 1, 'is')) AS href FROM h),
    urls AS (SELECT src, CASE WHEN starts_with(href, '//') THEN 'x:' || href ELSE href END AS url FROM raw WHERE contains(href, '//')),
    ends AS (SELECT src, {host} AS dst FROM urls),
    links AS (SELECT src, dst, count(*)::DOUBLE AS n FROM ends WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
    hosts AS (SELECT src AS host FROM links UNION SELECT dst FROM links UNION SELECT host FROM h WHERE host <> ''),
    up AS (SELECT host AS src, regexp_extract(host, '^www\\.([^.]+\\..+)$', 1) AS dst FROM hosts),
    par AS (SELECT src, dst FROM up WHERE dst <> '' UNION SELECT dst, src FROM up WHERE dst <> ''),
    e AS (SELECT src, dst, sum(n) AS n FROM (SELECT * FROM links UNION ALL SELECT src, dst, {OWNER_WEIGHT} FROM par) GROUP BY ALL),
    edges AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS w FROM e),
    ways AS MATERIALIZED (SELECT src AS a, dst AS b, w, 0 AS kind FROM edges
      UNION ALL SELECT dst, src, w / sum(w) OVER (PARTITION BY dst), 1 FROM edges),
    seeds AS (SELECT host, avg(CASE WHEN allow THEN 1.0 ELSE 0.0 END) AS t, avg(CASE WHEN NOT allow THEN 1.0 ELSE 0.0 END) AS d
      FROM j WHERE host <> '' GROUP BY host),
    base AS MATERIALIZED (SELECT host, 0 AS kind, t / (SELECT sum(t) FROM seeds) AS r FROM seeds WHERE t > 0
      UNION ALL SELECT host, 1, d / (SELECT sum(d) FROM seeds) FROM seeds WHERE d > 0),
    walk AS (
      SELECT 0 AS k, host, kind, r * (1 - {DAMPING}) AS r FROM base
      UNION ALL
      SELECT k, host, kind, r FROM (
        SELECT w.k + 1 AS k, t.b AS host, t.kind, sum(w.r * t.w) * {DAMPING} AS r, sum(sum(w.r * t.w)) OVER () AS moved
        FROM walk w JOIN ways t ON w.host = t.a AND w.kind = t.kind GROUP BY ALL
      ) WHERE moved > {least}
    ),
    s AS (SELECT host, coalesce(sum(r) FILTER (kind = 0), 0) AS t, coalesce(sum(r) FILTER (kind = 1), 0) AS d FROM walk GROUP BY host)
    SELECT page_id, host, path, rule, CASE WHEN allow THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
      WHEN round(d / (t + d), 9) >= {BLOCK_SHARE} THEN 'block' ELSE 'allow' END AS verdict
    FROM j LEFT JOIN s USING (host)
    """


SQL = _sql()
