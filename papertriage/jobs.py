"""End-to-end jobs: what the original scripts do, as Spark jobs.

* ``triage_job``: paper table + reference papers -> normalised prompt text ->
  encoder -> similarity to every reference -> both rules -> scored, related,
  related_detailed (JSON), rejects and report tables under one output root.
* ``notes_job``: exported submission notes -> accepted paper table.
* ``pages_job``: stored listing/detail pages -> paper table and rejects.
* ``collect_sequential``: the collector with the original scripts' key rules.
* ``collect_job``: the whole collector: listing pages -> links not yet saved ->
  stored detail pages -> extraction -> new papers and rejects.

Example::

    spark = build_session()
    papers = read_paper_csv(spark, "s3://bucket/papers/*.csv", with_source=True)
    refs = spark.createDataFrame(reference_rows, "title string, abstract string")
    triage_job(spark, papers, refs, "s3://bucket/triage/run1", TriageConfig())
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .config import TriageConfig
from .functions import text as TX
from .operators import blocks as BL
from .operators import encode as EN
from .operators import listing as LS
from .operators import notes as NT
from .operators import papers as PP
from .operators import report as RP
from .operators import score as SC
from .sources import outputs as OUT
from .session import scratch_path
from .sources import pages as PG

def _with_ids(papers: DataFrame) -> DataFrame:
    """A ``paper_id`` of its own for every row, in input order, when the input
    has none; equal rows keep distinct ids."""
    if "paper_id" in papers.columns:
        return papers
    return papers.withColumn("paper_id", F.monotonically_increasing_id())


def triage_job(
    spark: SparkSession,
    papers: DataFrame,
    refs: DataFrame,
    out_root: str,
    cfg: TriageConfig = TriageConfig(),
    encoder: EN.Encoder | None = None,
    exclude_ref_titles: bool = False,
) -> dict:
    """Score every paper against the reference papers and write the outputs.

    ``papers``: ``title, abstract`` (+ optional ``url, venue, paper_id``).
    ``refs``: ``title, abstract`` (+ optional ``ref_id``), of any number: up to
    ``cfg.max_reference_bytes`` they are broadcast, beyond it scored in blocks.
    ``encoder``: a factory for a batch encoder (``encode_with``); the default
    is the lexical hashing encoder, whose thresholds differ from a model's.
    Returns the output paths and, under ``summary``, the run counts.
    """
    papers = _with_ids(papers)
    tagged = papers.withColumn("reason", PP.reject_reason(F.col("title"), F.col("abstract")))
    kept = tagged.filter(F.col("reason").isNull()).drop("reason")
    rejects = tagged.filter(F.col("reason").isNotNull())

    if "ref_id" not in refs.columns:
        refs = refs.withColumn("ref_id", F.monotonically_increasing_id())
    # equal normalised titles are one reference before anything is encoded
    refs = SC.collapse_reference_titles(refs.select("ref_id", "title", "abstract"))
    ref_emb = EN.embed_papers(refs, encoder, cfg.batch_size)
    ref_rows = ref_emb.select("ref_id", "embedding", "title")
    embedded = EN.embed_papers(kept, encoder, cfg.batch_size)
    rejects = rejects.select(*[c for c in ("paper_id", "title", "url", "reason") if c in rejects.columns])
    if exclude_ref_titles:
        embedded = SC.exclude_titles(embedded, refs)
    stats = SC.reference_stats(ref_rows, "embedding", "title")
    if stats.n_bytes <= cfg.max_reference_bytes:
        ref_set = SC.collect_reference_set(ref_rows, "ref_id", "embedding", "title", cfg.max_reference_bytes, stats)
        scored = SC.score_papers(embedded, ref_set, cfg)
        return write_triage_outputs(spark, scored, ref_set, out_root, cfg, rejects=rejects)
    # beyond the broadcast bound: both sides as matrix blocks, paired in a grid
    scored = BL.score_blocks(BL.with_row_key(embedded), ref_rows, cfg)
    return write_triage_outputs(spark, scored, None, out_root, cfg, rejects=rejects, refs=ref_rows)


def write_triage_outputs(
    spark: SparkSession,
    scored: DataFrame,
    ref_set: SC.ReferenceSet | None,
    out_root: str,
    cfg: TriageConfig,
    texts: DataFrame | None = None,
    rejects: DataFrame | None = None,
    refs: DataFrame | None = None,
) -> dict:
    """Write ``scored`` once, then derive ``related`` (CSV, ranked),
    ``related_detailed`` (JSON lines with the similarity map) and ``report``
    from the written table, so the scoring runs a single time.

    The scored table keeps the per-reference similarities of related papers
    only. ``texts`` (``paper_id, title, abstract``) supplies titles when
    ``scored`` has none. Without ``ref_set``, ``scored`` comes from
    ``score_blocks`` and ``refs`` (``ref_id, title, embedding``) are paired
    again with the related rows only. The tables are one version under the
    root and appear together (``sources.outputs.published``). Returns the paths and the run counts
    (``summary``), gathered by an ``Observation`` during the write (no extra
    job)."""
    keep_cols = [c for c in ("paper_id", "title", "abstract", "url", "venue") if c in scored.columns]
    when_related = lambda c: F.when(F.col("is_related"), F.col(c))
    shown = [BL.ROW, when_related("embedding").alias("embedding")] if ref_set is None else [when_related("sims").alias("related_sims")]
    scored_out = scored.select(
        *keep_cols,
        "mean_similarity",
        "n_top_above",
        "is_related",
        "reason",
        *shown,
    )
    summary = Observation("triage_summary")
    scored_out = scored_out.observe(
        summary,
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col("is_related")).alias("n_related"),
        F.count_if(F.col("reason") == "mean").alias("n_mean_rule"),
        F.count_if(F.col("reason") == "top_k").alias("n_top_k_rule_only"),
    )
    out = OUT.Publication(spark, out_root)
    paths = dict(out.write({"scored": scored_out}))
    paths["summary"] = summary.get
    saved = spark.read.parquet(paths["scored"])
    related = saved.filter(F.col("is_related"))
    if texts is not None:
        related = related.join(texts.select("paper_id", "title", "abstract"), "paper_id", "left")
    if ref_set is None:
        related = BL.related_detail(related, refs, cfg).drop("embedding")
    else:
        related = SC.sorted_detail(related.withColumnRenamed("related_sims", "sims"), ref_set).drop("sims")
    detailed = RP.ranked_output(related).select(
        "title",
        "abstract",
        F.col("mean_similarity").alias("mean_abstract_similarity"),
        OUT.similarity_map("detail", ref_set).alias("detailed_similarities"),
    )
    report = RP.numbered_report(
        related.select("paper_id", "title", "abstract", "detail", "mean_similarity", "n_top_above", "reason"), ref_set, cfg
    )
    tables = {
        "related": RP.ranked_output(related).select(
            "title", "abstract", F.col("mean_similarity").alias("mean_abstract_similarity")
        ),
        "related_detailed": detailed,
        "report": report,
    }
    if rejects is not None:
        tables["rejects"] = rejects
    paths.update(out.write(tables, fmt={"related": "csv", "related_detailed": "json"}))
    out.commit()
    return paths


def notes_job(notes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested notes -> (accepted ``title, abstract, url``, rejects)."""
    flat = NT.flatten_notes(notes)
    return NT.accepted(flat).select("title", "abstract", "url"), NT.note_rejects(flat)


def pages_job(
    listing: DataFrame, pages: DataFrame, layout: str = "generic", key: str = "url"
) -> tuple[DataFrame, DataFrame]:
    """Listing rows (``url`` + any listing columns) and stored detail pages
    ``(url, html)`` -> (paper rows ``title, abstract, url``, rejects).

    Only pages that the listing names are parsed, once: the joined rows are
    written to the scratch folder and both outputs read them. Listing rows
    without a stored page and pages without a usable title/abstract are
    rejects."""
    spark = pages.sparkSession
    path = scratch_path(spark, f"pages-{uuid.uuid4().hex}")
    wanted = pages.join(listing.select(key).distinct(), key, "left_semi")
    fields = wanted.select(key, PG.extract_fields("html", layout).alias("f")).select(
        key, F.col("f.title").alias("title"), F.col("f.abstract").alias("abstract")
    )
    matched, missing = LS.detail_join(listing.select(key), fields, key)
    tagged = matched.withColumn("reason", PP.reject_reason(F.col("title"), F.col("abstract")))
    tagged.unionByName(missing.select(key, "reason"), allowMissingColumns=True).write.parquet(path)
    usable = spark.read.parquet(path)
    papers = usable.filter(F.col("reason").isNull()).select("title", "abstract", key)
    rejects = usable.filter(F.col("reason").isNotNull()).select(key, "reason")
    return papers, rejects


def collect_job(
    spark: SparkSession,
    listings: DataFrame,
    pages: DataFrame,
    saved: DataFrame,
    layout: str = "generic",
    listing_id: str = "listing_id",
    listing_layout: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The collector as one batch job: (new papers ``url, title, abstract,
    title_key, listing_id, pos``, rejects ``url, reason``).

    ``listings``: ``(listing_id, html)`` stored listing pages; ``pages``:
    ``(page_id, url, html)`` stored detail pages; ``saved``: ``(url,
    title_key)`` of the papers already collected. Links are taken in listing
    order (H8), a URL counts once at its first place, saved URLs are left out
    (D1). Of several stored pages of one URL the first is read. Links without
    stored page and pages without title or abstract are rejects (D5, C5, A14).
    ``listing_layout`` takes links from that layout's listing container only.
    Of equal title keys the first in listing order is kept (E4) unless a saved
    paper has it (D2); an empty key matches nothing.

    Only pages that new links name are extracted, and once: the joined rows
    are written to the scratch folder, and both outputs read that table. Every
    step per key is a partial aggregation or a join, so no listing, URL or
    title key is gathered in one task.
    """
    links = _listing_links(listings, listing_id, listing_layout).select(F.col("href").alias("url"), F.struct(listing_id, "pos").alias("place"))
    first = links.groupBy("url").agg(F.min("place").alias("place"))
    path = scratch_path(spark, f"collect-{uuid.uuid4().hex}")
    PP.not_already_saved(first, saved, "url").write.parquet(f"{path}/todo")
    todo = spark.read.parquet(f"{path}/todo")
    fields = pages.join(todo.select("url"), "url", "left_semi").select("page_id", "url", PG.extract_fields("html", layout).alias("f")).select(
        "page_id", "url", F.col("f.title").alias("title"), F.col("f.abstract").alias("abstract")
    )
    stored = PP.keep_first_per_key(fields, "url", "page_id").withColumn("_stored", F.lit(True))
    reason = F.when(F.col("_stored").isNull(), F.lit("page not stored")).otherwise(
        PP.reject_reason(F.col("title"), F.col("abstract"))
    )
    tagged = PP.with_title_key(todo.join(stored, "url", "left").withColumn("reason", reason))
    tagged.drop("_stored", "page_id").write.parquet(f"{path}/read")
    return collected_papers(spark.read.parquet(f"{path}/read"), saved, listing_id)


def _listing_links(listings: DataFrame, listing_id: str, layout: str | None) -> DataFrame:
    return LS.page_links(listings, listing_id) if layout is None else LS.scoped_links(listings, layout, listing_id)


def collected_papers(done: DataFrame, saved: DataFrame, listing_id: str = "listing_id") -> tuple[DataFrame, DataFrame]:
    """(new papers, rejects) of the entries read: ``url, place, title,
    abstract, title_key, reason``."""
    usable = done.filter(F.col("reason").isNull()).drop("reason")
    fresh = PP.not_already_saved(usable, saved.filter("title_key <> ''"), "title_key")
    kept = PP.keep_first_nonempty(fresh, "title_key", "place")
    papers = kept.select("url", "title", "abstract", "title_key", f"place.{listing_id}", "place.pos")
    return papers, done.filter(F.col("reason").isNotNull()).select("url", "reason")


# key rules of the sequential collectors: whether link texts make a dict (the
# last href of a text counts, at its first place), and whose title is saved
CVF, ECCV = "cvf", "eccv"


def collect_sequential(
    spark: SparkSession,
    listings: DataFrame,
    pages: DataFrame,
    saved: DataFrame,
    rule: str = CVF,
    layout: str | None = None,
    listing_id: str = "listing_id",
    listing_layout: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The collector as the sequential scripts run it: (papers ``url, title,
    abstract, listing_id, pos``, rejects ``url, reason``).

    A listing entry is skipped before its page is read when the key of its
    link text is among the saved keys or the keys added so far; a paper that
    is saved adds a key: of the page's title (``cvf``) or of the link text,
    which is also its title (``eccv``). Entries without stored page, title or
    abstract are rejects and add no key. Only wanted pages are parsed; of
    several stored pages of one URL the first is read. Empty keys match nothing.
    ``listing_layout`` takes links from that layout's listing container only.
    """
    if rule not in (CVF, ECCV):
        raise ValueError(f"unknown rule {rule!r}")
    links = _listing_links(listings, listing_id, listing_layout)
    if rule == CVF:
        links = LS.link_dict(links, listing_id)
    entries = links.select(F.struct(listing_id, "pos").alias("place"), F.col("href").alias("url"), "link_text", TX.title_key("link_text").alias("listing_key"))
    known = saved.filter("title_key <> ''").select(F.col("title_key").alias("listing_key"))
    todo = PP.not_already_saved(entries, known, "listing_key")
    base = scratch_path(spark, f"collect-{uuid.uuid4().hex}")
    todo.write.parquet(f"{base}/todo")
    todo = spark.read.parquet(f"{base}/todo")
    wanted = PP.keep_first_per_key(pages.join(todo.select("url").distinct(), "url", "left_semi").select("url", "page_id"), "url", "page_id")
    fields = pages.join(wanted, ["url", "page_id"], "left_semi").select("url", PG.extract_fields("html", layout or rule).alias("f"))
    stored = fields.select("url", F.col("f.title").alias("page_title"), F.col("f.abstract").alias("abstract"), F.lit(True).alias("_stored")).dropDuplicates(["url"])
    title = F.col("page_title") if rule == CVF else TX.py_strip(F.col("link_text"))
    reason = F.when(F.col("_stored").isNull(), F.lit("page not stored")).otherwise(PP.reject_reason(F.col("title"), F.col("abstract")))
    tagged = todo.join(stored, "url", "left").withColumn("title", title).withColumn("reason", reason)
    tagged = tagged.withColumn("page_key", F.when(F.col("reason").isNull(), TX.title_key("title"))).drop("_stored", "page_title")
    tagged.write.parquet(f"{base}/read")
    taken = PP.keep_sequential(spark.read.parquet(f"{base}/read"), "listing_key", "page_key", "place")
    papers = taken.filter(F.col("reason").isNull()).select("url", "title", "abstract", f"place.{listing_id}", "place.pos")
    return papers, taken.filter(F.col("reason").isNotNull()).select("url", "reason")
