"""The collector as a stream: listing pages and stored detail pages arrive in
any order (H8, D5, D2, A14, I1).

Keyed state holds one row per URL: the first place a listing names it and the
first stored page of it. A link waits for its page and a page for its link; every
change is appended to the target as a new version of the URL's row. A batch
writes a folder of its own, so a replayed batch replaces what it wrote before.
``collected`` reads the last versions: links without page are rejects for as
long as none has come.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import text as TX
from ..jobs import collected_papers
from ..operators import listing as LS
from ..operators import papers as PP
from ..sources import pages as PG
from ..sources.tables import read_or_empty

LISTING_SCHEMA = T.StructType([T.StructField("listing_id", T.LongType()), T.StructField("html", T.StringType())])
_STATE = "listing_id long, pos int, page_id long, title string, abstract string, version long"
_ROW = "url string, " + _STATE


def _none(x):
    return None if pd.isna(x) else x


def _match(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The URL's row after its new links and pages, if they change it."""
    old = list(state.get) if state.exists else [None] * 5 + [0]
    place = tuple(old[:2]) if old[0] is not None else None
    page = tuple(old[2:5]) if old[2] is not None else None
    for b in batches:  # only the first place and the first page are held
        for r in b.itertuples(index=False):
            if not pd.isna(r.listing_id):
                new = int(r.listing_id), int(r.pos)
                place = new if place is None else min(place, new)
            elif page is None or r.page_id < page[0]:
                page = int(r.page_id), _none(r.title), _none(r.abstract)
    row = [*(place or (None, None)), *(page or (None, None, None))]
    if row != old[:5]:
        row.append(old[5] + 1)
        state.update(tuple(row))
        yield pd.DataFrame([[key[0], *row]], columns=["url", "listing_id", "pos", "page_id", "title", "abstract", "version"]).astype(
            {"listing_id": "Int64", "pos": "Int32", "page_id": "Int64", "version": "int64"}
        )


def collect_stream(spark: SparkSession, listings_path: str, pages_path: str, target: str, checkpoint: str, layout: str = "generic", listing_layout: str | None = None) -> StreamingQuery:
    """Start a run over what has arrived in the two folders (parquet files of
    ``listing_id, html`` and ``page_id, url, html``)."""
    listings = spark.readStream.schema(LISTING_SCHEMA).parquet(listings_path)
    links = LS.page_links(listings, "listing_id") if listing_layout is None else LS.scoped_links(listings, listing_layout, "listing_id")
    pages = spark.readStream.schema(PG.PAGE_SCHEMA).parquet(pages_path)
    fields = pages.select("page_id", "url", PG.extract_fields("html", layout).alias("f"))
    both = links.select(F.col("href").alias("url"), "listing_id", "pos").unionByName(
        fields.select("url", "page_id", F.col("f.title").alias("title"), F.col("f.abstract").alias("abstract")), allowMissingColumns=True
    )
    rows = both.where("url IS NOT NULL").groupBy("url").applyInPandasWithState(_match, _ROW, _STATE, "update", GroupStateTimeout.NoTimeout)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={epoch}")

    return rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def collected(spark: SparkSession, target: str, saved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new papers, rejects) of the rows so far, as ``jobs.collect_job`` gives them."""
    rows = read_or_empty(spark, target, T.StructType.fromDDL(_ROW))
    rest = F.struct("listing_id", "pos", "page_id", "title", "abstract")
    last = rows.groupBy("url").agg(F.max(F.struct("version", rest.alias("row"))).alias("last")).select("url", "last.row.*")
    named = last.where("listing_id IS NOT NULL").withColumn("place", F.struct("listing_id", "pos"))
    todo = PP.not_already_saved(named, saved, "url")
    reason = F.when(F.col("page_id").isNull(), F.lit("page not stored")).otherwise(PP.reject_reason(F.col("title"), F.col("abstract")))
    done = todo.withColumn("reason", reason).withColumn("title_key", TX.title_key("title"))
    return collected_papers(done.select("url", "place", "title", "abstract", "title_key", "reason"), saved)
