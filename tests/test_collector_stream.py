"""The streaming collector gives the batch collector's rows in any order of
arrival, and a replayed batch changes nothing."""

import uuid

from pyspark.sql import functions as F

from papertriage import jobs
from papertriage.plans import pages_queries as PQ
from papertriage.session import scratch_path
from papertriage.streaming import collector as COL

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_in_either_order(spark):
    pages = PQ.stored_pages(spark, SF).cache()
    listings = PQ.listing_pages(PQ._pages(spark, SF)).cache()
    saved = spark.createDataFrame([("nowhere", "nokey")], "url string, title_key string")
    want = [sorted(map(repr, d.collect())) for d in jobs.collect_job(spark, listings, pages, saved)]
    even = F.col("page_id") % 2 == 0
    for order in ([("listings", listings), ("pages", pages)], [("pages", pages.where(even)), ("listings", listings), ("pages", pages.where(~even))]):
        root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
        for name in ("pages", "listings"):  # both folders are there from the start
            dict(pages=pages, listings=listings)[name].where("false").write.parquet(f"{root}/{name}/drop=0")
        for k, (name, rows) in enumerate(order, 1):
            rows.write.parquet(f"{root}/{name}/drop={k}")
            COL.collect_stream(spark, f"{root}/listings", f"{root}/pages", f"{root}/rows", f"{root}/_checkpoint").awaitTermination()
        columns = [want_df.columns for want_df in jobs.collect_job(spark, listings, pages, saved)]
        got = [sorted(map(repr, d.select(*c).collect())) for d, c in zip(COL.collected(spark, f"{root}/rows", saved), columns)]
        assert got == want
    # everything is read again by a run that lost its checkpoint
    COL.collect_stream(spark, f"{root}/listings", f"{root}/pages", f"{root}/rows", f"{root}/_checkpoint2").awaitTermination()
    got = [sorted(map(repr, d.select(*c).collect())) for d, c in zip(COL.collected(spark, f"{root}/rows", saved), columns)]
    assert got == want
