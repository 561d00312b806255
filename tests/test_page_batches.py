"""Pages reach the workers in small batches, whatever the session's setting."""

from pyspark.sql import functions as F

from papertriage.session import BATCH_ROWS
from papertriage.sources import pages as PG


def test_page_batches_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        pages = spark.range(2500).select("id", F.format_string("<h1>T%d</h1><article>a</article>", "id").alias("html")).coalesce(1)
        got = pages.select("id", PG.extract_fields("html")["title"].alias("t"), PG.extract_fields("html")["abstract"].alias("a"))
        assert int(spark.conf.get(key)) == BATCH_ROWS
        assert got.where(F.concat(F.lit("T"), "id") != F.col("t")).isEmpty() and got.where("a = 'a'").count() == 2500
    finally:
        spark.conf.set(key, before)
