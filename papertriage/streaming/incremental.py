"""Incremental append-if-new and incremental scoring (I1, I2) with
Structured Streaming.

``ingest_stream``: a file source of new paper rows -> ``foreachBatch`` that
keeps the first row per key inside the micro-batch (E4), drops keys the target
table already holds (D1/D2, a left-anti join against the target itself), and
appends the rest. Keys never expire, so there is no watermark and no
``dropDuplicates`` state: the target table is the state. A replayed
micro-batch (after a failure between the write and the checkpoint commit)
finds its rows already in the target and appends nothing, so the sink is
effectively exactly-once with a single writer per target. The target is
partitioned by a hash bucket of the key; each micro-batch reads only the key
column of the buckets its keys fall into, and the adaptive plan broadcasts the
side that measures small.

``score_stream``: a file source of embedded papers -> stateless broadcast
scoring (the Arrow block product) -> append of scored rows. ``triage_stream``
does the same from texts: usable papers are encoded in the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import TriageConfig
from ..operators import encode as EN
from ..operators import papers as PP
from ..operators import score as SC
from ..sources import pages as PG
from ..sources.tables import path_exists


# Partitions of the target by key hash: a micro-batch reads only the
# partitions its own keys fall into.
KEY_BUCKETS = 256

def key_bucket(key: str, buckets: int = KEY_BUCKETS):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _append_new_batch(target_path: str, key: str, order_col: str, buckets: int):
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        firsts = PP.keep_first_per_key(batch, key, order_col).select(*batch.columns)
        firsts = firsts.withColumn("key_bucket", key_bucket(key, buckets)).persist()
        try:
            fresh = firsts
            if path_exists(spark, target_path):
                # at most ``buckets`` bucket ids; the target is read with the
                # batch's schema, so a bare folder is an empty table
                touched = [r[0] for r in firsts.select("key_bucket").distinct().collect()]
                saved = spark.read.schema(firsts.schema).parquet(target_path).select(key, "key_bucket")
                saved = saved.filter(F.col("key_bucket").isin(touched))  # partition pruning
                # a null key is one key, so that a replay finds it again; the
                # adaptive plan broadcasts the side that measures small
                keys = saved.select(F.col(key).alias("_saved_key")).distinct()
                fresh = firsts.join(keys, F.col(key).eqNullSafe(F.col("_saved_key")), "left_anti")
            # one task per touched bucket writes one file
            fresh.repartition("key_bucket").write.mode("append").partitionBy("key_bucket").parquet(target_path)
        finally:
            firsts.unpersist()

    return run


def ingest_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    target_path: str,
    checkpoint_path: str,
    key: str = "title_key",
    order_col: str = "paper_id",
    fmt: str = "parquet",
    available_now: bool = True,
    buckets: int = KEY_BUCKETS,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the append-if-new stream from ``source_dir`` into
    ``target_path`` (partitioned by ``key_bucket``). With ``available_now`` it
    processes what is there and stops (``awaitTermination`` to wait);
    ``max_files_per_trigger`` bounds the size of one micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_dir)
    fn = _append_new_batch(target_path, key, order_col, buckets)
    w = src.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def pages_stream(
    spark: SparkSession,
    source_dir: str,
    target_path: str,
    checkpoint_path: str,
    layout: str = "generic",
    key: str = "url",
    order_col: str = "page_id",
    available_now: bool = True,
    buckets: int = KEY_BUCKETS,
    max_files_per_trigger: int | None = None,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """I1 for the page collectors: stored pages ``(page_id, url, html)``
    arriving as files -> field extraction (J2) -> usable rows (C5) ->
    append-if-new by ``key`` (D1) into ``target_path``. Rows without a usable
    title and abstract never reach the target; with ``rejects_path`` they are
    appended there, once per ``key``, with their reason (A14)."""
    reader = spark.readStream.format("parquet").schema(PG.PAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_dir)
    fields = src.select(order_col, key, PG.extract_fields("html", layout).alias("f")).select(
        order_col, key, F.col("f.title").alias("title"), F.col("f.abstract").alias("abstract")
    )
    tagged = fields.withColumn("reason", PP.reject_reason(F.col("title"), F.col("abstract")))
    keep = _append_new_batch(target_path, key, order_col, buckets)
    reject = _append_new_batch(rejects_path, key, order_col, buckets) if rejects_path else None

    def fn(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()  # the pages are extracted once for both tables
        try:
            keep(batch.filter(F.col("reason").isNull()).drop("reason"), epoch_id)
            if reject:
                reject(batch.filter(F.col("reason").isNotNull()).select(order_col, key, "reason"), epoch_id)
        finally:
            batch.unpersist()

    w = tagged.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def score_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    refs: SC.ReferenceSet,
    cfg: TriageConfig,
    sink_path: str,
    checkpoint_path: str,
    id_col: str = "paper_id",
    emb_col: str = "embedding",
    related_only: bool = True,
    available_now: bool = True,
) -> StreamingQuery:
    """Score each new paper once against the broadcast references and
    append the (related) rows. Stateless: no shuffle, no state store."""
    src = spark.readStream.format("parquet").schema(schema).load(source_dir)
    return _score_rows(src, refs, cfg, sink_path, checkpoint_path, id_col, emb_col, related_only, available_now)


def triage_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    refs: SC.ReferenceSet,
    cfg: TriageConfig,
    sink_path: str,
    checkpoint_path: str,
    encoder: EN.Encoder | None = None,
    id_col: str = "paper_id",
    related_only: bool = True,
    available_now: bool = True,
) -> StreamingQuery:
    """I2 from texts: papers ``(paper_id, title, abstract)`` arriving as files
    -> usable rows (C5) -> prompt and encoder (B2, J1) -> scores -> append.
    The references are encoded once, before the stream starts."""
    src = spark.readStream.format("parquet").schema(schema).load(source_dir)
    kept, _ = PP.split_usable(src)
    embedded = EN.embed_papers(kept, encoder, cfg.batch_size)
    return _score_rows(embedded, refs, cfg, sink_path, checkpoint_path, id_col, "embedding", related_only, available_now)


def _score_rows(
    src: DataFrame,
    refs: SC.ReferenceSet,
    cfg: TriageConfig,
    sink_path: str,
    checkpoint_path: str,
    id_col: str,
    emb_col: str,
    related_only: bool,
    available_now: bool,
) -> StreamingQuery:
    scored = SC.score_papers(src, refs, cfg, emb_col=emb_col, keep_sims=False)
    if related_only:
        scored = SC.related_only(scored)
    out = scored.select(id_col, "mean_similarity", "n_top_above", "reason")
    w = out.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.outputMode("append").start()


def run_to_end(q: StreamingQuery) -> None:
    """Wait for an ``availableNow`` run and surface its failure, if any."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
