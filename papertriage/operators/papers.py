"""Curated paper table: split, usability split into kept/rejects, keep-first
per key, membership against already-saved rows, append (B1, B3, C5, A14,
E3, E4, D1, D2, G1, G2).

Skew: every per-key step is an aggregation (partial aggregation runs before
the shuffle), never a window over the key, so a key that holds a third of
all rows is combined map-side instead of landing in one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from ..session import scratch_path

PAPER_COLUMNS = ["paper_id", "title", "abstract", "url", "venue"]


def papers_from_documents(docs: DataFrame, url_prefix: str) -> DataFrame:
    """Documents -> paper rows: first line is the title, the rest the abstract.

    ``url`` is ``url_prefix + doc_id`` (B3); ``venue`` is the source."""
    return docs.select(
        F.col("doc_id").alias("paper_id"),
        TX.py_strip(TX.first_line("text")).alias("title"),
        TX.py_strip(TX.after_first_line("text")).alias("abstract"),
        TX.absolute_url(url_prefix, F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("venue"),
        "lang",
    )


def reject_reason(title: Column, abstract: Column) -> Column:
    """A row is usable when title and abstract are non-blank."""
    blank_t = title.isNull() | (TX.py_strip(title) == "")
    blank_a = abstract.isNull() | (TX.py_strip(abstract) == "")
    return F.when(blank_t, F.lit("missing title")).when(blank_a, F.lit("missing abstract"))


def split_usable(papers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects): one predicate, two outputs."""
    tagged = papers.withColumn("reason", reject_reason(F.col("title"), F.col("abstract")))
    kept = tagged.filter(F.col("reason").isNull()).drop("reason")
    rejects = tagged.filter(F.col("reason").isNotNull())
    return kept, rejects


def with_title_key(df: DataFrame, title_col: str = "title", unicode_key: bool = False) -> DataFrame:
    return df.withColumn("title_key", TX.title_key(title_col, unicode_key))


def keep_first_per_key(df: DataFrame, key: str, order_col: str, count_col: str | None = None) -> DataFrame:
    """The row with the smallest ``order_col`` per key, deterministic.

    ``groupBy(key).agg(min(struct(order, row)))``: partial aggregation keeps
    one candidate per key per map task before the shuffle."""
    others = [c for c in df.columns if c not in (key, order_col)]
    if not others:  # a plain minimum is hash-aggregated
        return df.groupBy(key).agg(F.min(order_col).alias(order_col), *([F.count(F.lit(1)).alias(count_col)] if count_col else []))
    aggs = [F.min(F.struct(F.col(order_col), *[F.col(c) for c in others])).alias("_first")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    out = df.groupBy(key).agg(*aggs)
    cols = [F.col(key), F.col(f"_first.{order_col}").alias(order_col)] + [F.col(f"_first.{c}").alias(c) for c in others]
    if count_col:
        cols.append(F.col(count_col))
    return out.select(*cols)


def keep_first_nonempty(df: DataFrame, key: str, order_col: str, count_col: str | None = None) -> DataFrame:
    """E4 in Unicode-key mode (V11): an empty or null key never matches, so
    rows without a key are all kept, the others keep the first per key."""
    empty = F.coalesce(F.col(key), F.lit("")) == ""
    first = keep_first_per_key(df.filter(~empty), key, order_col, count_col)
    alone = df.filter(empty)
    if count_col:
        alone = alone.withColumn(count_col, F.lit(1).cast("bigint"))
    return first.unionByName(alone.select(*first.columns))


def keep_sequential(rows: DataFrame, listing_key: str, page_key: str, order_col: str, max_rounds: int = 1000) -> DataFrame:
    """E4 + D2 as the sequential collector has it: in ``order_col`` order a row
    is taken unless an earlier *taken* row's ``page_key`` equals its own
    ``listing_key`` (the key is added after each save). ``order_col`` is unique.

    An ordered fixed point in rounds: a row is decided once every earlier row
    that could stop it is. Per key only the first taken and the first undecided
    row matter, so a round is one aggregation and one join, whatever a key's
    number of rows; there are as many rounds as the longest chain of rows that
    depend on each other. Empty and null keys stop nothing."""
    spark = rows.sparkSession
    key = lambda c: F.nullif(F.col(c), F.lit(""))
    todo = rows.select(F.col(order_col).alias("o"), key(listing_key).alias("mine"), key(page_key).alias("gives"))
    todo = todo.withColumn("taken", F.lit(None).cast("boolean"))
    for _ in range(max_rounds):
        path = scratch_path(spark, f"sequential-{uuid.uuid4().hex}")
        todo.write.parquet(path)
        todo = spark.read.schema(todo.schema).parquet(path)
        if todo.where("taken IS NULL").isEmpty():
            return rows.join(todo.where("taken").select(F.col("o").alias(order_col)), order_col, "left_semi")
        giving = todo.where("gives IS NOT NULL AND taken IS NOT FALSE").groupBy("gives").agg(
            F.min(F.when(F.col("taken"), F.col("o"))).alias("sure"), F.min(F.when(F.col("taken").isNull(), F.col("o"))).alias("maybe")
        )
        seen = todo.join(giving.withColumnRenamed("gives", "mine"), "mine", "left")
        verdict = F.when(F.col("sure") < F.col("o"), F.lit(False)).when(F.col("maybe") < F.col("o"), F.lit(None)).otherwise(F.lit(True))
        todo = seen.select("o", "mine", "gives", F.coalesce("taken", verdict).alias("taken"))
    raise RuntimeError(f"undecided rows after {max_rounds} rounds")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys (aggregated before the shuffle)."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def not_already_saved(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose ``key`` is absent from ``existing``.

    The existing side is reduced to its distinct keys first; AQE picks a
    broadcast for it only when its measured size is under the threshold,
    otherwise a shuffle anti join (skewed left partitions are split)."""
    return new.join(distinct_keys(existing, key), key, "left_anti")


def append_new(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """G1: existing rows plus the new rows not already saved (by ``key``)."""
    fresh = not_already_saved(new, existing, key)
    return existing.unionByName(fresh.select(*existing.columns))
