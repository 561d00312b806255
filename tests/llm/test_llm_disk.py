"""What the operators leave on disk and send through exchanges."""

import random
import time

import corpus_pipeline as P
import pyarrow as pa
from pyspark.sql import functions as F

from papertriage.llm import common, jaccard_join, suffix_dedup


def exchange_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def left_by(spark, work):
    """Exchange files that ``work`` leaves; they are deleted in the background."""
    before = exchange_files(spark)
    work()
    for _ in range(20):
        if not (left := exchange_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def rows(spark, n=40):
    text = F.concat_ws(" ", *(F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"-{k}")), 256) for k in range(8)))
    return spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, text).otherwise(F.lit("same words " * 40)).alias("text"))


def test_a_checkpoint_leaves_no_exchange_files(spark):
    counts = rows(spark).groupBy("text").count()
    kept = []
    assert not left_by(spark, lambda: kept.append(common.cut_lineage(counts)))
    assert kept[0].count() == 31 and kept[0].columns == counts.columns
    assert spark.conf.get(common._FILE_CLEANUP) == "false"


def test_repeats_keep_only_the_exchanges_of_the_result(spark):
    made = []
    assert not left_by(spark, lambda: made.append(suffix_dedup.remove_repeats(rows(spark))))
    assert {r["n_removed"] for r in made[0].collect()} == {0, 440}


def test_a_written_stage_leaves_no_exchange_files(spark, tmp_path):
    try:
        for stage in (P.drop_exact_copies, P.drop_near_copies):
            assert not left_by(spark, lambda stage=stage: stage(spark, rows(spark), None).write.parquet(f"{tmp_path}/{stage.__name__}"))
            assert spark.read.parquet(f"{tmp_path}/{stage.__name__}").count() == 31
    finally:
        spark.conf.set(common._FILE_CLEANUP, "false")


def test_sets_travel_as_packed_texts():
    rng = random.Random(5)
    names = [f"word{k}" for k in range(3000)]
    given = [" ".join(rng.choices(names, k=2000)), "É short", "", None, " \t"]
    batch = pa.RecordBatch.from_arrays([pa.array(given, pa.string())], names=["text"])
    got = [r for b in jaccard_join._whole(5)([batch]) for r in b.to_pylist()]
    sets = [jaccard_join.shingle_set(t, 5) for t in given[:2]]
    assert [r["node"] for r in got] == [jaccard_join.set_key(s)[0] for s in sets]
    whole = jaccard_join._unpacker(5)
    assert all((whole(r["packed"]) == s).all() for r, s in zip(got, sets))
    assert len(got[0]["packed"]) < sets[0].nbytes / 2
