"""The pipeline's stages, each held against a brute-force version of its own
input, and the whole run on the edge cases."""

import collections

import corpus_pipeline as P
import numpy as np
from pyspark.sql import functions as F
from test_llm_operators import EDGE, frame, jaccard_brute

from papertriage.llm import decontaminate, exact_dedup, language_id

SF = "/root/testdata/sf0.001"


def test_stages_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit("clash")).cache()
    bench = decontaminate.BenchmarkIndex([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontaminate", "bestfit_pack"]
    model = language_id.fit(docs)
    level = language_id.rejection_level(docs, model)
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF).cache()
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        if name == "bestfit_pack":
            length = collections.Counter()
            for r in out.collect():
                length[r["doc_id"]] += r["length"]
            assert set(length) == set(before)
            return
        assert out.columns == docs.columns
        after = {r["doc_id"] for r in out.select("doc_id").collect()}
        if name == "language_id":
            want = {i for i, t in before.items() if (p := language_id.predict(model, [t])[0])[0] != "und" and p[1] >= level}
            assert want == set(before)  # these documents are clean
        elif name == "exact_dedup":
            want = set({t: i for i, t in sorted(before.items())}.values())
        elif name == "jaccard_join":
            want = {i for i, n, c in jaccard_brute(list(before.items()), 80, 5) if i == c}
        else:
            want = {i for i, t in before.items() if not bench.leaks(t)}
            assert want != set(before)
        assert after == want, name
        docs = out


def test_near_copy_stage_takes_five_words_and_80_percent(spark):
    docs = exact_dedup.drop_exact_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    before = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = P.drop_near_copies(spark, docs, SF).cache()
    want, narrow = ({i for i, _, c in jaccard_brute(before, *rule) if i == c} for rule in ((80, 5), (90, 3)))
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} == want != narrow
    bench = decontaminate.BenchmarkIndex([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    clean = P.drop_benchmark_leaks(spark, out, SF).cache()
    assert {r["doc_id"] for r in clean.collect()} == {i for i, t in before if i in want and not bench.leaks(t)}
    assert {r["doc_id"] for r in P.pack_sequences(spark, clean, SF).collect()} == {r["doc_id"] for r in clean.collect()}


def test_run_on_edge_cases(spark, tmp_path):
    rows = EDGE + [(20, "It is the same long text of many words, told twice."), (21, "It is the same long text of many words, told twice.")]
    frame(spark, rows).withColumn("lang", F.lit("en")).drop("length", "piece", "rank", "task", "nth").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing of this stands anywhere else")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = P.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in out}
    assert 21 in ids and 20 not in ids and not ids & {1, 2, 3, 4} and 7 in ids
    sizes = collections.Counter()
    for r in out:
        sizes[r["sequence_id"]] += r["length"]
    assert np.all(np.array(list(sizes.values())) <= 2048)
