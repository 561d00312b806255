import random

from pyspark.sql import functions as F

from papertriage.operators import papers as PP


def test_keep_first_with_a_hot_key(spark):
    # one key holds a third of all rows
    rows = [(i, "hot" if i % 3 == 0 else f"k{i}", f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "paper_id long, title_key string, title string").repartition(16)
    out = PP.keep_first_per_key(df, "title_key", "paper_id", count_col="n").filter(F.col("title_key") == "hot").first()
    assert (out["paper_id"], out["title"], out["n"]) == (0, "t0", 1000)
    assert PP.keep_first_per_key(df, "title_key", "paper_id").count() == 2001


def test_not_already_saved_hot_key(spark):
    new = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i}") for i in range(3000)], "paper_id long, k string")
    saved = spark.createDataFrame([("hot",), ("k1",), ("zzz",)], "k string")
    got = PP.not_already_saved(new, saved, "k")
    assert got.count() == 3000 - 1000 - 1
    assert got.filter(F.col("k") == "hot").count() == 0


def test_split_usable_and_reasons(spark):
    docs = spark.createDataFrame(
        [(1, "T\nA", "en", "s"), (2, "only title", "en", "s"), (3, "  \nabs", "en", "s"), (4, "T\n 　", "en", "s")],
        "doc_id long, text string, lang string, source string",
    )
    kept, rejects = PP.split_usable(PP.papers_from_documents(docs, "u/"))
    assert [(r["paper_id"], r["title"], r["abstract"], r["url"]) for r in kept.collect()] == [(1, "T", "A", "u/1")]
    assert sorted((r["paper_id"], r["reason"]) for r in rejects.collect()) == [
        (2, "missing abstract"), (3, "missing title"), (4, "missing abstract")
    ]


def test_append_new(spark):
    existing = spark.createDataFrame([(1, "a")], "paper_id long, k string")
    new = spark.createDataFrame([(2, "a"), (3, "b")], "paper_id long, k string")
    assert sorted(tuple(r) for r in PP.append_new(existing, new, "k").collect()) == [(1, "a"), (3, "b")]


def test_scan_partitions_is_a_setting(spark):
    from papertriage.sources.tables import SCAN_PARTITIONS, read_table

    plain = read_table(spark, "/root/testdata/sf0.001", "documents")
    spark.conf.set(SCAN_PARTITIONS, "3")
    try:
        dealt = read_table(spark, "/root/testdata/sf0.001", "documents")
    finally:
        spark.conf.unset(SCAN_PARTITIONS)
    assert dealt.rdd.getNumPartitions() == 3 and dealt.count() == plain.count()


def test_rows_without_a_key_all_stay(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, ""), (4, ""), (5, None)], "paper_id long, title_key string")
    got = PP.keep_first_nonempty(df, "title_key", "paper_id", count_col="n").collect()
    assert sorted((r["paper_id"], r["n"]) for r in got) == [(1, 2), (3, 1), (4, 1), (5, 1)]


def test_keep_sequential_equals_a_loop(spark):
    rng = random.Random(3)
    keys = [None, "", *"abcdefghij"]
    rows = [(i, rng.choice(keys), rng.choice(keys)) for i in range(120)]
    rows += [(200 + i, f"k{i}", f"k{i + 1}") for i in range(12)]  # a chain: every second row is taken
    rows += [(300 + i, "hot", "hot") for i in range(50)]
    seen, want = set(), []
    for i, mine, gives in rows:
        if not mine or mine not in seen:
            want.append(i)
            seen.add(gives)
    df = spark.createDataFrame(rows, "place long, listing_key string, page_key string").repartition(5)
    got = PP.keep_sequential(df, "listing_key", "page_key", "place")
    assert got.columns == df.columns and sorted(r["place"] for r in got.collect()) == want
    assert PP.keep_sequential(df.where("false"), "listing_key", "page_key", "place").collect() == []
