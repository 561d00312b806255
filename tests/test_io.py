import os
import random
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papertriage.sources import csv as CS
from papertriage.sources import quoted
from papertriage.sources.notes import NOTE_SCHEMA, read_notes
from papertriage.sources.tables import read_or_empty

EDGE = pd.DataFrame(
    {
        "Title": ['He said "hi"', "a, b", "multi\nline", "back\\slash", "NA", "None", "  leading"],
        "Abstract": ["x", 'y ""z""', "p\r\nq", "w", "ok", "fine", " s "],
        "url": ["u1", "u2", "u3", "u4", "u5", "u6", "u7"],
    }
)


def test_pandas_csv_reads_identically(spark):
    d = tempfile.mkdtemp(prefix="pt-csv-")
    path = os.path.join(d, "cvpr_24.csv")
    EDGE.to_csv(path, index=False)
    got = CS.read_paper_csv(spark, path, with_source=True).collect()
    exp = pd.read_csv(path, keep_default_na=False).rename(columns={"Title": "title", "Abstract": "abstract"})
    assert [(r["title"], r["abstract"], r["url"]) for r in got] == list(exp.itertuples(index=False, name=None))
    assert {(r["venue"], r["year"]) for r in got} == {("cvpr", 24)}
    # opt-in: pandas' missing-value strings become NULL
    nulls = CS.read_paper_csv(spark, path, pandas_missing=True).collect()
    assert [r["title"] for r in nulls][4:6] == [None, None]


@pytest.mark.parametrize("limit", [100_000, 0])
def test_one_large_file_is_read_by_many_tasks(spark, monkeypatch, limit):
    monkeypatch.setattr(quoted, "INSIDE_LIMIT", limit)
    rng = random.Random(8)
    bits = ['"', '""', ",", "\n", "\r\n", "\n\n", "é", "word ", "a", " ", "\\"]
    cell = lambda: "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 5, 30])))
    rows = pd.DataFrame([(cell(), cell(), f"u{i}") for i in range(900)], columns=["Title", "Abstract", "url"])
    rows.loc[450, "Abstract"] = "one field over several ranges\n" * 300
    d = tempfile.mkdtemp(prefix="pt-csv-")
    path = os.path.join(d, "cvpr_24.csv")
    rows.to_csv(path, index=False)
    whole = spark.read.options(header=True, multiLine=True, escape='"', quote='"').csv(path).select(F.col("Title").alias("title"), F.col("Abstract").alias("abstract"), "url")
    want = sorted(map(tuple, whole.collect()), key=lambda r: r[2])
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert quoted.lines(spark, path).rdd.getNumPartitions() > 10
        got = sorted(map(tuple, CS.read_paper_csv(spark, path).collect()), key=lambda r: r[2])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want and len(got) == 900


def test_csv_layouts_and_odd_files(spark):
    d = tempfile.mkdtemp(prefix="pt-csv-")
    EDGE.to_csv(os.path.join(d, "cvpr_24.csv"), index=False)
    EDGE[["url", "Title"]].rename(columns={"Title": "title"}).to_csv(os.path.join(d, "iccv_23.csv"), index=False, lineterminator="\r\n")
    with open(os.path.join(d, "eccv_22.csv"), "w", newline="") as f:
        f.write("title,abstract,url\n")  # a header alone
    got = CS.read_paper_csv(spark, os.path.join(d, "*.csv"), with_source=True).collect()
    want = [("cvpr", *r) for r in EDGE.itertuples(index=False, name=None)] + [("iccv", t, None, u) for t, _, u in EDGE.itertuples(index=False, name=None)]
    assert sorted((r["venue"], r["title"], r["abstract"], r["url"]) for r in got if r["venue"] == "cvpr") == sorted(want[:7])
    assert sorted((r["title"], r["url"]) for r in got if r["venue"] == "iccv") == sorted((w[1], w[3]) for w in want[7:])


def test_spark_csv_written_reads_in_pandas(spark):
    d = tempfile.mkdtemp(prefix="pt-csv-")
    df = spark.createDataFrame(EDGE.rename(columns={"Title": "title", "Abstract": "abstract"}))
    CS.write_paper_csv(df.coalesce(1), d)
    part = [f for f in os.listdir(d) if f.endswith(".csv")][0]
    back = pd.read_csv(os.path.join(d, part), keep_default_na=False)
    assert list(back["title"]) == list(EDGE["Title"])
    assert list(back["abstract"]) == list(EDGE["Abstract"])


def test_read_or_empty(spark):
    schema = T.StructType([T.StructField("title", T.StringType())])
    df = read_or_empty(spark, os.path.join(tempfile.mkdtemp(), "absent"), schema)
    assert df.count() == 0 and df.schema == schema


def test_note_json_scan(spark):
    d = tempfile.mkdtemp(prefix="pt-notes-")
    with open(os.path.join(d, "notes.json"), "w") as f:
        f.write('{"id": "a1", "content": {"title": {"value": "T"}, "venue": {"value": "ICLR 2024 poster"}, '
                '"abstract": {"value": "A"}, "other": {"value": 1}}}\n')
        f.write('{"id": "a2", "content": {"title": {"value": "U"}, "abstract": {"value": "B"}}}\n')
    from papertriage.operators.notes import accepted, flatten_notes, note_rejects

    notes = read_notes(spark, d)
    assert notes.schema == NOTE_SCHEMA
    flat = flatten_notes(notes)
    assert [(r["title"], r["url"]) for r in accepted(flat).collect()] == [("T", "https://openreview.net/forum?id=a1")]
    assert [r["id"] for r in note_rejects(flat).collect()] == ["a2"]


def test_land_as_parquet(spark):
    d = tempfile.mkdtemp(prefix="pt-land-")
    EDGE.to_csv(os.path.join(d, "cvpr_24.csv"), index=False)
    EDGE.head(2).to_csv(os.path.join(d, "iccv_23.csv"), index=False)
    out = CS.land_as_parquet(spark, os.path.join(d, "*.csv"), os.path.join(d, "landed"))
    got = {(r["venue"], r["year"]): r["n"] for r in out.groupBy("venue", "year").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert got == {("cvpr", 24): 7, ("iccv", 23): 2}
    assert out.filter("venue = 'iccv'").count() == 2  # partition pruning path
