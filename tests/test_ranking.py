import pandas as pd
from pyspark.sql import functions as F

from papertriage.operators import ranking as RK


def test_global_row_number(spark):
    df = spark.range(0, 1000).withColumn("v", (F.col("id") * 7919) % 1000)
    got = RK.global_row_number(df, [F.col("v").desc(), F.col("id")], "rn", num_partitions=7).toPandas()
    exp = got.sort_values(["v", "id"], ascending=[False, True]).reset_index(drop=True)
    assert list(exp["rn"]) == list(range(1, 1001))


def test_grouped_rank_with_ties_and_hot_group(spark):
    # group "hot" holds a third of the rows; ties on value
    rows = [("hot" if i % 3 == 0 else f"g{i % 5}", i, float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, id long, v double")
    got = RK.grouped_rank(df, ["g"], [F.col("v").desc()], ["v"], "id").toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "id", "v"])
    pdf["rank"] = pdf.groupby("g")["v"].rank(method="min", ascending=False).astype(int)
    pdf["n"] = pdf.groupby("g")["v"].transform("size")
    pdf["pr"] = (pdf["rank"] - 1) / (pdf["n"] - 1)
    m = got.merge(pdf, on=["g", "id"])
    assert len(m) == 300
    assert (m["rank_x"] == m["rank_y"]).all()
    assert ((m["percent_rank"] - m["pr"]).abs() < 1e-12).all()


def test_rows_are_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 1000, numPartitions=4).mapInArrow(touch, "id long")
    assert RK.global_row_number(df, [F.col("id").desc()], "rn").agg(F.max("rn")).first()[0] == 1000
    assert seen.value == 1000


def test_groups_cut_by_partitions(spark):
    rows = [(None if i % 7 == 0 else "hot" if i % 3 else f"g{i % 11}", i, [1.0, 2.0, float("nan"), None][i * 31 % 4]) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, id long, v double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("1", "23"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(map(repr, RK.grouped_rank(df, ["g"], [F.col("v").desc()], ["v"], "id").collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1] and len(out[0]) == 500
    assert RK.grouped_rank(df.where("false"), ["g"], [F.col("v").desc()], ["v"], "id").collect() == []
