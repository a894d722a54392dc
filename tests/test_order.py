import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from microlake.operators import dictionaries as D
from microlake.operators import order as P


def test_places_over_many_files(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.randint(0, 40), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x int, i int").repartition(7)
    got = P.placed(df, ["x", "i"])
    assert got.columns == ["g", "x", "i", "lugar"]
    assert [r["i"] for r in got.orderBy("lugar").collect()] == [i for _, _, i in sorted(rows, key=lambda r: (r[1], r[2]))]
    assert sorted(r["lugar"] for r in got.collect()) == list(range(1, 501))
    by = P.placed(df, [F.desc("x"), "i"], "n", ["g"]).collect()
    want = df.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy(F.desc("x"), "i")))
    assert sorted(map(str, by)) == sorted(map(str, want.collect()))
    assert P.placed(df.limit(0), ["x"]).count() == 0 and P.placed(df.limit(0), ["x"], by=["g"]).count() == 0
    tied = P.placed(df, ["x"]).orderBy("lugar").collect()  # rows that are equal in the order have places of their own
    assert [r["lugar"] for r in tied] == list(range(1, 501)) and [r["x"] for r in tied] == sorted(r["x"] for r in tied)


def test_ordinal_over_many_files(spark, tmp_path):
    for n in range(5):
        spark.range(n * 100, n * 100 + n).coalesce(1).write.parquet(str(tmp_path / f"t/p{n}"))
    got = P.table_ordinal(spark, str(tmp_path / "t")).orderBy("lugar").collect()
    assert [r["lugar"] for r in got] == list(range(10)) and [r["id"] for r in got] == [100, 200, 201, 300, 301, 302, 400, 401, 402, 403]
    assert [r["row_index"] for r in got] == [0, 0, 1, 0, 1, 2, 0, 1, 2, 3]


@pytest.mark.parametrize("gap", [0.0, 0.5, 0.97, 1.0])
def test_forward_fill_of_long_series(spark, gap):
    """Series that go over many files, files without any value, and series that begin inside a file."""
    rng = random.Random(int(gap * 100))
    rows = [(rng.choice([1] * 9 + [2, None]), i, None if rng.random() < gap else rng.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, i int, v double").repartition(3)
    got = P.forward_fill_long(df, "v", ["i"], ["k"], tasks=9)
    want = D.forward_fill(df, "v", ["i"], ["k"])
    assert got.columns == ["k", "i", "v"] and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    one = P.forward_fill_long(df, "v", ["i"], name="f", tasks=9)
    plain = df.withColumn("f", F.last("v", ignorenulls=True).over(W.partitionBy(F.lit(1)).orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)))
    assert one.columns == plain.columns and sorted(map(str, one.collect())) == sorted(map(str, plain.collect()))


def test_forward_fill_is_done_by_many_tasks(spark):
    """No task has more rows than its range."""
    df = spark.range(4000).select(F.col("id").alias("i"), F.when(F.col("id") % 1000 == 0, F.col("id")).alias("v"))
    got = P.forward_fill_long(df, "v", ["i"], tasks=8)
    sizes = [r["n"] for r in P.sorted_files(df, ["i"], 8).rows.groupBy("_file").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 1200 and got.filter(F.col("v") != F.col("i") - F.col("i") % 1000).count() == 0
    assert P.forward_fill_long(df.limit(0), "v", ["i"]).count() == 0
