import random

from pyspark.sql import functions as F

from matchweave.operators.scale import dense_index, running_sum, sliced_join, spread, top_per_key, within


def test_dense_index_is_a_total_order(spark):
    rows = [(i % 7, f"f{i:03d}") for i in range(200)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "a int, f string")
    got = dense_index(df, ["a", "f"], start=11).collect()
    assert [(r.a, r.f) for r in sorted(got, key=lambda r: r["rank"])] == sorted(rows)
    assert sorted(r["rank"] for r in got) == list(range(11, 211))


def test_running_sum_over_blocks(spark):
    rng = random.Random(5)
    rows = [(k, t * 3 - 20, rng.randint(0, 9)) for k in (1, 2) for t in range(150 if k == 1 else 4)]
    df = spark.createDataFrame(rows, "k long, t long, v long")
    got = {(r.k, r.t): (r.s, r.n) for r in running_sum(df, "k", "t", {"s": F.col("v"), "n": F.lit(1)}, span=5).collect()}
    for key in (1, 2):
        total = count = 0
        for k, t, v in rows:
            if k == key:
                total, count = total + v, count + 1
                assert got[(k, t)] == (total, count)


def test_sliced_join_equals_join(spark):
    big = spark.createDataFrame([("hot", i) for i in range(300)] + [("cold", 1), ("alone", 2)], "k string, i long")
    small = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("cold", "z"), ("none", "w")], "k string, s string")
    got = sliced_join(big, small, "k", "i", slice_rows=50)
    want = big.join(small, "k")
    assert got.count() == want.count() == 601
    assert got.select("k", "i", "s").exceptAll(want.select("k", "i", "s")).count() == 0


def test_top_per_key_limits_below_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    top = top_per_key(df, "k", [F.col("id").desc()], 3)
    assert sorted(r.id for r in top.collect()) == [994, 995, 996, 997, 998, 999]
    plan = top._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_within_and_spread(spark):
    assert within(spark.range(5), 5) and not within(spark.range(6), 5)
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
