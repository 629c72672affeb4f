from pyspark.sql import functions as F

from logtide.operators import numbering, setops


def test_dense_index_is_contiguous_over_many_partitions(spark):
    words = spark.range(5000).select(F.sha1(F.col("id").cast("string")).alias("w")).repartition(8)
    got = numbering.dense_index(words, ["w"], "i").collect()
    expected = {w: i for i, w in enumerate(sorted(r.w for r in got))}
    assert len(got) == 5000 and all(expected[r.w] == r.i for r in got)
    assert numbering.dense_index(words, [F.col("w").desc()], "i", start=1).where("i = 1").first().w == max(expected)


def test_dense_index_of_nothing(spark):
    assert numbering.dense_index(spark.range(0), ["id"]).count() == 0


def test_ranks_with_a_hot_user(spark):
    scores = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 100).alias("user"),
        F.col("id").alias("item"),
        (F.col("id") % 17).alias("score"),
    )
    got = numbering.rank_per_user(scores).collect()
    by_user = {}
    for r in got:
        by_user.setdefault(r.user, []).append(r)
    assert len(got) == 9000
    for held in by_user.values():
        ordered = sorted(held, key=lambda r: (-r.score, r.item))
        assert [r.rank for r in ordered] == list(range(1, len(held) + 1))


def test_ranking_uses_no_single_task_window(spark, plan_of):
    scores = spark.range(10).select(F.lit(1).alias("user"), F.col("id").alias("item"), F.col("id").alias("score"))
    plan = plan_of(numbering.rank_per_user(scores))
    window = [part for part in plan.split("\n") if "Window" in part]
    # Windows run over per-partition row counts only.
    assert all("_rows" in part for part in window)


def test_global_sort_orders_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(8)
    assert [r.v for r in numbering.global_sort(df, "v").collect()] == list(range(1000))


def top_k_of(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    return numbering.top_k_per_key(df, 2, ["k"], [F.col("v").desc()])


def test_top_k(spark, plan_of):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    assert [r.v for r in numbering.top_k(df, 3, F.col("v").desc()).collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in plan_of(numbering.top_k(df, 3, "v"))
    per_key = top_k_of(spark)
    assert sorted((r.k, r.rank, r.v) for r in per_key.collect())[:2] == [(0, 1, 90), (0, 2, 80)]
    # Once before and once after the shuffle.
    assert plan_of(top_k_of(spark)).count("WindowGroupLimit") == 2


def test_top_k_beyond_the_group_limit(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 5000).alias("v"))
    monkeypatch.setattr(numbering, "GROUP_LIMIT", 10)
    got = numbering.top_k_per_key(df, 50, ["k"], [F.col("v").desc()])
    assert got.columns == ["k", "v", "rank"]
    for key in (0, 1):
        held = sorted((r["rank"], r.v) for r in got.collect() if r.k == key)
        best = sorted((i * 7919 % 5000 for i in range(key, 5000, 2)), reverse=True)[:50]
        assert held == [(i + 1, v) for i, v in enumerate(best)]


def test_unique_ids(spark):
    ids = [r.uid for r in numbering.unique_id(spark.range(1000).repartition(8)).collect()]
    assert len(set(ids)) == 1000


def test_set_operations(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert len(rows(setops.union_streams([a, b]))) == 4
    assert rows(setops.set_difference(a, b.select("n", "s"))) == [(1, "x")]
