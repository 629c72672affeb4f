import random

import pytest
from pyspark.sql import functions as F

from logtide.operators import ipranges, lookups, ratings


@pytest.fixture
def skewed(spark):
    """30,000 rows of which a third carry one key; keys 40-49 are unknown to the dimension."""
    facts = spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("bigint").alias("k")
    )
    dim = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    return facts, dim


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_all_ways_to_join_agree(skewed, rows, how):
    facts, dim = skewed
    plain = facts.join(dim, "k", how)
    columns = sorted(plain.columns)
    for joined in (
        lookups.lookup_join(facts, dim, ["k"], how),
        lookups.lookup_join(facts.hint("merge"), dim, ["k"], how),
        lookups.salted_join(facts, dim, ["k"], how),
    ):
        assert rows(joined, *columns) == rows(plain, *columns)


def test_salting_spreads_a_hot_key(spark, skewed):
    facts, dim = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookups.salted_join(facts, dim, ["k"], "inner").where("k = 0")
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) >= 5 and max(sizes) < sum(sizes) / 2


def test_equal_rows_of_a_hot_key_are_spread(spark, rows):
    facts = spark.range(9000).select(F.lit(1).alias("k"), F.lit("same").alias("x")).repartition(4)
    dim = spark.createDataFrame([(1, "v")], "k int, v string")
    joined = lookups.salted_join(facts, dim, ["k"], "inner")
    assert joined.count() == 9000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookups.salted_join(facts, dim, ["k"], "inner")
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) >= 4 and max(sizes) < 9000 * 0.6


def test_building_a_lookup_runs_nothing(spark, data, skewed):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        facts = spark.read.parquet(f"{data}/lineitem.parquet")
        parts = spark.read.parquet(f"{data}/part.parquet").select(F.col("p_partkey").alias("l_partkey"), "p_size")
        tracked = list(tracker.getJobIdsForGroup("build"))
        joined = lookups.lookup_join(facts, parts.groupBy("l_partkey").agg(F.max("p_size").alias("size")), ["l_partkey"])
        joined.explain()
        assert list(tracker.getJobIdsForGroup("build")) == tracked
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "SinglePartition" not in plan and "GlobalLimit" not in plan


def test_plans_of_both_ways(skewed, plan_of):
    facts, dim = skewed
    assert "BroadcastHashJoin" in plan_of(lookups.lookup_join(facts, dim, ["k"]))
    plan = plan_of(lookups.salted_join(facts, dim, ["k"]))
    assert "_salt" in plan and "NestedLoop" not in plan


def test_shuffle_join_slices_a_hot_key(spark, skewed, rows, plan_of):
    facts, dim = skewed
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    expected = rows(facts.join(dim, "k", "left"), "id", "k", "v")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = lookups.lookup_join(facts.repartition(8, "id"), dim, ["k"], "left")
        assert rows(joined, "id", "k", "v") == expected
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_unknown_domain_keeps_its_row(spark, rows):
    media = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "domain string, cs int")
    channels = spark.createDataFrame([("a", "u1"), ("a", "u0")], "domain string, userid string")
    got = rows(lookups.attach_userid(media, channels), "domain", "userid", "cs")
    assert got == sorted([("a", "u0", 1), ("b", None, 2), (None, None, 3)], key=repr)


@pytest.fixture
def ranges(spark):
    """Disjoint ranges from one address to several times 2^24, with gaps."""
    rng, at, made = random.Random(3), 2**24, []
    for i in range(120):
        at += rng.choice([1, 50, 70_000])
        width = rng.choice([1, 300, 65_536, 200_000, 2**24 - 1, 2**24, 40_000_000])
        if at + width >= 2**32:
            break
        made.append((at, at + width - 1, f"c{i}"))
        at += width
    return made


def test_ranges_of_long_addresses(spark):
    """Five to seven fields, wide and narrow ranges above 2^40, and a range that starts below zero."""
    made = [(-50, 5, "low"), (2**32, 2**32 + 10, "five"), (2**40 - 3, 2**41, "across"), (2**44, 2**50, "wide"), (2**55, 2**55, "one"), (2**56 - 9, 2**56 + 2**40, "seven")]
    asked = [0, 4, 5, 6, 2**32, 2**32 + 11, 2**40, 2**41, 2**41 + 1, 2**44 - 1, 2**47 + 5, 2**50, 2**55 - 1, 2**55, 2**56 - 9, 2**56 + 7]
    text = lambda a: ".".join(str(a >> s & 255) for s in range(max(24, (a.bit_length() - 1) // 8 * 8), -1, -8))
    events = spark.createDataFrame([(i, text(a)) for i, a in enumerate(asked)] + [(99, "300.0.0.0.7")], "id int, ip string")
    table = spark.createDataFrame(made, "start_ip bigint, end_ip bigint, company string")
    want = {i: next((c for s, e, c in made if s <= a <= e), None) for i, a in enumerate(asked)}
    want[99] = next((c for s, e, c in made if s <= 300 * 2**32 + 7 <= e), None)
    assert {r.id: r.company for r in ipranges.ip_to_company(events, table).collect()} == want
    inner = ipranges.ip_to_company(events, table, how="inner")
    assert {r.id: r.company for r in inner.collect()} == {i: c for i, c in want.items() if c}


@pytest.mark.parametrize("sampled", [1.0, 1 / 16])
def test_ip_ranges_equal_brute_force(spark, ranges, monkeypatch, sampled):
    monkeypatch.setattr(ipranges, "SAMPLED", sampled)
    check_ranges(spark, ranges)


def check_ranges(spark, ranges):
    # Few parts, many parts, and as many as the session has.
    rng = random.Random(5)
    addresses = [edge + step for start, end, _ in ranges for edge in (start, end) for step in (-1, 0, 1)]
    addresses += [rng.randrange(2**32) for _ in range(500)]
    texts = [".".join(str(a >> s & 255) for s in (24, 16, 8, 0)) for a in addresses] + ["bad", ""]
    expected = {}
    for text, address in zip(texts, addresses + [-1, -1]):
        expected[text] = next((c for s, e, c in ranges if s <= address <= e), None)
    events = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, ip string")
    table = spark.createDataFrame(ranges, "start_ip bigint, end_ip bigint, company string")
    for parts in (1, 7, 64, None):
        got = ipranges.ip_to_company(events, table, parts=parts).collect()
        assert len(got) == len(texts)
        assert all(r.company == expected[r.ip] for r in got)
    inner = ipranges.ip_to_company(events, table, how="inner")
    assert inner.count() == sum(expected[t] is not None for t in texts)


def test_ip_plan_is_one_shuffle_a_side(spark, ranges, plan_of):
    events = spark.createDataFrame([(1, "1.2.3.4")], "id int, ip string")
    table = spark.createDataFrame(ranges, "start_ip bigint, end_ip bigint, company string")
    plan = plan_of(ipranges.ip_to_company(events, table))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(_ip_slot") == 1


def test_overlapping_ranges_take_the_last_start(spark, monkeypatch):
    monkeypatch.setattr(ipranges, "SAMPLED", 1.0)
    made = [(0, 100, "wide"), (10, 20, "inner"), (10, 12, "short"), (50, 60, "b"), (50, 60, "a"), (80, 70, "turned"), (None, 5, "open")]
    asked = [0, 9, 10, 20, 21, 49, 55, 60, 61, 75, 101]
    events = spark.createDataFrame([(a, f"0.0.0.{a}") for a in asked], "id int, ip string")
    table = spark.createDataFrame(made, "start_ip bigint, end_ip bigint, company string")
    want = {0: "wide", 9: "wide", 10: "inner", 20: "inner", 55: "b", 60: "b"}
    for parts in (1, 3, 40):
        got = {r.id: r.company for r in ipranges.ip_to_company(events, table, parts=parts).collect()}
        assert got == {a: want.get(a) for a in asked}


def test_a_hot_address_is_split(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("10.0.0.9")).otherwise(F.concat(F.lit("10.0."), F.col("id") % 200, F.lit(".1")))
    events = spark.range(9000).select("id", hot.alias("ip"), F.lit("x").alias("_ip_part"), F.lit("y").alias("company_"))
    table = spark.createDataFrame([(167772160, 167772170, "hot"), (167772416 + 255, 167903232, "rest")], "start_ip bigint, end_ip bigint, company string")
    named = ipranges.ip_to_company(events, table, parts=30)
    counts = {r.company: r["count"] for r in named.groupBy("company").count().collect()}
    assert counts["hot"] >= 3000 and sum(counts.values()) == 9000 and named.columns == [*events.columns, "company"]
    bounds, slots = ipranges._bounds(events.select(ipranges.ip_to_long("ip").alias("_ip_at")), 30)
    at = bounds.index(167772169)
    assert slots[at + 1] >= 9 and bounds[at + 1] == 167772170 and sum(slots) <= 60


def test_ranges_without_events_or_the_other_way(spark):
    events = spark.createDataFrame([(1, "1.2.3.4"), (2, None)], "id int, ip string")
    table = spark.createDataFrame([(0, 2**40, "all")], "start_ip bigint, end_ip bigint, company string")
    assert ipranges.ip_to_company(events.limit(0), table).count() == 0
    assert [r.company for r in ipranges.ip_to_company(events, table.limit(0)).collect()] == [None, None]
    assert {r.id: r.company for r in ipranges.ip_to_company(events, table).collect()} == {1: "all", 2: None}


def test_repeated_pairs_multiply(spark, rows):
    rated = spark.createDataFrame([(1, 1, 5.0), (1, 1, 5.0), (1, 1, 3.0), (2, 1, 4.0)], "user int, item int, rate double")
    predicted = spark.createDataFrame([(1, 1, 4.0)] * 3 + [(9, 9, 1.0)], "user int, item int, pred double")
    folded = ratings.rating_prediction_join(rated, predicted)
    assert rows(folded) == [(1, 1, 3.0, 4.0, 3), (1, 1, 5.0, 4.0, 6)]
    plain = rated.join(predicted, ["user", "item"])
    assert folded.agg(F.sum("pairs")).first()[0] == plain.count()
    assert ratings.prediction_error(rated, predicted).first() == (9, 1.0)
    whole = ratings.rated_predictions(rated, predicted)
    assert rows(whole, "user", "item", "rate", "pred") == rows(plain, "user", "item", "rate", "pred") and whole.count() == 9


def test_stored_pairs_join_without_an_exchange(spark, rows, plan_of):
    rated = spark.createDataFrame(
        [(1, 1, 5.0), (1, 1, 5.0), (1, 1, 3.0), (2, 1, 4.0), (3, 3, None), (None, 1, 1.0)] + [(4, 4, 2.0)] * 500, "user int, item int, rate double")
    predicted = spark.createDataFrame([(1, 1, 4.0)] * 3 + [(9, 9, 1.0), (3, 3, 1.0), (4, 4, 2.5), (4, 4, None)], "user int, item int, pred double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with ratings.scratch_pairs(rated, "rate", 6) as mine, ratings.scratch_pairs(predicted, "pred", 6) as theirs:
            names = [t.name for t in spark.catalog.listTables() if t.name.startswith("pairs_")]
            for stored, plain in (
                (ratings.stored_join(mine, theirs), ratings.rating_prediction_join(rated, predicted)),
                (ratings.stored_rows(mine, theirs), ratings.rated_predictions(rated, predicted)),
            ):
                plan = plan_of(stored)
                assert "Exchange" not in plan and "SortMergeJoin" in plan
                assert rows(stored, *plain.columns) == rows(plain, *plain.columns)
            error = ratings.stored_error(mine, theirs)
            assert "hashpartitioning" not in plan_of(error)
            assert error.first() == ratings.prediction_error(rated.na.drop(), predicted.na.drop()).first()
            empty = ratings.stored_error(mine.limit(0), theirs).first()
            assert empty == (0, None)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(names) == 2 and not [t.name for t in spark.catalog.listTables() if t.name in names]
