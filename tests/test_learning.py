import random

import numpy as np
import pytest
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD
from pyspark.sql import functions as F

from logtide.operators import cluster, parsers, recommend, regress

# Twelve label / feature pairs on scales from single digits to hundreds.
PAIRS = [(5 + 7 * i * i % 311, 2 + 5 * i * i % 293) for i in range(12)]


def mllib_weight(spark, pairs):
    rdd = spark.sparkContext.parallelize([LabeledPoint(float(y), Vectors.dense([float(x)])) for y, x in pairs])
    return LinearRegressionWithSGD.train(rdd, 20).weights[0]


@pytest.mark.parametrize("scale", [1.0, 300.0])
def test_sgd_equals_mllib(spark, scale):
    pairs = [(y, x / scale) for y, x in PAIRS]
    points = spark.createDataFrame([(float(y), float(x)) for y, x in pairs], "label double, feature double")
    mine = regress.linear_sgd(points).first().weight
    assert mine == pytest.approx(mllib_weight(spark, pairs), rel=1e-9)


def test_exact_fit_and_scaling(spark):
    points = spark.createDataFrame([(2.0 * x, float(x)) for x in range(1, 50)], "label double, feature double")
    fit = regress.linear_exact(points).first()
    assert fit.weight == pytest.approx(2.0) and fit.mse == pytest.approx(0.0, abs=1e-9)
    scaled = regress.scale_feature(points)
    assert scaled.agg(F.max("feature")).first()[0] == 1.0
    assert regress.linear_exact(scaled).first().weight == pytest.approx(98.0)


def test_kmeans(spark):
    points = parsers.parse_points(
        spark.createDataFrame([(f"{x} {y}",) for x, y in PAIRS], "line string")
    )
    model = cluster.kmeans_train(points, k=4, runs=3)
    centres = cluster.kmeans_centres(model)
    assert len(centres) == 4
    cost = cluster.kmeans_cost(points, centres).agg(F.sum("cost")).first()[0]
    assert cost == pytest.approx(model.summary.trainingCost, rel=1e-6)
    middle = [[sum(x for x, _ in PAIRS) / 12, sum(y for _, y in PAIRS) / 12]]
    assert cost < cluster.kmeans_cost(points, middle).first().cost
    new = spark.createDataFrame([([57.0, 30.0],), ([0.0, 0.0],)], "point array<double>")
    for row in cluster.kmeans_assign(new, centres).collect():
        square = [sum((a - b) ** 2 for a, b in zip(row.point, c)) for c in centres]
        assert row.distance == pytest.approx(min(square)) and square[row.cluster] == pytest.approx(min(square))


def test_all_runs_equal_a_plain_loop_from_the_same_centres(spark):
    rng = np.random.default_rng(3)
    made = np.concatenate([rng.normal(m, 0.6, (80, 3)) for m in (0, 4, 9)])
    points = spark.createDataFrame([(p.tolist(),) for p in made], "point array<double>").repartition(5)
    seeds = [made[rng.choice(len(made), 3, replace=False)] for _ in range(4)] + [np.array([made[0], made[0], made[0] + 1e6])]

    def plain(centres):
        for _ in range(20):
            near = ((made[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            centres = np.array([made[near == j].mean(axis=0) if (near == j).any() else c for j, c in enumerate(centres)])
        return ((made[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()

    for some in ([s] for s in seeds):
        assert cluster.kmeans_train(points, seeds=some).summary.trainingCost == pytest.approx(plain(some[0]), rel=1e-6)
    assert cluster.kmeans_train(points, seeds=seeds).summary.trainingCost == pytest.approx(min(map(plain, seeds)), rel=1e-6)


def test_runs_share_their_passes(spark, executed_plans):
    points = spark.range(300).select(F.array((F.col("id") % 17).cast("double"), (F.col("id") % 5).cast("double")).alias("point"))
    passes = [len(executed_plans(lambda: cluster.kmeans_train(points, k=3, runs=runs, max_iter=4, tolerance=0.0))) for runs in (1, 10)]
    assert passes[1] <= passes[0] + 6


def test_few_distinct_points(spark):
    points = spark.createDataFrame([([1.0],)] * 50 + [([2.0],)] * 3, "point array<double>")
    model = cluster.kmeans_train(points, k=4, runs=2)
    assert sorted(model.clusterCenters()) == [[1.0], [2.0]] and model.summary.trainingCost == 0


def test_equally_near_centres_take_the_first(spark):
    points = spark.createDataFrame([([0.0],)], "point array<double>")
    assert cluster.kmeans_assign(points, [[1.0], [-1.0]]).first().cluster == 0


@pytest.fixture
def vectors(spark):
    rng = random.Random(1)
    made = [(i, [rng.choice([-1.0, 0.5, 1.0]) for _ in range(4)]) for i in range(60)]
    return made, spark.createDataFrame(made, "id bigint, features array<double>")


@pytest.mark.parametrize("cell_rows", [7, 2048])
def test_top_products_equal_brute_force(vectors, cell_rows):
    made, df = vectors
    side = recommend.as_vectors(df, "id", "features")
    got = recommend.top_products(side, side, 5, cell_rows).collect()
    for user, v in made:
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), item) for item, w in made))[:5]
        mine = sorted((r.rank, r.item) for r in got if r.user == user)
        assert mine == [(i + 1, item) for i, (_, item) in enumerate(scores)]


def test_short_items_are_skipped_and_the_answer_is_exact(spark):
    rng = np.random.default_rng(4)
    made = [(i, (rng.normal(size=6) * 1.2 ** -i).tolist()) for i in range(90)]
    users = spark.createDataFrame([(i, v) for i, v in made[:30]] + [(99, [0.0] * 6)], "id bigint, vector array<double>")
    items = spark.createDataFrame(made, "id bigint, vector array<double>")
    met = []
    got = recommend.top_products(users, items, 4, 10, met).collect()
    for user, v in [*made[:30], (99, [0.0] * 6)]:
        scores = sorted((-float(np.dot(v, w)), item) for item, w in made)[:4]
        mine = sorted((r["rank"], r.item) for r in got if r.user == user)
        assert mine == [(i + 1, item) for i, (_, item) in enumerate(scores)]
    # 31 users and nine stacks; the zero user meets all nine, others a few.
    assert met[0] == 31 and sum(met) < 31 * 9 / 2


def test_items_of_one_length_are_all_met(spark):
    rng = np.random.default_rng(5)
    made = rng.normal(size=(50, 5))
    made /= np.linalg.norm(made, axis=1)[:, None]
    side = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)], "id bigint, vector array<double>")
    got = recommend.top_products(side, side, 3, 8).collect()
    want = np.argsort(-(made @ made.T), axis=1, kind="stable")[:, :3]
    for user in range(50):
        assert [r.item for r in sorted((r for r in got if r.user == user), key=lambda r: r["rank"])] == want[user].tolist()
    assert recommend.top_products(side.limit(0), side, 3, 8).count() == 0
    assert recommend.top_products(side, side.limit(0), 3, 8).count() == 0


def test_small_scores_keep_their_order(spark):
    users = spark.createDataFrame([(1, [1e-6, 0.0])], "id bigint, features array<double>")
    items = spark.createDataFrame([(1, [1e-5, 0.0]), (2, [2e-5, 0.0]), (3, [3e-5, 0.0])], "id bigint, features array<double>")
    ranked = sorted((r["rank"], r.item) for r in recommend.rank_all_items(users, items, 2).collect())
    assert ranked == [(1, 3), (2, 2)]


def test_many_seeds_are_ranked_in_cells(vectors, monkeypatch, rows):
    _, df = vectors
    seeds = recommend.seed_items(df, 6)
    few = rows(recommend.similar_items(df, seeds, 4), "item", "rank", "other")
    monkeypatch.setattr(recommend, "MOST_SEEDS", 2)
    assert rows(recommend.similar_items(df, seeds, 4), "item", "rank", "other") == few


def test_points_of_another_length_fail(spark):
    points = spark.createDataFrame([([0.0, 1.0],), ([0.0],)], "point array<double>")
    with pytest.raises(Exception, match="has not 2 axes"):
        cluster.kmeans_assign(points, [[1.0, 1.0]]).collect()


def test_plan_does_not_grow_with_the_centres(spark, plan_of):
    points = spark.createDataFrame([([0.0] * 64,)], "point array<double>")
    centres = [[float(i + j) for j in range(64)] for i in range(500)]
    assert cluster.kmeans_assign(points, centres).first().cluster == 0
    assert plan_of(cluster.kmeans_assign(points, centres)).count("zip_with") <= 4


def test_similar_items_include_the_item(vectors, plan_of):
    _, df = vectors
    near = recommend.similar_items(df, recommend.seed_items(df, 4), 3)
    got = near.collect()
    assert len(got) == 12 and all(r.cosine == pytest.approx(1.0) for r in got if r["rank"] == 1)
    assert "NestedLoop" not in plan_of(near) and "Cartesian" not in plan_of(near)


def test_als(spark):
    ratings = spark.createDataFrame(
        [(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(10) if (u + i) % 3], "user int, item int, rate double"
    )
    model = recommend.als_train(ratings, rank=3, max_iter=5, blocks=2)
    asked = spark.createDataFrame([(1, 1), (1, 3), (99, 1), (1, 2012)], "user int, item int")
    assert {(r.user, r.item) for r in recommend.als_predict(model, asked).collect()} == {(1, 1), (1, 3)}
    error = recommend.als_evaluate(model, ratings).first()
    assert error.pairs == ratings.count()
    assert error.mse < ratings.agg(F.var_pop("rate")).first()[0]
    some = spark.createDataFrame([(1,), (2,)], "user int")
    tops = recommend.recommend_top_n(model, 3, some).collect()
    assert sorted((r.user, r["rank"]) for r in tops) == [(u, k) for u in (1, 2) for k in (1, 2, 3)]
    own = {r.user: [x.item for x in r.recommendations] for r in model.recommendForAllUsers(3).collect()}
    assert all([r.item for r in sorted((t for t in tops if t.user == u), key=lambda t: t["rank"])] == own[u] for u in (1, 2))
    by_rank = sorted((r for r in tops if r.user == 1), key=lambda r: r["rank"])
    assert [r.score for r in by_rank] == sorted((r.score for r in by_rank), reverse=True)


def test_als_blocks_go_by_the_ratings(spark, monkeypatch):
    ratings = spark.createDataFrame([(u, i, float(u % 3 + i % 2)) for u in range(20) for i in range(10)], "user int, item int, rate double")
    train = lambda: recommend.als_train(ratings, rank=2, max_iter=1)
    assert {side.rdd.getNumPartitions() for side in (train().userFactors, train().itemFactors)} == {recommend.LEAST_BLOCKS}
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 45)
    assert train().userFactors.rdd.getNumPartitions() == 5


def test_predictions_equal_those_of_the_model_and_pairs_carry_no_factors(spark, monkeypatch, executed_plans):
    ratings = spark.createDataFrame([(u * 7 - 30, i * 5, float((u * i) % 5)) for u in range(40) for i in range(30) if (u + i) % 4], "user int, item int, rate double")
    model = recommend.als_train(ratings, rank=7, max_iter=2)
    pairs = ratings.select("user", "item").unionAll(ratings.select(F.col("user") + 1, "item")).unionAll(ratings.select("user", "item").limit(9))
    pairs = pairs.unionAll(spark.createDataFrame([(5, 2**31 - 1), (-(2**31), 0)], "user int, item int")).repartition(3)
    own = sorted((r.user, r.item, r.prediction) for r in model.transform(pairs).collect())
    for most in (recommend.PART_FACTORS, 5):
        monkeypatch.setattr(recommend, "PART_FACTORS", most)
        got = recommend.als_predict(model, pairs)
        assert got.dtypes == [("user", "int"), ("item", "int"), ("pred", "double")]
        found = sorted(map(tuple, got.collect()))
        assert [r[:2] for r in found] == [r[:2] for r in own] and np.allclose([r[2] for r in found], [r[2] for r in own], rtol=1e-5, atol=1e-6)
    plans = executed_plans(lambda: recommend.als_predict(model, pairs).collect())
    assert any("MapInArrow" in plan for plan in plans) and not any("SortMergeJoin" in plan or "HashJoin" in plan for plan in plans)
    assert recommend.als_predict(model, pairs.limit(0)).count() == 0


def test_bands_and_slabs_equal_brute_force_and_ties_go_by_id(spark):
    rng = np.random.default_rng(8)
    made = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(120)] + [(5, [1.0] * 4), (None, [2.0] * 4)]
    side = spark.createDataFrame(made, "id bigint, vector array<double>")
    got = recommend.top_products(side, side, 3, 8, band_bytes=4096).collect()
    low = -1  # a null id comes first
    for user in {u for u, _ in made}:
        pairs = [(-float(np.dot(v, w)), low if i is None else i) for u, v in made if u == user for i, w in made]
        mine = [low if r.item is None else r.item for r in sorted((r for r in got if r.user == user), key=lambda r: r["rank"])]
        assert mine == [i for _, i in sorted(pairs)[:3]]


def test_a_band_meets_an_item_once(spark, executed_plans):
    made = [(i, [float(np.cos(i)), float(np.sin(i))]) for i in range(64)]
    side = spark.createDataFrame(made, "id bigint, vector array<double>")
    plans = executed_plans(lambda: recommend.top_products(side, side, 2, 8).collect())
    assert any("MapInArrow" in plan for plan in plans) and not any("FlatMapCoGroups" in plan for plan in plans)


def test_near_centres_of_few_and_many_axes():
    rng = np.random.default_rng(2)
    for width in (2, 40):
        points, centres = rng.normal(size=(200, width)), rng.normal(size=(5, width))
        square = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
        near, cost = cluster._near(points, centres)
        assert (near == square.argmin(axis=1)).all() and np.allclose(cost, square.min(axis=1))
    # Columns keep the distance of near points that lie far out; products lose it.
    far = np.array([[1e9, 1e9]])
    assert cluster._near(far, np.array([[1e9 + 1, 1e9], [1e9, 1e9 + 0.25]]))[0].tolist() == [1]
