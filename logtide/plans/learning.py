"""Recommender, clustering and regression jobs."""

from pyspark.sql import functions as F

from ..operators import cluster, parsers, recommend, regress
from ..session import write_through
from .inputs import Inputs
from .registry import register

CENTRES = [[5.0, 5.0], [15.0, 40.0], [30.0, 20.0], [45.0, 45.0]]

RANK = 10


def _ratings(inputs: Inputs):
    return write_through(parsers.parse_ratings(inputs.rating_txt()), "ratings")


def _model(ratings):
    return recommend.als_train(ratings, rank=RANK, max_iter=20)


# Factors depend on the seed and on float summation order, so what is compared
# is which ids got factors, predictions or lists, and how the error stands.


@register("als_train", f"""
    SELECT DISTINCT 'user' AS side, CAST("user" AS INTEGER) AS id, {RANK} AS factors FROM {{RATING}}
    UNION ALL SELECT DISTINCT 'item', CAST(item AS INTEGER), {RANK} FROM {{RATING}}""")
def als_train(inputs: Inputs):
    factors = recommend.als_factors(_model(_ratings(inputs)))
    return factors.select("side", "id", F.size("features").alias("factors"))


@register("als_predict", """
    SELECT CAST("user" AS INTEGER) AS "user", CAST(item AS INTEGER) AS item, true AS predicted FROM {RATING}""")
def als_predict(inputs: Inputs):
    ratings = _ratings(inputs)
    unseen = ratings.select((-F.col("user") - 1).alias("user"), "item")
    pairs = ratings.select("user", "item").unionByName(unseen)
    scored = recommend.als_predict(_model(ratings), pairs)
    return scored.select("user", "item", (~F.isnan("pred")).alias("predicted"))


@register("als_evaluate", """
    SELECT CAST(sum(n * n) AS BIGINT) AS pairs, true AS better_than_mean
    FROM (SELECT "user", item, count(*) AS n FROM {RATING} GROUP BY ALL)""")
def als_evaluate(inputs: Inputs):
    ratings = _ratings(inputs)
    error = recommend.als_evaluate(_model(ratings), ratings)
    variance = ratings.agg(F.var_pop("rate")).scalar()
    return error.select("pairs", (F.col("mse") < variance).alias("better_than_mean"))


@register("recommend_top_n", """
    SELECT CAST(u AS INTEGER) AS "user", CAST(unnest([1, 2, 3]) AS INTEGER) AS rank
    FROM (SELECT DISTINCT "user" AS u FROM {RATING})""")
def recommend_top_n(inputs: Inputs):
    tops = recommend.recommend_top_n(_model(_ratings(inputs)), 3)
    return tops.select(F.col("user").cast("int").alias("user"), "rank")


@register("rank_all_items", """
    SELECT "user", item, score, rank FROM (
      SELECT a.vec_id AS "user", b.vec_id AS item,
        round(list_dot_product(a.v, b.v), 9) AS score,
        CAST(row_number() OVER (PARTITION BY a.vec_id
          ORDER BY list_dot_product(a.v, b.v) DESC, b.vec_id) AS INTEGER) AS rank
      FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) a,
           (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) b)
    WHERE rank <= 20""")
def rank_all_items(inputs: Inputs):
    ranked = recommend.rank_all_items(inputs.vectors(), inputs.vectors(), 20)
    return ranked.withColumn("score", F.round("score", 9))


@register("similar_items", """
    WITH unit AS (SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v
                  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))
    SELECT item, rank, other, cosine FROM (
      SELECT a.vec_id AS item, b.vec_id AS other, round(list_dot_product(a.v, b.v), 9) AS cosine,
        CAST(row_number() OVER (PARTITION BY a.vec_id
          ORDER BY list_dot_product(a.v, b.v) DESC, b.vec_id) AS INTEGER) AS rank
      FROM (SELECT * FROM unit ORDER BY vec_id LIMIT 10) a, unit b)
    WHERE rank <= 10""")
def similar_items(inputs: Inputs):
    items = inputs.vectors()
    near = recommend.similar_items(items, recommend.seed_items(items, 10), 10)
    return near.withColumn("cosine", F.round("cosine", 9))


@register("score_index_join", """
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS idx, vec_id AS item,
      round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS score FROM embeddings""")
def score_index_join(inputs: Inputs):
    items = inputs.vectors().select("id")
    # Vectors are numbered from 0 without gaps, so an id is also a position.
    total = F.aggregate(F.col("features").cast("array<double>"), F.lit(0.0), lambda s, x: s + x)
    scores = inputs.vectors().select(F.col("id").alias("idx"), total.alias("score"))
    joined = recommend.score_index_join(scores, items)
    return joined.select("idx", "item", F.round("score", 6).alias("score"))


@register("kmeans_train", """
    SELECT CAST(4 AS BIGINT) AS clusters, count(*) AS points,
      round(var_pop(x) * count(*) + var_pop(y) * count(*), 3) AS one_centre_cost, true AS cheaper
    FROM (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_orderkey % 50 AS DOUBLE) AS y FROM lineitem)""")
def kmeans_train(inputs: Inputs):
    points = parsers.parse_points(inputs.point_txt())
    centres = cluster.kmeans_centres(cluster.kmeans_train(points, k=4, runs=10))
    costs = cluster.kmeans_cost(points, centres)
    x, y = F.get("point", F.lit(0)), F.get("point", F.lit(1))
    one_centre = points.agg(F.var_pop(x) * F.count("*") + F.var_pop(y) * F.count("*")).scalar()
    trained = costs.agg(F.count("*").alias("clusters"), F.sum("points").alias("points"), F.sum("cost").alias("_cost"))
    return trained.select(
        "clusters", "points", F.round(one_centre, 3).alias("one_centre_cost"), (F.col("_cost") < one_centre).alias("cheaper"))


_DISTANCES = ", ".join(f"pow(x - {x}, 2) + pow(y - {y}, 2)" for x, y in CENTRES)


@register("kmeans_assign_cost", f"""
    SELECT CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster, count(*) AS points,
      round(sum(list_min(d)), 6) AS cost
    FROM (SELECT [{_DISTANCES}] AS d
          FROM (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_orderkey % 50 AS DOUBLE) AS y FROM lineitem))
    GROUP BY 1""")
def kmeans_assign_cost(inputs: Inputs):
    points = parsers.parse_points(inputs.point_txt())
    costs = cluster.kmeans_cost(points, CENTRES)
    return costs.select("cluster", "points", F.round("cost", 6).alias("cost"))


SCALED_SUMS_SQL = """
    sums AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy
      FROM (SELECT CAST(l_quantity AS DOUBLE) AS y,
              CAST(l_orderkey % 50 AS DOUBLE) / max(l_orderkey % 50) OVER () AS x FROM lineitem))"""


@register("linear_sgd", f"""
    WITH RECURSIVE {SCALED_SUMS_SQL},
    steps(t, w, done) AS (
      SELECT 0, CAST(0 AS DOUBLE), false
      UNION ALL
      SELECT t + 1, CASE WHEN done THEN w ELSE moved END,
        done OR abs(moved - w) < 0.001 * greatest(abs(moved), 1)
      FROM (SELECT t, w, done, w - (w * sxx - sxy) / n / sqrt(t + 1) AS moved FROM steps, sums WHERE t < 20))
    SELECT CAST(n AS BIGINT) AS n, round(w, 6) AS weight, round((syy - 2 * w * sxy + w * w * sxx) / n, 6) AS mse
    FROM steps, sums WHERE t = 20""")
def linear_sgd(inputs: Inputs):
    points = regress.scale_feature(parsers.parse_labeled_points(inputs.point_txt()))
    fitted = regress.linear_sgd(points)
    return fitted.select("n", F.round("weight", 6).alias("weight"), F.round("mse", 6).alias("mse"))


@register("linear_exact", f"""
    WITH {SCALED_SUMS_SQL}
    SELECT CAST(n AS BIGINT) AS n, round(sxy / sxx, 6) AS weight,
      round((syy - 2 * sxy / sxx * sxy + sxy / sxx * sxy) / n, 6) AS mse FROM sums""")
def linear_exact(inputs: Inputs):
    points = regress.scale_feature(parsers.parse_labeled_points(inputs.point_txt()))
    fitted = regress.linear_exact(points)
    return fitted.select("n", F.round("weight", 6).alias("weight"), F.round("mse", 6).alias("mse"))
