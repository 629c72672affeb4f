import math

import pytest
from pyspark.sql import functions as F

from logtide.llm import topk


def brute(rows, k, scale=256.0):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in usable:
        if q % 50:
            continue
        found = sorted((-max(min(sum(x * y for x, y in zip(a, b)), 2**63 - 1), -(2**63)), i) for i, b in usable if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("shard, queries, cell, fan", [(2048, 1024, 4, 32), (7, 3, 2, 2)])
def test_topk_equals_brute_force(spark, monkeypatch, shard, queries, cell, fan):
    for name, value in (("SHARD", shard), ("QUERIES", queries), ("CELL", cell), ("FAN_IN", fan)):
        monkeypatch.setattr(topk, name, value)
    import random

    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.01, 0.3, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(160)]
    rows += [(200 + i, rows[3][1]) for i in range(90)]  # one very common vector, so many ties
    rows += [(400, [1e30, -1e30, 0.0, 0.0, 0.0, 0.0]), (401, [1e-3] * 3), (402, None), (403, [1.0, None]), (404, [float("nan")]), (450, [float("inf")]), (451, []), (None, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5).withColumn("score", F.lit("clash"))
    got = topk.exact_topk(table, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_fewer_candidates_than_k_and_nothing(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.exact_topk(table, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.exact_topk(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.exact_topk(table, F.col("vec_id") < 0).count() == 0
