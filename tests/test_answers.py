"""Every registered query against its SQL answer, and what must not occur in any plan it runs.

A query that checkpoints, writes through or streams runs several plans; all of them are
looked at, so a nested loop in the work before the last read-back is seen too.
"""

import pytest
from check_answers import compare, connect

from logtide import plans

QUERIES, ORACLES = plans.queries(), plans.oracles()

# Queries that run Python inside tasks (matrix products).
MATRIX = {"rank_all_items", "similar_items", "recommend_top_n"}
# Queries that run the ML library, whose own jobs are not plans of this package.
LIBRARY = {"als_train", "als_predict", "als_evaluate", "kmeans_train", "recommend_top_n"}


@pytest.fixture(scope="module")
def db(data):
    return connect(data)


@pytest.mark.parametrize("name", list(QUERIES))
def test_answer(spark, data, db, executed_plans, name):
    results = []
    ran = executed_plans(lambda: results.append(compare(QUERIES[name](spark, data), db, ORACLES[name])))
    assert results[0].startswith("ok") and not results[0].startswith("ok 0 "), results[0]
    assert ran
    for plan in () if name in LIBRARY else ran:
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        python = [p for p in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapCoGroups") if p in plan]
        assert name in MATRIX or not python


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ORACLES)
