import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logtide.operators import als, recommend

RANK, REG, BLOCKS = 3, 0.05, 4


def plain(ratings, users, rounds):
    """The same by one id after the other; users: start factors by id."""
    items = {}
    for _ in range(rounds):
        for mine, theirs, turn in ((items, users, 1), (users, items, 0)):
            for x in {r[turn] for r in ratings}:
                rated = [(theirs[r[1 - turn]], r[2]) for r in ratings if r[turn] == x]
                v, rate = np.array([f for f, _ in rated], float), np.array([r for _, r in rated])
                mine[x] = np.linalg.solve(v.T @ v + REG * len(v) * np.eye(RANK), v.T @ rate).astype(np.float32)
    return users, items


@pytest.fixture
def ratings():
    rng = np.random.default_rng(5)
    made = {(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(-20, 20, 300), rng.integers(0, 15, 300), rng.integers(1, 6, 300))}
    hot = [(7, int(i), float(i % 4)) for i in rng.integers(0, 15, 40)]  # pairs come again, with equal and with other rates
    return [*made, *hot, (2**31 - 1, 3, 2.0), (-(2**31), 3, 1.0)]


@pytest.mark.parametrize("chunk", [7, 64, 10**6])
def test_blocks_in_chunks_equal_one_id_after_the_other(ratings, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(als, "CHUNK_RATINGS", chunk)
    monkeypatch.setattr(als, "SOLVED_IDS", 2)
    monkeypatch.setattr(als, "DEAL_RATINGS", 100)
    folder = f"file://{tmp_path}"
    users, items, rates = zip(*ratings)
    table = pa.table({"user": pa.array(users, pa.int32()), "item": pa.array(items, pa.int32()), "rate": pa.array(rates, pa.float32())})
    dealt = pa.Table.from_batches(als._deal(BLOCKS)(iter(table.to_batches(max_chunksize=30))))
    found = []
    for block in range(2 * BLOCKS):
        mine = dealt.filter(pa.compute.equal(dealt["block"], block))
        found += [b.column("block")[0].as_py() for b in als._keep(folder)(iter(mine.to_batches()))]
    assert found and als._keep(folder)(iter([])) is not None
    for block in found:
        als._place(folder, BLOCKS)(block)
        als._begin(folder, f"{folder}/0", RANK, 7)(block)
    factors = lambda at, some: {
        int(i): f for b in some for i, f in zip(als._get(f"{folder}/ids", str(b), "<i4"), als._get(f"{folder}/{at}", str(b), "<f4").reshape(-1, RANK))}
    sides = [b for b in found if b < BLOCKS], [b for b in found if b >= BLOCKS]
    want = plain(ratings, dict(factors("0", sides[0])), 2)
    at = "0"
    for half in range(4):
        for block in sides[1 - half % 2]:
            als._solve(folder, BLOCKS, f"{folder}/{at}", f"{folder}/{half + 1}", RANK, REG)(block)
        at = str(half + 1)
    for got, side in ((factors("4", sides[0]), want[0]), (factors("3", sides[1]), want[1])):
        assert got.keys() == side.keys()
        assert all(np.allclose(got[i], side[i], rtol=1e-3, atol=1e-4) for i in side)


def test_training_equals_one_id_after_the_other_and_leaves_no_files(spark, ratings):
    from logtide.session import work_root

    df = spark.createDataFrame(ratings, "user int, item int, rate double")
    start, model = (recommend.als_train(df, rank=RANK, max_iter=rounds, reg=REG, blocks=3) for rounds in (0, 2))
    factors = lambda side: {r.id: np.array(r.features) for r in side.collect()}
    assert all(np.linalg.norm(f) == pytest.approx(1, abs=1e-5) for f in factors(start.userFactors).values())
    for got, want in zip((model.userFactors, model.itemFactors), plain(ratings, factors(start.userFactors), 2)):
        got = factors(got)
        assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], rtol=1e-3, atol=1e-4) for i in want)
    path = spark._jvm.org.apache.hadoop.fs.Path(work_root(spark))
    left = [f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    assert not [name for name in left if name.startswith("als-")]


def test_a_block_is_a_task_of_bounded_ratings(spark):
    # 216 million ratings were three tasks before, whatever the cluster.
    assert -(-216_000_000 // recommend.BLOCK_RATINGS) >= 48
    df = spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(9)], "user int, item int, rate double")
    for odd, why in ((df.withColumn("user", F.lit(2**31)), "user is not"), (df.withColumn("item", F.lit(None).cast("int")), "item is not"), (df.withColumn("rate", F.lit(float("nan"))), "rate is not")):
        with pytest.raises(Exception, match=why):
            recommend.als_train(odd, rank=2, max_iter=1)
    with pytest.raises(ValueError, match="no ratings"):
        recommend.als_train(df.limit(0), rank=2, max_iter=1)


def test_the_error_in_cells_equals_that_of_the_joined_predictions(spark, ratings, monkeypatch, executed_plans):
    from logtide.operators.ratings import prediction_error

    rated = [*ratings, *ratings[:9], (7, 3, None), (7, 3, 1.0), (7, 14, None), (99, 3, 1.0), (7, 99, 1.0), (None, 3, 1.0), (7, None, 1.0)]
    model = recommend.als_train(spark.createDataFrame(ratings, "user int, item int, rate double"), rank=RANK, max_iter=1)
    for kind in ("int", "bigint"):
        df = spark.createDataFrame(rated, f"user {kind}, item {kind}, rate double").repartition(5)
        want, got = (prediction_error(df, recommend.als_predict(model, df)), recommend.als_evaluate(model, df))
        assert got.dtypes == want.dtypes
        want, got = want.first(), got.first()
        assert got.pairs == want.pairs and got.mse == pytest.approx(want.mse, rel=1e-9)
    assert tuple(recommend.als_evaluate(model, df.where("user = 99")).first()) == (0, None)
    plans = executed_plans(lambda: recommend.als_evaluate(model, df).collect())
    assert not any("SortMergeJoin" in plan or "HashJoin" in plan for plan in plans)


def test_ratings_of_a_cell_fold_as_they_come(monkeypatch):
    rng = np.random.default_rng(3)
    users, items, rates = rng.integers(0, 4, 200).astype("i4"), rng.integers(0, 4, 200).astype("i4"), rng.integers(0, 3, 200) * 1.0
    table = pa.RecordBatch.from_arrays([pa.array(users), pa.array(items), pa.array(rates), pa.array(np.ones(200, "i4"))], ["user", "item", "rate", "known"])

    class Frame:  # runs the function of mapInArrow here
        def mapInArrow(self, function, _):
            return list(function(iter([table.slice(i, 20) for i in range(0, 200, 20)])))

    monkeypatch.setattr(recommend, "PACK_PAIRS", 40)
    factors = [(np.arange(4, dtype="<i4").tobytes(), rng.normal(size=(4, 2)).astype("<f4").tobytes()) for _ in range(2)]
    sums = []
    for most in (30, 10**6):
        monkeypatch.setattr(recommend, "FOLD_PAIRS", most)
        packs = [recommend._packed([0], kind, [f[0]], [f[1]]) for kind, f in enumerate(factors)] + recommend._packed_ratings(Frame(), 1)
        sums.append([tuple(b.to_pylist()[0].values()) for b in recommend._error_cells(2)(iter(packs))])
    vectors = [np.frombuffer(f[1], "<f4").reshape(4, 2) for f in factors]
    score = (vectors[0][users] * vectors[1][items]).sum(axis=1, dtype=np.float32)
    rows = np.array([((users == u) & (items == i)).sum() for u, i in zip(users, items)])
    assert [s[0] for x in sums for s in x] == [rows.sum()] * 2
    assert np.allclose([s[1] for x in sums for s in x], (rows * (rates - score) ** 2).sum(), rtol=1e-5)
