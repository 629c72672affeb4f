"""Collaborative filtering, catalogue ranking and similar items."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import as_doubles, norm, unit
from ..session import write_through
from .als import parts_of, train_factors
from .lookups import lookup_join
from .numbering import dense_index, take_n, top_k_per_key

# Blocks that ALS cuts each side into, at least, and ratings that one block holds, about, at most.
LEAST_BLOCKS = 3
BLOCK_RATINGS = 2_000_000

# Parts that each side is cut into to predict pairs, at least, and factors in a part, about, at most.
LEAST_SIDE = 8
PART_FACTORS = 2_000_000
_PACKED = "cell int, kind int, ids binary, values binary, rates binary"

# Pairs that are gathered before they are packed, and rated ones of a cell before equal ones are folded.
PACK_PAIRS = 500_000
FOLD_PAIRS = 4_000_000

# A rating with the rows that are equal to it, and those of them that have a rate.
_RATED = np.dtype([("rate", "<f8"), ("rows", "<i8"), ("rated", "<i8")])

# Items of a stack.
CELL_ROWS = 2048

# Memory of the users that a task multiplies with all their items.
BAND_BYTES = 64 << 20

# Products held at once.
_PRODUCTS = 1 << 22

# Stands for a null id while products are ranked; it is the first number, as nulls come first.
NO_ID = -(1 << 63)

# Bounds on item lengths that a round of products goes by.
LENGTHS = 64

# Seeds up to this number are scored next to the scan of the items.
MOST_SEEDS = 1024


def als_train(
    ratings: DataFrame,
    rank: int = 10,
    max_iter: int = 20,
    reg: float = 0.01,
    seed: int = 7,
    blocks: int | None = None,
) -> ALSModel:
    """Explicit-feedback ALS on (user, item, rate); pairs with unseen ids get no prediction.

    Users and items are cut into ``blocks`` each, by default as many as hold the ratings
    (counted first), whatever the cluster's size; each block is a task.
    """
    blocks = blocks or max(LEAST_BLOCKS, -(-ratings.count() // BLOCK_RATINGS))
    users, items = train_factors(ratings, rank, max_iter, reg, seed, blocks)
    made = ALSModel._new_java_obj("org.apache.spark.ml.recommendation.ALSModel", f"ALS_{uuid.uuid4().hex[-12:]}", rank, users._jdf, items._jdf)
    model = ALSModel(made).setUserCol("user").setItemCol("item").setColdStartStrategy("drop")
    model._transfer_params_to_java()
    return model


def als_factors(model: ALSModel) -> DataFrame:
    """side ('user' / 'item'), id, features."""
    users = model.userFactors.select(F.lit("user").alias("side"), "id", "features")
    return users.unionByName(model.itemFactors.select(F.lit("item").alias("side"), "id", "features"))


def _packed(cells: list[int], kind: int, ids: list[bytes], values: list[bytes], rates: list[bytes] | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cells, pa.int32()), pa.array([kind] * len(cells), pa.int32()), *(pa.array(x, pa.binary()) for x in (ids, values, rates or [None] * len(cells)))],
        ["cell", "kind", "ids", "values", "rates"])


def _packed_factors(factors: DataFrame, kind: int, side: int) -> DataFrame:
    """Factors of users (kind 0) or items (kind 1) for every cell of their row or column, many in a row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            vectors = batch.column("features").flatten().to_numpy().reshape(len(ids), -1)
            part = parts_of(ids, side)
            cells, packed = [], []
            for mine in np.unique(part).tolist():
                some = part == mine
                for other in range(side):
                    cells.append(other * side + mine if kind else mine * side + other)
                    packed.append((ids[some].astype("<i4").tobytes(), vectors[some].astype("<f4").tobytes()))
            yield _packed(cells, kind, [i for i, _ in packed], [v for _, v in packed])

    return factors.select("id", "features").mapInArrow(pack, _PACKED)


def _gathered(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of about PACK_PAIRS rows."""
    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += batch.num_rows
        if held >= PACK_PAIRS:
            yield [np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in waiting]) for c in names]
            waiting, held = [], 0
    if held:
        yield [np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in waiting]) for c in names]


def _by_cell(users: np.ndarray, items: np.ndarray, side: int, rates: np.ndarray | None = None) -> pa.RecordBatch:
    cell = parts_of(users, side) * side + parts_of(items, side)
    order = np.argsort(cell.astype(np.min_scalar_type(side * side)), kind="stable")
    cells, starts = np.unique(cell[order], return_index=True)
    pieces = np.split(order, starts[1:])
    return _packed(
        cells.tolist(), 2, [users[x].astype("<i4").tobytes() for x in pieces], [items[x].astype("<i4").tobytes() for x in pieces],
        None if rates is None else [rates[x].tobytes() for x in pieces])


def _packed_pairs(pairs: DataFrame, side: int) -> DataFrame:
    """Pairs of ids by cell, many in a row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for users, items in _gathered(batches, ["user", "item"]):
            yield _by_cell(users, items, side)

    return pairs.mapInArrow(pack, _PACKED)


def _folded(users: np.ndarray, items: np.ndarray, rated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal ratings as one, in the order of their pairs."""
    order = np.lexsort((rated["rate"], rated["rated"] > 0, items, users))
    users, items, rated = users[order], items[order], rated[order]
    new = np.ones(len(users), bool)
    new[1:] = (users[1:] != users[:-1]) | (items[1:] != items[:-1]) | (rated["rate"][1:] != rated["rate"][:-1]) | ((rated["rated"][1:] > 0) != (rated["rated"][:-1] > 0))
    starts = np.flatnonzero(new)
    out = rated[starts]
    for name in ("rows", "rated"):
        out[name] = np.add.reduceat(rated[name], starts) if len(starts) else 0
    return users[starts], items[starts], out


def _packed_ratings(ratings: DataFrame, side: int) -> DataFrame:
    """Rated pairs by cell, many in a row, equal ones folded."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for users, items, rates, known in _gathered(batches, ["user", "item", "rate", "known"]):
            rated = np.empty(len(users), _RATED)
            rated["rate"], rated["rows"], rated["rated"] = rates, 1, known
            users, items, rated = _folded(users, items, rated)
            yield _by_cell(users, items, side, rated)

    return ratings.mapInArrow(pack, _PACKED)


class _Factors:
    """Factors of one side in a cell, by id."""

    def __init__(self, packed: list[tuple[bytes, bytes]], rank: int):
        ids = np.frombuffer(b"".join(i for i, _ in packed), "<i4")
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.columns = np.frombuffer(b"".join(v for _, v in packed), "<f4").reshape(-1, rank)[order].T.copy()

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each id, and whether it is there."""
        if not len(self.ids):
            return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return at, self.ids[at] == ids


def _scored(sides: list[_Factors], users: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs have a prediction, and these."""
    (u, known), (i, sold) = sides[0].find(users), sides[1].find(items)
    both = np.flatnonzero(known & sold)
    u, i = u[both], i[both]
    total = np.zeros(len(both), np.float32)
    for a, b in zip(sides[0].columns, sides[1].columns):
        total += a[u] * b[i]
    real = ~np.isnan(total)
    return both[real], total[real].astype(np.float64)


def _met(batches: Iterator[pa.RecordBatch], rank: int) -> Iterator[tuple[int, list[_Factors], bytes, bytes, bytes]]:
    """Packed pairs with their cell and its factors, cell by cell."""
    now, packed, sides = None, ([], []), None
    for batch in batches:
        for cell, kind, ids, values, rates in zip(*(column.to_pylist() for column in batch.columns)):
            if cell != now:
                now, packed, sides = cell, ([], []), None
            if kind < 2:
                packed[kind].append((ids, values))
                continue
            if sides is None:  # factors come before the pairs of their cell
                sides, packed = [_Factors(p, rank) for p in packed], ([], [])
            yield cell, sides, ids, values, rates


def _score_cells(rank: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sides, ids, values, _ in _met(batches, rank):
            users, items = np.frombuffer(ids, "<i4"), np.frombuffer(values, "<i4")
            found, scores = _scored(sides, users, items)
            yield pa.RecordBatch.from_arrays([pa.array(users[found]), pa.array(items[found]), pa.array(scores)], ["user", "item", "pred"])

    return score


def _error_cells(rank: int):
    """Rows of a cell's pairs, multiplied, and the sum of their squared errors."""

    def summed(sides: list[_Factors], users: np.ndarray, items: np.ndarray, rated: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(users), bool)
        new[1:] = (users[1:] != users[:-1]) | (items[1:] != items[:-1])
        starts = np.flatnonzero(new)
        # A pair is predicted as often as it has rows, and each of its rates meets each prediction.
        rows, rates = (np.add.reduceat(rated[name], starts) for name in ("rows", "rated"))
        found, scores = _scored(sides, users[starts], items[starts])
        score = np.full(len(starts), np.nan)
        score[found] = scores
        pair = np.cumsum(new) - 1
        some = ~np.isnan(score)[pair] & (rated["rated"] > 0)
        gap = rated["rate"][some] - score[pair[some]]
        squares = float((rows[pair[some]] * rated["rated"][some] * gap * gap).sum())
        return pa.RecordBatch.from_arrays([pa.array([int((rows * rates)[found].sum())]), pa.array([squares])], ["pairs", "squares"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, held, fresh = None, None, [], 0

        def folded() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return _folded(*(np.concatenate(x) for x in zip(*held)))

        for cell, sides, ids, values, rates in _met(batches, rank):
            if cell != now:
                if held:
                    yield summed(own, *folded())
                now, own, held, fresh = cell, sides, [], 0
            held.append((np.frombuffer(ids, "<i4"), np.frombuffer(values, "<i4"), np.frombuffer(rates, _RATED)))
            fresh += len(held[-1][0])
            if fresh >= FOLD_PAIRS:
                held, fresh = [folded()], 0
        if held:
            yield summed(own, *folded())

    return run


def _side(model: ALSModel) -> int:
    return max(LEAST_SIDE, -(-max(model.userFactors.count(), model.itemFactors.count()) // PART_FACTORS))


def _in_cells(model: ALSModel, packed: DataFrame, side: int) -> DataFrame:
    """A task's rows: the factors of a cell, then its pairs."""
    for kind, factors in enumerate((model.userFactors, model.itemFactors)):
        packed = packed.unionByName(_packed_factors(factors, kind, side))
    return packed.repartitionById(side * side, F.col("cell")).sortWithinPartitions("cell", "kind")


def als_predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """user, item, pred for the given pairs; pairs with unseen ids vanish.

    Users and items are cut into parts, and a cell is a part of the users with one of the items. Each
    factor goes to the cells of its part and each pair to its cell once, so that no pair carries factors
    from task to task. A task holds the factors of a cell; pairs pass by.
    """
    kinds = dict(pairs.dtypes)
    side = _side(model)
    asked = pairs.select(F.col("user").cast("int"), F.col("item").cast("int")).dropna()
    scored = _in_cells(model, _packed_pairs(asked, side), side).mapInArrow(_score_cells(model.rank), "user int, item int, pred double")
    return scored.select(F.col("user").cast(kinds["user"]), F.col("item").cast(kinds["item"]), "pred")


def als_evaluate(model: ALSModel, ratings: DataFrame) -> DataFrame:
    """pairs, mse: mean squared error of the model on ratings, repeated pairs multiplied.

    The error of :func:`prediction_error` on the ratings and what :func:`als_predict` gives for them. Ratings go
    to the cells of their pairs; there each pair is predicted, and only the cell's sums leave.
    """
    side = _side(model)
    rate = F.col("rate").cast("double")
    rated = ratings.select(
        F.col("user").cast("int"), F.col("item").cast("int"), F.coalesce(rate, F.lit(0.0)).alias("rate"), rate.isNotNull().cast("int").alias("known"))
    cells = _in_cells(model, _packed_ratings(rated.dropna(), side), side).mapInArrow(_error_cells(model.rank), "pairs bigint, squares double")
    pairs = F.sum("pairs")
    return cells.agg(F.coalesce(pairs, F.lit(0)).alias("pairs"), F.try_divide(F.sum("squares"), pairs).alias("mse"))


def _best_columns(products: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's n largest values; of equal ones the first columns.

    A partial selection finds the n-th value; only what reaches it is sorted.
    """
    rows, columns = [], []
    last = products.shape[1] - n
    least = np.partition(products, last, axis=1)[:, last] if last > 0 else None
    for i, values in enumerate(products):
        near = np.arange(len(values)) if least is None else np.flatnonzero(values >= least[i])
        best = near[np.argsort(-values[near], kind="stable")[:n]]
        rows.append(np.full(len(best), i))
        columns.append(best)
    return np.concatenate(rows), np.concatenate(columns)


def _best_in_cell(n: int):
    def score(users: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        if users.empty or items.empty:
            return pd.DataFrame({"user": [], "item": [], "score": []}).astype(
                {"user": "int64", "item": "int64", "score": "float64"}
            )
        items = items.sort_values("id")
        products = np.stack(users["vector"]) @ np.stack(items["vector"]).T
        row, best = _best_columns(products, n)
        return pd.DataFrame({
            "user": users["id"].to_numpy()[row],
            "item": items["id"].to_numpy()[best],
            "score": products[row, best],
        })

    return score


class _Band:
    """Users of a band with their best products so far, to be met by items of falling length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, items: list, scores: list, n: int):
        self.ids, self.vectors, self.n = ids, vectors, n
        m = len(ids)
        self.lengths = np.sqrt((vectors * vectors).sum(axis=1))
        self.finite = np.isfinite(self.lengths)
        self.directions = (vectors / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]).astype(np.float32)
        self.scores, self.items = np.full((m, n), -np.inf), np.zeros((m, n), np.int64)
        self.count = np.array([len(i) for i in items], np.int64)
        self.known = np.arange(n)[None, :] < self.count[:, None]  # those that came with the users
        self.scores[self.known] = np.concatenate([np.empty(0), *scores])
        self.items[self.known] = np.concatenate([np.empty(0, np.int64), *items])
        self.least = np.where(self.count >= n, self.scores[:, n - 1], -np.inf)
        self.open = np.flatnonzero(self.finite)

    def _take(self, row: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        """Put found products among the n best of their users: the highest, of equal ones the first items."""
        good = score >= self.least[row]
        row, item, score = row[good], item[good], score[good]
        if not len(row):
            return
        touched = np.unique(row)
        held = np.arange(self.n)[None, :] < self.count[touched][:, None]
        old_row = np.repeat(touched, self.count[touched])
        new = np.arange(len(old_row) + len(row)) >= len(old_row)
        row = np.concatenate([old_row, row])
        item = np.concatenate([self.items[touched][held], item])
        score = np.concatenate([self.scores[touched][held], score])
        known = np.concatenate([self.known[touched][held], np.zeros(int(new.sum()), bool)])
        order = np.lexsort((item, -score, row))
        row, item, score, known = row[order], item[order], score[order], known[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.n
        self.count[touched] = np.minimum(np.bincount(np.searchsorted(touched, row), minlength=len(touched)), self.n)
        at = row[best], place[best]
        self.items[at], self.scores[at], self.known[at] = item[best], score[best], known[best]
        full = touched[self.count[touched] >= self.n]
        self.least[full] = self.scores[full, self.n - 1]

    def _plain(self, users: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, _PRODUCTS // max(len(ids), 1))
        for at in range(0, len(users), step):
            some = users[at : at + step]
            products = self.vectors[some] @ vectors.T
            row, column = np.nonzero(products >= self.least[some][:, None])
            self._take(some[row], ids[column], products[row, column])

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Items none of which is longer than those met before; lengths that are no numbers may come at any time.

        Directions are compared in single precision, with room for its error; what may reach a user's
        n-th score is multiplied again in double precision.
        """
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        finite = np.isfinite(lengths)
        if not finite.all():
            self._plain(np.arange(len(self.ids)), ids[~finite], vectors[~finite])
            ids, vectors, lengths = ids[finite], vectors[finite], lengths[finite]
        if not len(ids):
            return
        if not self.finite.all():
            self._plain(np.flatnonzero(~self.finite), ids, vectors)
        longest = lengths.max()
        room = (vectors.shape[1] + 8) * 2.0**-23
        scaled = (vectors / (longest or 1.0)).astype(np.float32).T
        size = self.lengths * longest
        self.open = self.open[size[self.open] * (1 + 1e-9) >= self.least[self.open]]
        step = max(1, _PRODUCTS // len(ids))
        for at in range(0, len(self.open), step):
            some = self.open[at : at + step]
            with np.errstate(divide="ignore", invalid="ignore"):
                reach = np.where(size[some] > 0, self.least[some] / size[some], -np.inf) - room
            hit = np.flatnonzero((self.directions[some] @ scaled >= reach.astype(np.float32)[:, None]).ravel())
            row, column = hit // len(ids), hit % len(ids)
            for low in range(0, len(hit), _PRODUCTS // 16):
                r, c = some[row[low : low + _PRODUCTS // 16]], column[low : low + _PRODUCTS // 16]
                self._take(r, ids[c], (self.vectors[r] * vectors[c]).sum(axis=1))

    def found(self) -> pa.RecordBatch:
        """user, item, score of the products that did not come with the users."""
        held = (np.arange(self.n)[None, :] < self.count[:, None]) & ~self.known
        row, place = np.nonzero(held)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[row]), pa.array(self.items[row, place]), pa.array(self.scores[row, place])], ["user", "item", "score"])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if (np.diff(column.offsets.to_numpy()) != width).any():
        raise ValueError(f"a vector has not {width} numbers")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _meet_in_order(n: int, width: int):
    """Rows of a task lie by cell, in a cell first the users, then the items by falling length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, band, waiting = None, None, []

        def ready() -> _Band:
            ids, vectors, items, scores = zip(*waiting)
            return _Band(np.concatenate(ids), np.concatenate(vectors), sum(items, []), sum(scores, []), n)

        for batch in batches:
            cells = batch.column("_cell").to_numpy()
            users = batch.column("_place").to_numpy() < 0
            cuts = np.flatnonzero((cells[1:] != cells[:-1]) | (users[1:] != users[:-1])) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)]):
                part = batch.slice(low, high - low)
                if cells[low] != cell:
                    if band is not None:
                        yield band.found()
                    cell, band, waiting = cells[low], None, []
                ids, vectors = part.column("id").to_numpy(), _matrix(part.column("vector"), width)
                if users[low]:
                    items, scores = part.column("items"), part.column("scores")
                    waiting.append((ids, vectors, [np.array(i, np.int64) for i in items.to_pylist()], [np.array(s, float) for s in scores.to_pylist()]))
                elif waiting or band is not None:
                    if band is None:
                        band, waiting = ready(), []
                    band.meet(ids, vectors)
        if band is not None:
            yield band.found()

    return run


def _first_products(n: int, width: int, ids: np.ndarray, vectors: np.ndarray):
    """Users with their n best among a few items."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, _PRODUCTS // max(len(ids), 1))
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                products = _matrix(part.column("vector"), width) @ vectors.T
                items, scores = [], []
                for values in products:
                    # A product that is no number has no rank.
                    near = np.flatnonzero(~np.isnan(values))
                    if len(near) > n:
                        near = near[values[near] >= np.partition(values[near], len(near) - n)[len(near) - n]]
                    best = near[np.argsort(-values[near], kind="stable")[:n]]
                    items.append(ids[best])
                    scores.append(values[best])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("vector"), pa.array(items, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))],
                    ["id", "vector", "items", "scores"])

    return run


def top_products(
    users: DataFrame, items: DataFrame, n: int, cell_rows: int = CELL_ROWS, met: list | None = None, band_bytes: int = BAND_BYTES
) -> DataFrame:
    """user, rank, item, score: the n items with the largest vector product per user.

    Both inputs are (id bigint, vector array<double>). Items are put in stacks of ``cell_rows``
    by falling length. All users meet the first stack where they lie. A product is at most the product of the lengths
    (Cauchy-Schwarz), so a user whose n-th score beats its length times that of a stack's longest
    item meets neither that stack nor a later one; the others are put in bands of about ``band_bytes``, those with alike
    last stacks together, and a band's items are sent to it once, down to its last stack. A task holds one band
    and reads its items by falling length in batches; users whose n-th score is out of reach leave as it goes,
    so the answer is exact. Few bands are cut into several tasks, each with every so manieth stack.
    Items of one length leave nothing to skip; the work is then users x items products, the rows sent users + items x bands.
    Equal scores are ordered by item id; a null id comes first. A product that is not a number has no rank. ``met`` receives the
    number of (user, stack) meetings of the first stack, and the most of those that may follow.
    """
    spark = users.sparkSession
    best_first = [F.col("score").desc(), "item"]
    known = F.coalesce("id", F.lit(NO_ID)).alias("id")
    sized = write_through(items.select(known, "vector", norm("vector").alias("_norm")), "item-lengths")
    total, width = sized.agg(F.count("*"), F.max(F.size("vector"))).first()
    empty = users.select(F.col("id").alias("user"), F.lit(0).alias("rank"), F.col("id").alias("item"), F.lit(0.0).alias("score")).limit(0)
    if not total:
        return empty
    width = max(width, 1)
    cell_rows = max(1, min(cell_rows, BAND_BYTES // (8 * width)))
    stacks = -(-total // cell_rows)
    # A length that is not a number comes first and is never skipped.
    longest = [F.isnan("_norm").desc(), F.col("_norm").isNull().desc(), F.col("_norm").desc(), "id"]
    ordered = dense_index(sized, longest, "_place") if stacks > 1 else sized.withColumn("_place", F.lit(0).cast("bigint"))
    ordered = ordered.withColumn("_stack", F.floor(F.col("_place") / cell_rows).cast("int"))
    if stacks > 1:
        ordered = write_through(ordered, "item-stacks")
    few = ordered.where("_stack = 0").select("id", "vector").toArrow().combine_chunks()  # at most cell_rows items
    first = _first_products(n, width, few.column("id").to_numpy(), _matrix(pa.concat_arrays(few.column("vector").chunks), width))
    begun = users.select(known, "vector").mapInArrow(first, "id bigint, vector array<double>, items array<bigint>, scores array<double>")
    if stacks > 1 or met is not None:
        begun = write_through(begun, "users")
    if met is not None:
        met.append(begun.count())
    best = begun.select(F.col("id").alias("user"), F.inline(F.arrays_zip(F.col("items").alias("item"), F.col("scores").alias("score"))))
    if stacks > 1:
        # The longest item of every `step` stacks to come: at most LENGTHS numbers.
        step = -(-(stacks - 1) // LENGTHS)
        group = F.floor((F.col("_stack") - 1) / step)
        coming = ordered.where("_stack > 0").groupBy(group.alias("_group")).agg(
            F.max(F.when(F.col("_norm").isNull(), float("nan")).otherwise(F.col("_norm"))).alias("_norm"))
        lengths = [r[1] for r in coming.orderBy("_group").collect()]
        # What a user's n-th score does not rule out; the slack covers rounding.
        least = F.when(F.size("scores") >= n, F.get("scores", F.lit(n - 1)))
        bound = norm("vector") * (1 + 1e-9)
        groups = F.size(F.filter(F.lit(lengths), lambda length: F.coalesce(length * bound >= least, F.lit(True))))
        left = begun.withColumn("_last", F.least(step * groups, F.lit(stacks - 1))).where("_last >= 1")
        band_rows = max(1, band_bytes // (12 * width + 48 * n + 64))
        placed = dense_index(left, [F.col("_last").desc()], "_at").withColumn("_band", F.floor(F.col("_at") / band_rows))
        # One number per band, falling.
        reaches = placed.groupBy("_band").agg(F.max("_last").alias("_last"), F.sum("_last").alias("_met")).orderBy("_band").collect()
        if met is not None:
            met.append(sum(r["_met"] for r in reaches))
        if reaches:
            lasts = [r["_last"] for r in reaches]
            slabs = max(1, min(stacks - 1, -(-2 * spark.sparkContext.defaultParallelism // len(lasts))))
            cell = (F.col("_band") * slabs + F.col("_slab")).cast("int").alias("_cell")
            asking = placed.withColumn("_slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))).select(
                cell, F.lit(-1).cast("bigint").alias("_place"), "id", "vector", "items", "scores")
            reached = F.size(F.filter(F.lit(lasts), lambda last: last >= F.col("_stack")))
            bands = F.explode(F.when(reached > 0, F.sequence(F.lit(0), reached - 1))).alias("_band")
            none = [F.lit(None).cast("array<bigint>").alias("items"), F.lit(None).cast("array<double>").alias("scores")]
            coming = ordered.where("_stack > 0").select("*", bands, F.pmod("_stack", F.lit(slabs)).alias("_slab")).select(
                cell, "_place", "id", "vector", *none)
            cells = asking.unionByName(coming).repartitionById(len(lasts) * slabs, F.col("_cell")).sortWithinPartitions("_cell", "_place")
            found = cells.mapInArrow(_meet_in_order(n, width), "user bigint, item bigint, score double")
            best = write_through(best.unionByName(found), "best-products")
    best = best.select(*[F.nullif(F.col(c), F.lit(NO_ID)).alias(c) for c in ("user", "item")], "score")
    return top_k_per_key(best, n, ["user"], best_first).select("user", "rank", "item", "score")


def as_vectors(df: DataFrame, id_column: str, vector: str, normalise: bool = False) -> DataFrame:
    """Any id and vector columns -> (id bigint, vector array<double>); zero vectors go when normalised."""
    values = unit(vector) if normalise else as_doubles(vector)
    return df.select(F.col(id_column).cast("bigint").alias("id"), values.alias("vector")).where(
        F.col("vector").isNotNull()
    )


def rank_all_items(users: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """The catalogue ranked per user by factor product, down to rank n.

    The item ids travel with their factors, so no position -> id map is needed.
    """
    return top_products(as_vectors(users, "id", "features"), as_vectors(items, "id", "features"), n)


def recommend_top_n(model: ALSModel, n: int, users: DataFrame | None = None) -> DataFrame:
    """user, rank, item, score: the n best items for the given users, or for all.

    Scored by ``top_products``; the model's own recommend methods would plan a
    cross join of factor blocks.
    """
    chosen = model.userFactors
    if users is not None:
        asked = users.select(F.col("user").alias("id")).distinct()
        chosen = lookup_join(chosen, asked, ["id"], "left_semi")
    return rank_all_items(chosen, model.itemFactors, n)


def similar_items(items: DataFrame, seeds: DataFrame, n: int = 10) -> DataFrame:
    """item, rank, other, cosine: the n nearest items of each seed, itself included.

    Both inputs are (id, features). Up to MOST_SEEDS seeds go to the tasks that read the
    items, which send on the n best of each batch; more seeds are ranked in cells.
    """
    asked = as_vectors(seeds, "id", "features", normalise=True)
    catalogue = as_vectors(items, "id", "features", normalise=True)
    few = asked.limit(MOST_SEEDS + 1).toPandas()
    if len(few) > MOST_SEEDS:
        nearest = top_products(asked, catalogue, n)
    else:
        score = _best_in_cell(n)

        def near(batches):
            for batch in batches:
                yield score(few, batch)

        best = catalogue.mapInPandas(near, "user bigint, item bigint, score double")
        nearest = top_k_per_key(best, n, ["user"], [F.col("score").desc(), "item"])
    return nearest.select(
        F.col("user").alias("item"), "rank", F.col("item").alias("other"), F.col("score").alias("cosine")
    )


def seed_items(items: DataFrame, n: int = 10) -> DataFrame:
    """The n first items by id."""
    return take_n(items, n, "id")


def score_index_join(scores: DataFrame, items: DataFrame) -> DataFrame:
    """Scores by catalogue position (idx, score) -> idx, item, score.

    A position is an item's place in id order, counted from 0.
    """
    positions = dense_index(items.select(F.col("id").alias("item")), ["item"], "idx")
    return scores.join(positions, "idx").select("idx", "item", "score")
