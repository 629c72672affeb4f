"""Exact top-k by inner product, in tiles.

Vectors are gathered into shards (blocks of rows as one matrix), queries into query
blocks. Every query block meets every shard once, by an equality join on the shard's cell;
each tile is one matrix product with a partial selection per query, and the tiles' short
lists are merged level by level. Shuffled: each query block once per cell, each vector once.

Defined results: vectors that are null or hold a null or non-finite component take no part,
nor do rows without an id; a shorter vector counts as filled up with zeros, an empty one scores 0; rows with the
query's own id are no candidates; each row with a query's id is a query of its own; ties go
to the smaller id; scores beyond the range of a long stay at its end; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import write_through

SHARD = 2048  # rows of a shard
QUERIES = 1024  # rows of a query block
CELL = 4  # shards that share one copy of the query blocks
FAN_IN = 32  # short lists merged by one window

_BLOCK = "n int, dim int, ids binary, components binary"


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))


def blocks(rows: DataFrame, size: int, scale: float) -> DataFrame:
    """Rows as blocks of at most ``size``: ids and floor(scale * component) as one matrix of doubles, rows by id."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0

        def flush(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("vec_id", kind="stable")
            dim = max(map(len, rows["v"]))
            matrix = np.zeros((len(rows), dim))
            for i, v in enumerate(rows["v"]):
                matrix[i, : len(v)] = v
            return pd.DataFrame({
                "n": [len(rows)], "dim": [dim], "ids": [rows["vec_id"].to_numpy("<i8").tobytes()],
                "components": [np.floor(scale * matrix).astype("<f8").tobytes()]})

        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= size:
                rows = pd.concat(held, ignore_index=True)
                full = n - n % size
                for at in range(0, full, size):
                    yield flush(rows.iloc[at : at + size])
                held, n = ([rows.iloc[full:]], n - full) if n > full else ([], 0)
        if n:
            yield flush(pd.concat(held, ignore_index=True))

    return rows.mapInPandas(build, _BLOCK).withColumn("block", F.monotonically_increasing_id())


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T for whole-numbered doubles, exactly: in doubles where no sum can pass 2^53, else in whole numbers of any size."""
    dim = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, dim - m.shape[1]))) for m in (a, b))
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * dim
    if largest < 2.0**53:
        return (a @ b.T).astype(np.int64)
    ends = np.iinfo(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, ends.min, ends.max).astype(np.int64)


def select(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k best; columns are in id order, so ties go to the left. ``own`` marks what is no candidate."""
    tops = None
    if scores.shape[1] > 4 * k:
        # Rows that are no candidates may be among the best, so that many more are kept.
        last = max(scores.shape[1] - k - int(own.sum(axis=1).max(initial=0)), 0)
        tops = np.partition(scores, last, axis=1)[:, last]
    rows, columns = [], []
    for i, row in enumerate(scores):
        candidates = np.flatnonzero(~own[i] if tops is None else (row >= tops[i]) & ~own[i])
        # ~x orders as -x does, without its overflow at the smallest long.
        best = candidates[np.argsort(~row[candidates], kind="stable")[:k]]
        rows.append(np.full(len(best), i))
        columns.append(best)
    return np.concatenate(rows), np.concatenate(columns)


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for every row that ``is_query`` (on vec_id) holds for."""
    rows = usable(vectors, vector)
    shards = write_through(blocks(rows, SHARD, scale), "shards")
    asked = write_through(blocks(rows.filter(is_query), QUERIES, scale), "queries")
    n_cells = -(-shards.count() // CELL)
    if not n_cells:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    right = shards.withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(n_cells)))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_cells - 1).cast("long")))
    left = asked.select(*[F.col(c).alias(f"q_{c}") for c in asked.columns], each.alias("cell"))
    tiles = left.join(right.hint("merge"), "cell")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch.itertuples(index=False):
                a = np.frombuffer(t.q_components, "<f8").reshape(t.q_n, t.q_dim)
                b = np.frombuffer(t.components, "<f8").reshape(t.n, t.dim)
                asked_ids, ids = np.frombuffer(t.q_ids, "<i8"), np.frombuffer(t.ids, "<i8")
                found = product(a, b)
                row, column = select(found, asked_ids[:, None] == ids[None, :], k)
                yield pd.DataFrame({
                    "q_block": np.full(len(row), t.q_block), "q_row": row, "query_id": asked_ids[row],
                    "cell": np.full(len(row), t.cell), "vec_id": ids[column], "score": found[row, column]})

    lists = tiles.mapInPandas(score, "q_block long, q_row int, query_id long, cell long, vec_id long, score long")
    n = n_cells
    while True:
        n = -(-n // FAN_IN)
        lists = lists.withColumn("cell", F.expr(f"cell div {FAN_IN}"))
        best = W.partitionBy("q_block", "q_row", "cell").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        if n == 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")
