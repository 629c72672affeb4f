"""k-means on array<double> points."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_through

ROUNDS = 2  # sampling passes of the seeding
_CHUNK = 1 << 21  # distances held at once
_FEW = 64  # numbers in the centres, up to which distances are taken column by column


@dataclass(frozen=True)
class Summary:
    trainingCost: float


@dataclass(frozen=True)
class KMeansCentres:
    """Centres of the cheapest run and their cost over all points."""

    centres: list[list[float]]
    summary: Summary

    def clusterCenters(self) -> list[list[float]]:
        return self.centres


def _unit(numbers: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each whole number and a seed."""
    with np.errstate(over="ignore"):
        x = numbers.astype(np.uint64) + np.uint64(seed % (1 << 32)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).astype(np.float64) / 2.0**64


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers, points) of each batch, in slices of bounded size."""
    for batch in batches:
        points = batch.column("point").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        numbers = batch.column("n").to_numpy()
        step = max(1, _CHUNK // max(width, 64))
        for at in range(0, len(points), step):
            yield numbers[at : at + step], points[at : at + step]


def _near(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the squared distance to it."""
    if centres.size <= _FEW:
        # Centre by centre and axis by axis: whole columns, nothing per point.
        axes = np.ascontiguousarray(points.T)
        near, least = np.zeros(len(points), np.int64), None
        for c, centre in enumerate(centres):
            square = np.zeros(len(points))
            for x, at in zip(axes, centre):
                gap = x - at
                gap *= gap
                square += gap
            if least is None:
                least = square
            else:
                near[square < least] = c
                np.minimum(least, square, out=least)
        return near, least
    products = points @ centres.T
    near = ((centres * centres).sum(axis=1)[None, :] - 2 * products).argmin(axis=1)
    return near, ((points - centres[near]) ** 2).sum(axis=1)


def _sums(points: DataFrame, runs: list[np.ndarray], width: int) -> tuple[list[np.ndarray], list[np.ndarray], list[float]]:
    """Per run: points and sum of points per centre, and the cost. One pass over the points for all runs."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Columns: the sum of the points, their number, their cost.
        sums = [np.zeros((len(c), width + 2)) for c in runs]
        for _, some in _batches(batches, width):
            axes = np.ascontiguousarray(some.T)
            for total, centres in zip(sums, runs):
                near, cost = _near(some, centres)
                for j in range(width):
                    total[:, j] += np.bincount(near, axes[j], len(centres))
                total[:, width] += np.bincount(near, minlength=len(centres))
                total[:, width + 1] += np.bincount(near, cost, len(centres))
        rows = [(r, c, j, x) for r, total in enumerate(sums) for c, row in enumerate(total) if row[width] for j, x in enumerate(row)]
        columns = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.float64()))], ["run", "centre", "j", "x"])

    found = [np.zeros((len(c), width + 2)) for c in runs]
    partial = points.mapInArrow(add, "run int, centre int, j int, x double")
    # As many numbers as the centres of all runs have.
    for r in partial.groupBy("run", "centre", "j").agg(F.sum("x").alias("x")).collect():
        found[r.run][r.centre, r.j] = r.x
    return [f[:, width] for f in found], [f[:, :width] for f in found], [float(f[:, width + 1].sum()) for f in found]


def _sampled(points: DataFrame, runs: list[np.ndarray], costs: list[float], wanted: int, seed: int, width: int) -> list[np.ndarray]:
    """About ``wanted`` points of each run, drawn by their distance to the run's centres. One pass for all runs."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, some in _batches(batches, width):
            run, picked = [], []
            for r, (centres, cost) in enumerate(zip(runs, costs)):
                chance = wanted * _near(some, centres)[1] / cost if cost else np.zeros(len(some))
                hit = np.flatnonzero(_unit(numbers, seed + 7919 * r) < chance)
                run += [r] * len(hit)
                picked += some[hit].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(run, pa.int32()), pa.array(picked, pa.list_(pa.float64()))], ["run", "point"])

    found: list[list] = [[] for _ in runs]
    for r in points.mapInArrow(draw, "run int, point array<double>").distinct().orderBy("run", "point").collect():
        found[r.run].append(r.point)
    return [np.array(f).reshape(-1, width) for f in found]


def _spread(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k of some weighted points, each drawn by its weight and its distance to those before."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    for _ in range(k - 1):
        force = weights * _near(candidates, candidates[chosen])[1]
        if not force.sum():
            break
        chosen.append(int(rng.choice(len(candidates), p=force / force.sum())))
    return candidates[chosen]


def kmeans_seeds(points: DataFrame, k: int, runs: int, seed: int, width: int) -> list[np.ndarray]:
    """First centres of every run: candidates are drawn in ROUNDS passes, weighed by the points near them, and thinned to k."""
    first = points.agg(*[F.min_by("point", F.xxhash64("n", F.lit(seed + r))).alias(f"run{r}") for r in range(runs)]).first()
    candidates = [np.array([p], float).reshape(1, width) for p in first]
    for turn in range(ROUNDS):
        costs = _sums(points, candidates, width)[2]
        drawn = _sampled(points, candidates, costs, 2 * k, seed + 104729 * (turn + 1), width)
        candidates = [np.unique(np.concatenate([c, d]), axis=0) for c, d in zip(candidates, drawn)]
    weights = _sums(points, candidates, width)[0]
    return [_spread(c[w > 0], w[w > 0], k, seed + r) for r, (c, w) in enumerate(zip(candidates, weights))]


def kmeans_train(
    points: DataFrame, k: int = 4, max_iter: int = 20, runs: int = 10, seed: int = 1, tolerance: float = 1e-4, seeds: Sequence[np.ndarray] | None = None
) -> KMeansCentres:
    """The cheapest of ``runs`` trainings that differ in their first centres.

    All runs go through the points together: one aggregation per step gives the sums of every
    (run, centre), and only these reach the driver. Runs whose centres no longer move are left out of later
    steps. Centres without points stay; with fewer than k distinct points there are fewer centres. ``seeds`` sets the first centres.
    """
    held = write_through(points.select("point", F.monotonically_increasing_id().alias("n")), "points")
    width = held.agg(F.max(F.size("point"))).first()[0]
    if width is None:
        raise ValueError("no points")
    centres = [np.asarray(s, float) for s in seeds] if seeds is not None else kmeans_seeds(held, k, runs, seed, width)
    going = list(range(len(centres)))
    for _ in range(max_iter):
        counts, sums, _ = _sums(held, [centres[r] for r in going], width)
        still = []
        for r, n, total in zip(going, counts, sums):
            new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[r])
            if ((new - centres[r]) ** 2).sum(axis=1).max() > tolerance**2:
                still.append(r)
            centres[r] = new
        going = still
        if not going:
            break
    costs = _sums(held, centres, width)[2]
    best = int(np.argmin(costs))
    return KMeansCentres([[float(x) for x in c] for c in centres[best]], Summary(costs[best]))


def kmeans_centres(model: KMeansCentres) -> list[list[float]]:
    """Centres as plain lists, one per cluster."""
    return [[float(x) for x in centre] for centre in model.clusterCenters()]


def _nearest(point: Column, centres: Sequence[Sequence[float]]) -> Column:
    """struct(distance, cluster) of the nearest centre; the first of equally near ones.

    The centres are one constant that the expression walks, so the plan has the same
    few nodes for any number of centres and axes. A point of another length fails the job.
    """
    width = len(centres[0])
    if any(len(centre) != width for centre in centres):
        raise ValueError("centres differ in their number of axes")
    table = F.lit([[float(x) for x in centre] for centre in centres])
    wrong = F.raise_error(F.concat(F.lit(f"a point has not {width} axes: "), F.size(point).cast("string")))
    checked = F.when(F.size(point) == width, point).otherwise(wrong.cast("array<double>"))

    def square(centre: Column) -> Column:
        steps = F.zip_with(checked, centre, lambda x, at: (x - at) * (x - at))
        return F.aggregate(steps, F.lit(0.0), lambda total, step: total + step)

    return F.array_min(F.transform(table, lambda c, i: F.struct(square(c).alias("distance"), i.alias("cluster"))))


def kmeans_assign(points: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Add cluster and squared distance to every point. Centres are constants of the plan."""
    near = points.withColumn("_near", _nearest(F.col("point"), centres))
    return near.select(
        *points.columns, F.col("_near.cluster").alias("cluster"), F.col("_near.distance").alias("distance")
    )


def kmeans_cost(points: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Points and squared distance per cluster; the sum over clusters is the total cost."""
    return kmeans_assign(points, centres).groupBy("cluster").agg(
        F.count("*").alias("points"), F.sum("distance").alias("cost")
    )
