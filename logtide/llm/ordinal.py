"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > j) = sigmoid(w . x - t_j) with one weight vector w over hashed text features and
ordered thresholds t_0 < t_1 < ... The features of a text are its words, their first
bytes, its word shapes (runs of upper case, lower case, digits; other characters as they are)
and its share of distinct words, as log counts of unit length. The model is fitted on a sample of rated
documents that is bounded per grade (SAMPLE, EACH), so that a rare grade keeps its words, and
applied to every whole text.

Defined results: a document's rating is the lowest of its ratings, ratings with a null are
left out; a null text, or one without words, has expected grade 0, tail probability 0 and is
not selected; without any rating every text with words gets the highest grade; equal texts
get equal results; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import mix, word_hashes

BITS = 18
SAMPLE = 8_000  # rated documents that the model is fitted on, about, by the grades' shares
EACH = 1_000  # of each grade at least, about, or all it has
EPOCHS = 20
SELDOM = 8
PREFIX = 4  # first bytes of a word that are a feature of their own
CHUNK = 1 << 20  # characters of texts whose features are held at once
KEEP_AT = 0.5  # tail probability from which a document is selected

_SHAPE = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b for b in range(256))
_SHAPE_TABLE = np.frombuffer(_SHAPE, np.uint8)


def shaped(text: str) -> str:
    """The text with each run of upper-case, lower-case or digit characters as one ``A``, ``a`` or ``0``."""
    codes = _SHAPE_TABLE[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    if not len(codes):
        return ""
    keep = np.concatenate(([True], (codes[1:] != codes[:-1]) | ~np.isin(codes[1:], (65, 97, 48))))
    return codes[keep].tobytes().decode("latin-1")


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, count) of all texts, sorted by row."""
    n = len(texts)
    words, counts = word_hashes(texts, lower=True)
    starts, _ = word_hashes(texts, lower=True, prefix=PREFIX)
    shapes, _ = word_hashes([shaped(t or "") for t in texts])
    row = np.repeat(np.arange(n), counts)
    # The share of distinct words, in tenths, alone and by length, tells repeated lines.
    order = np.lexsort((words, row))
    first = np.ones(len(words), bool)
    first[1:] = (words[order][1:] != words[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = np.bincount(row[order][first], minlength=n)
    some = np.flatnonzero(counts > 0)
    tenths = np.floor(10 * distinct / np.maximum(counts, 1)).astype(np.uint64)[some]
    size = np.floor(2 * np.log2(np.maximum(counts, 1))).astype(np.uint64)[some]
    parts = [words, mix(starts + np.uint64(2)), mix(shapes + np.uint64(1)), mix(np.uint64(7) + tenths), mix(np.uint64(1007) + tenths + np.uint64(64) * size)]
    key = np.concatenate(parts) & np.uint64((1 << BITS) - 1)
    at = np.concatenate([row, row, row, some, some]).astype(np.uint64)
    pairs, times = np.unique((at << np.uint64(BITS)) | key, return_counts=True)
    return (pairs >> np.uint64(BITS)).astype(np.int64), (pairs & np.uint64((1 << BITS) - 1)).astype(np.int64), times


def chunks(texts: list[str | None]) -> Iterator[slice]:
    """Slices of about CHUNK characters each, that together are all texts."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > CHUNK:
            yield slice(start, i)
            start, size = i, 0
        size += len(text or "")
    yield slice(start, len(texts))


def unit_values(row: np.ndarray, times: np.ndarray, n: int) -> np.ndarray:
    """Log counts, each row of unit length."""
    value = np.log1p(times)
    return value / np.sqrt(np.bincount(row, value * value, minlength=n))[row]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Weights (NaN for features left out) and ordered thresholds; grades are 0..len(thresholds)."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > j) per text and threshold j; 0 for texts without words."""
        return np.concatenate([self._tails(texts[at]) for at in chunks(texts)])

    def _tails(self, texts: list[str | None]) -> np.ndarray:
        row, feature, times = features(texts)
        words = np.bincount(row, minlength=len(texts))
        weight = self.weights[feature].astype(np.float64)
        known = ~np.isnan(weight)
        row, times, weight = row[known], times[known], weight[known]
        score = np.bincount(row, weight * unit_values(row, times, len(texts)), minlength=len(texts))
        tails = _sigmoid(score[:, None] - self.thresholds[None, :])
        tails[words == 0] = 0
        return tails


def fit(row: np.ndarray, feature: np.ndarray, times: np.ndarray, grade: np.ndarray, grades: int,
        epochs: int = EPOCHS, rate: float = 2.0, decay: float = 1e-6, batch: int = 64, seldom: int = SELDOM) -> Model:
    """Adaptive gradient steps on the cumulative-link likelihood. Rows are numbered from 0 and sorted.

    Features of fewer than ``seldom`` rows are left out, as they would only name their rows.
    """
    n = len(grade)
    often = np.bincount(feature, minlength=1 << BITS) >= seldom
    row, feature, times = (x[often[feature]] for x in (row, feature, times))
    value = unit_values(row, times, n).astype(np.float32)
    starts = np.searchsorted(row, np.arange(n + 1))
    weights, w_sum = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8)
    # Thresholds are the first plus gaps exp(g), so they stay in order.
    above = [np.clip((grade > j).mean(), 1e-3, 1 - 1e-3) for j in range(grades - 1)]
    start = -np.log(np.array(above) / (1 - np.array(above)))
    base, gaps = start[0], np.log(np.maximum(np.diff(start), 0.1))
    rng = np.random.default_rng(11)
    for epoch in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            chosen = order[at : at + batch]
            spans = [np.arange(starts[i], starts[i + 1]) for i in chosen]
            local = np.repeat(np.arange(len(chosen)), [len(s) for s in spans])
            span = np.concatenate(spans)
            f, v, y = feature[span], value[span], grade[chosen]
            limits = base + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
            score = np.bincount(local, weights[f] * v, minlength=len(chosen))
            tail = np.column_stack([np.ones(len(y)), _sigmoid(score[:, None] - limits[None, :]), np.zeros(len(y))])
            i = np.arange(len(y))
            upper, lower = tail[i, y], tail[i, y + 1]
            p = np.maximum(upper - lower, 1e-9)
            up, low = upper * (1 - upper), lower * (1 - lower)
            slope = (up - low) / p  # of the log likelihood by the score
            used, place = np.unique(f, return_inverse=True)
            g = np.bincount(place, slope[local] * v) / len(y) - decay * weights[used]
            w_sum[used] += g * g
            weights[used] += rate * g / np.sqrt(w_sum[used])
            by_limit = np.zeros(grades + 1)
            np.add.at(by_limit, y, -up / p)
            np.add.at(by_limit, y + 1, low / p)
            by_limit = by_limit[1:grades] / len(y)
            step = 0.5 / (1 + epoch)
            base += step * by_limit.sum()
            if len(gaps):
                gaps += step * np.exp(gaps) * np.cumsum(by_limit[::-1])[::-1][1:]
    weights[~often] = np.nan
    return Model(weights, base + np.concatenate(([0.0], np.cumsum(np.exp(gaps)))))


def rated_sample(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE, each: int = EACH) -> DataFrame:
    """doc_id, grade and features of about ``sample`` rated documents and ``each`` of every grade, one row per id, chosen by a hash of the id."""
    one = ratings.filter(F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).groupBy("doc_id").agg(F.min("grade").alias("grade"))
    counts = {r.grade: r["count"] for r in one.groupBy("grade").count().collect()}
    total = sum(counts.values())
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    wanted = F.lit(False)
    for grade, n in sorted(counts.items()):
        wanted = wanted | ((F.col("grade") == grade) & (share < min(1.0, max(sample / total, each / n))))
    picked = one.filter(wanted)
    # At most about ``sample`` ids and grades, and ``each`` of every grade, so the broadcast is bounded.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = (batch.iloc[at] for batch in batches for at in chunks(list(batch["text"])))
        for part in parts:
            row, feature, times = features(list(part["text"]))
            ends = np.searchsorted(row, np.arange(len(part) + 1))
            yield pd.DataFrame({
                "doc_id": part["doc_id"], "grade": part["grade"],
                "feature": [feature[a:b].astype("<i4").tobytes() for a, b in zip(ends, ends[1:])],
                "times": [times[a:b].astype("<i4").tobytes() for a, b in zip(ends, ends[1:])]})

    kind = dict(docs.dtypes)["doc_id"]
    # Of several texts of one id the smallest, so that reruns fit the same model.
    texts = rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    return texts.mapInPandas(extract, f"doc_id {kind}, grade int, feature binary, times binary")


def fitted(rows: pd.DataFrame, grades: int) -> Model:
    """The model of a sample as ``rated_sample`` makes it."""
    rows = rows.sort_values("doc_id", ignore_index=True)
    found = [np.frombuffer(f, "<i4") for f in rows["feature"]]
    times = [np.frombuffer(t, "<i4") for t in rows["times"]]
    # Features that few rows have are left out before the rows are joined to one array: they are most.
    held = np.zeros(1 << BITS, np.int32)
    for f in found:
        held[f] += 1
    often = [held[f] >= SELDOM for f in found]
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [int(o.sum()) for o in often])
    feature = np.concatenate([f[o] for f, o in zip(found, often)])
    times = np.concatenate([t[o] for t, o in zip(times, often)])
    return fit(row, feature, times, rows["grade"].to_numpy(np.int64), grades)


def train(docs: DataFrame, ratings: DataFrame, grades: int, sample: int = SAMPLE) -> Model:
    """Fit in one task on the bounded sample; only weights and thresholds come back.

    A grade nobody gave only leaves its threshold at the end of the scale.
    """

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        model = fitted(rows, grades)
        return pd.DataFrame({"weights": [model.weights.astype("<f4").tobytes()], "thresholds": [model.thresholds.astype("<f8").tobytes()]})

    rows = rated_sample(docs, ratings, sample).withColumn("_all", F.lit(0))
    found = rows.groupBy("_all").applyInPandas(lambda rows: learn(rows.drop(columns="_all")), "weights binary, thresholds binary").first()
    if found is None:
        return Model(np.zeros(1 << BITS), np.full(grades - 1, -40.0))
    return Model(np.frombuffer(found.weights, "<f4"), np.frombuffer(found.thresholds, "<f8"))


def graded(model: Model, text: Column, keep_at: float = KEEP_AT) -> Column:
    """Of a text: expected_grade, tail (P of the highest grade) and selected, as one struct."""
    shared = (model.weights.astype(np.float32), model.thresholds)

    @F.pandas_udf("expected_grade double, tail double, selected boolean")
    def grade(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        local = Model(*shared)
        for some in texts:
            tails = local.tails(list(some))
            yield pd.DataFrame({"expected_grade": tails.sum(axis=1), "tail": tails[:, -1], "selected": tails[:, -1] >= keep_at})

    return grade(text)


def select_documents(docs: DataFrame, model: Model, keep_at: float = KEEP_AT) -> DataFrame:
    """The documents whose highest grade is likely enough, with the columns they came with."""
    return docs.filter(graded(model, F.col("text"), keep_at).getField("selected"))


def quality_ratings(labels: DataFrame) -> DataFrame:
    """Ratings from labels: 0 toxic, 1 of low quality, 2 good and clean; null where the labels do not say.

    Toxic is the lowest grade: its words can lower a text's score without end, which a grade
    between two others could not take up.
    """
    clean = (F.col("quality") == 1) & (F.col("toxic") == 0)
    grade: Column = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(clean, 2)
    return labels.select("doc_id", grade.cast("int").alias("grade"))
