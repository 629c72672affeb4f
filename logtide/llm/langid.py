"""Language identification by a convolutional network over bytes.

A text is lower-cased and cut into windows of WINDOW bytes (the last one filled up with
spaces) that overlap by the widest filter, so every byte of the whole text is seen. Filters
of several widths run over one-hot bytes, each filter's largest response in a window is
kept, and a softmax over these gives the window's languages; a text's are the mean over its
windows. Trained in numpy by Adam on a sample of distinct labelled texts that is bounded per
language (SAMPLE, EACH), so that every labelled language is learned however rare it is.

Over one-hot bytes a filter is a sum of table rows, so a response costs a few look-ups: the
tables of two neighbouring bytes are added up once.

Defined results: null texts and texts without a letter are ``und`` with score 0, as are all
texts if nothing is labelled; of languages with equal scores the first in order wins; equal
texts get equal results; an empty table gives no rows. Only ``doc_id``, ``text`` and, to
learn, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
OVERLAP = max(WIDTHS) - 1
SAMPLE = 4000  # labelled texts that the network is fitted on, about, by the languages' shares
EACH = 400  # of each language at least, about, or all it has
WINDOWS_EACH = 3  # windows taken from each of them, spread over the whole text
EPOCHS = 6
_ROUND = 1 << 18  # bytes run through the network at once


def windows(text: str) -> np.ndarray:
    """All windows of a text, one per row. An empty text has one, of spaces."""
    data = text.lower().encode("utf-8", "surrogatepass")
    step = WINDOW - OVERLAP
    n = max(1, -(-(len(data) - OVERLAP) // step))
    filled = np.frombuffer(data.ljust(n * step + OVERLAP, b" "), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(filled, WINDOW)[::step]


class Network:
    """tables[k]: (width, 256, FILTERS); bias per filter; softmax weights and offsets."""

    def __init__(self, tables: list[np.ndarray], bias: np.ndarray, weights: np.ndarray, offsets: np.ndarray, languages: list[str]):
        self.tables, self.bias, self.weights, self.offsets, self.languages = tables, bias, weights, offsets, languages
        self._pairs: np.ndarray | None = None

    def responses(self, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Places and values of every filter's largest response in each window: (n, filters) each."""
        n = len(x)
        places, tops = [], []
        for table in self.tables:
            width = len(table)
            at = WINDOW - width + 1
            r = table[0][x[:, :at]]
            for j in range(1, width):
                r = r + table[j][x[:, j : j + at]]
            place = r.argmax(axis=1)
            places.append(place)
            tops.append(np.take_along_axis(r, place[:, None, :], 1)[:, 0, :])
        return places, np.concatenate(tops, axis=1).reshape(n, -1)

    def _pooled(self, x: np.ndarray) -> np.ndarray:
        """Largest responses only, by tables of byte pairs."""
        if self._pairs is None:
            halves = [t[j][:, None, :] + (t[j + 1][None, :, :] if j + 1 < len(t) else 0) for t in self.tables for j in range(0, len(t) - 1, 2)]
            self._pairs = np.concatenate([h.reshape(1 << 16, -1) for h in halves], axis=1).astype(np.float32)
        pairs = self._pairs[x[:, :-1].astype(np.int32) * 256 + x[:, 1:]]
        out, column = [], 0
        for table in self.tables:
            width, at = len(table), WINDOW - len(table) + 1
            r = None
            for j in range(0, width, 2):
                if j + 1 < width:
                    part = pairs[:, j : j + at, column : column + FILTERS]
                    column += FILTERS
                else:
                    part = table[j].astype(np.float32)[x[:, j : j + at]]
                r = part if r is None else r + part
            out.append(r.max(axis=1))
        return np.concatenate(out, axis=1)

    def head(self, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(tops + self.bias, 0)
        z = hidden @ self.weights + self.offsets
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return hidden, z / z.sum(axis=1, keepdims=True)

    def languages_of(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities over all windows of each text: (texts, languages)."""
        totals, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        held: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                of, p = np.concatenate(owner), self.head(self._pooled(np.concatenate(held)))[1]
                np.add.at(totals, of, p)
                np.add.at(counts, of, 1)
                held.clear()
                owner.clear()
                size = 0

        most = _ROUND // WINDOW
        for i, text in enumerate(texts):
            all_windows = windows(text)
            for at in range(0, len(all_windows), most):
                some = all_windows[at : at + most]
                held.append(some)
                owner.append(np.full(len(some), i))
                size += len(some)
                if size >= most:
                    flush()
        flush()
        return totals / np.maximum(counts, 1)[:, None]


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = EPOCHS, batch: int = 128, rate: float = 0.01) -> Network:
    """Adam on the cross entropy. Only the place of a filter's largest response passes its gradient on."""
    rng = np.random.default_rng(5)
    k = len(WIDTHS) * FILTERS
    net = Network([rng.normal(0, 0.3, (w, 256, FILTERS)) for w in WIDTHS], np.zeros(k), rng.normal(0, 0.3, (k, len(languages))), np.zeros(len(languages)), languages)
    values = [*net.tables, net.bias, net.weights, net.offsets]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            chosen = order[at : at + batch]
            xb, yb = x[chosen], y[chosen]
            n = len(chosen)
            places, tops = net.responses(xb)
            hidden, p = net.head(tops)
            p[np.arange(n), yb] -= 1
            p /= n
            back = (p @ net.weights.T) * (hidden > 0)
            grads = []
            for i, table in enumerate(net.tables):
                g = np.zeros_like(table)
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                for j in range(len(table)):
                    byte = np.take_along_axis(xb, places[i] + j, 1)
                    np.add.at(g[j], (byte, np.arange(FILTERS)[None, :].repeat(n, 0)), part)
                grads.append(g)
            grads += [back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]
            t += 1
            for v, g, m, s in zip(values, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return net


def labelled_windows(docs: DataFrame, learn: Column, sample: int = SAMPLE, each: int = EACH) -> DataFrame:
    """lang and windows (as bytes) of about ``sample`` labelled texts and ``each`` of every language, chosen by a hash of the text."""
    usable = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", "lang")
    # Distinct texts are counted, as copies collapse to one row of each (text, language).
    texts = usable.select("lang", F.xxhash64("text").alias("hash")).distinct()
    counts = {r.lang: r["count"] for r in texts.groupBy("lang").count().collect()}
    total = sum(counts.values())
    parts = [(lang, min(1.0, max(sample / total, each / n))) for lang, n in counts.items()]
    # One row per language, so the broadcast is small.
    limits = docs.sparkSession.createDataFrame(parts, "lang string, part double")
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    picked = usable.join(F.broadcast(limits), "lang").filter(share < F.col("part")).select("text", "lang")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            taken = []
            for text in batch["text"]:
                w = windows(text)
                at = np.unique(np.linspace(0, len(w) - 1, WINDOWS_EACH).round().astype(int))
                taken.append(np.ascontiguousarray(w[at]).tobytes())
            yield pd.DataFrame({"lang": batch["lang"], "windows": taken})

    return picked.mapInPandas(cut, "lang string, windows binary").distinct()


def train(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> Network | None:
    """Fit on the driver from the bounded sample; None if nothing is labelled."""
    rows = labelled_windows(docs, learn, sample).toPandas().sort_values(["lang", "windows"], ignore_index=True)
    if not len(rows):
        return None
    languages = sorted(rows["lang"].unique())
    x = [np.frombuffer(w, np.uint8).reshape(-1, WINDOW) for w in rows["windows"]]
    y = np.repeat(np.searchsorted(languages, rows["lang"]), [len(w) for w in x])
    return fit(np.concatenate(x), y, languages)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (mean probability of the predicted language)."""
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = shared.value
        for batch in batches:
            lang, score = np.full(len(batch), "und", object), np.zeros(len(batch))
            asked = np.flatnonzero(batch["lettered"])
            if net is not None and len(asked):
                p = net.languages_of(list(batch["text"].iloc[asked]))
                lang[asked] = np.array(net.languages, object)[p.argmax(axis=1)]
                score[asked] = np.minimum(p.max(axis=1), 1.0)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": lang, "score": score})

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return docs.select("doc_id", "text", lettered).mapInPandas(run, f"doc_id {kind}, lang_pred string, score double")
