"""Interpolated modified Kneser-Ney language model: counted in Spark, memory-mapped to score.

Words are hashed (64 bits). Map tasks count the grams of their texts and send each shard (a
range of the hash) one sorted block; a shard's blocks are merged in one task and written as
sorted arrays of hashes and counts. The number of shards follows the size of the corpus, so
a shard stays of bounded size. What is known of the shards' files is kept beside them, in at
most 1,024 directory files a table; the driver sees one row of sums per directory. Counts of the
lower orders are continuation counts, derived from the distinct grams of the order above, whose
blocks and shuffle files are removed once they have been read. Scoring tasks map the arrays that
they need and look up each distinct gram of a stretch of texts once.

A text is its words (A-Z lower-cased) and an end token; grams reach back over ORDER - 1
start marks. Words never seen share one place in the vocabulary, so the probabilities of
all words after any context add up to 1.

Defined results: a null text counts as empty and is its end token; rows without an id are
held out; repeated rows count each; without any training text every probability is that
of a vocabulary of one. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder, remove_folder, write_through
from . import store
from .words import combine, mix, word_hashes

ORDER = 2
SHARD_CHARACTERS = 1 << 24  # characters of the corpus per shard, about
COUNT_CHARACTERS = 1 << 23  # characters of texts counted at once
SCORE_CHARACTERS = 1 << 20  # characters of texts looked up at once
DIRECTORIES = 1 << 10  # directory files of a table at most; each tells of as many shards at least
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
END = mix(np.array([0x0E2D], np.uint64))[0]
START_ID, UNKNOWN_ID = 0, (1 << 32) - 1  # vocabulary ids are 1 + place in the sorted hashes

_BLOCK = "kind string, shard int, ids binary, counts binary"


def shards_for(docs: DataFrame) -> int:
    """A power of two that grows with the corpus."""
    size = docs.agg(F.sum(F.char_length("text").cast("long"))).first()[0] or 0
    return 1 << max(3, int(size // SHARD_CHARACTERS).bit_length())


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included, and the number of tokens of each text."""
    hashes, counts = word_hashes(texts, lower=True)
    return np.insert(hashes, np.cumsum(counts), END), counts + 1


def stretches(batches: Iterator[pd.DataFrame], characters: int) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Rows with their tokens, texts of about ``characters`` in all at a time."""
    for batch in batches:
        sizes = batch["text"].str.len().fillna(0).to_numpy(np.int64)
        group = np.cumsum(sizes) // characters
        for g in np.unique(group):
            rows = batch[group == g]
            yield (rows, *tokens_of(list(rows["text"])))


def squeeze(rows: np.ndarray) -> bytes:
    """Numbers as compressed bytes, the bytes of equal weight side by side."""
    planes = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(blocks: Iterable[bytes], dtype: str, columns: int = 1) -> np.ndarray:
    """The rows of all blocks, one after the other."""
    width = np.dtype(dtype).itemsize * columns
    out = []
    for block in blocks:
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(width, -1)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(-1, columns))
    rows = np.concatenate(out) if out else np.empty((0, columns), dtype)
    return rows if columns > 1 else rows[:, 0]


def gram_keys(ids: np.ndarray) -> np.ndarray:
    """Hash of each row of ids."""
    return combine(np.full(len(ids), ids.shape[1], np.uint64), *[ids[:, j].astype(np.uint64) for j in range(ids.shape[1])])


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, the place of one row of each, and the sums of the counts of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], order[first], [np.add.reduceat(c[order], first) if len(first) else c for c in counts]


def smallest(counts: np.ndarray) -> np.ndarray:
    """The same counts in the smallest unsigned type that holds them."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def cut_by_shard(keys: np.ndarray, shards: int) -> list[tuple[int, slice]]:
    """Slices of sorted keys per shard that has any; a shard is a range of the highest bits."""
    shard = keys >> np.uint64(64 - shards.bit_length() + 1)
    first = np.flatnonzero(shard[1:] != shard[:-1]) + 1
    bounds = [0, *first.tolist(), len(keys)] if len(keys) else []
    return [(int(shard[a]), slice(a, b)) for a, b in zip(bounds, bounds[1:])]


def block_rows(kind: str, keys: np.ndarray, payload: np.ndarray, counts: np.ndarray, shards: int) -> list[tuple]:
    """Rows of (kind, shard, ids, counts) for keys in order. Ids are put in order of their own, which packs closer."""
    out = []
    for s, at in cut_by_shard(keys, shards):
        ids, n = payload[at], counts[at].astype("<i8")
        if ids.ndim > 1:
            order = np.lexsort(ids.T[::-1])
            ids, n = ids[order], n[order]
        out.append((kind, s, squeeze(ids), squeeze(n)))
    return out


class Table:
    """Sorted keys with one or more columns of numbers, in one file per shard and column.

    ``sizes`` are the keys per directory. A directory tells the lengths and types of its shards' files; it
    is read, and a file is mapped, when a key of theirs is first asked for.
    """

    def __init__(self, folder: str, name: str, sizes: list[int], shards: int):
        self.folder, self.name, self.shards, self.wide = folder, name, shards, -(-shards // len(sizes))
        self.starts = np.cumsum([0, *sizes])
        self._directories: dict[int, tuple[list[dict], np.ndarray]] = {}
        self._files: dict[tuple[int, int], np.ndarray] = {}

    def __len__(self) -> int:
        return int(self.starts[-1])

    @staticmethod
    def write(folder: str, name: str, shard: int, keys: np.ndarray, *columns: np.ndarray) -> dict:
        store.put(folder, f"{name}-{shard}-keys", keys.astype("<u8").tobytes())
        small = [smallest(c) for c in columns]
        for j, c in enumerate(small):
            store.put(folder, f"{name}-{shard}-{j}", c.tobytes())
        return {"shard": int(shard), "n": len(keys), "kinds": [c.dtype.str for c in small]}

    def _directory(self, number: int) -> tuple[list[dict], np.ndarray]:
        """What is known of a directory's shards, and the place of each one's first key in the whole table."""
        if number not in self._directories:
            empty = self.starts[number + 1] == self.starts[number]
            told = [] if empty else json.loads(store.read(self.folder, f"{self.name}-shards-{number}"))
            by_shard = {p["shard"]: p for p in told}
            first = number * self.wide
            parts = [by_shard.get(s, {"n": 0, "kinds": []}) for s in range(first, min(first + self.wide, self.shards))]
            self._directories[number] = parts, np.cumsum([self.starts[number]] + [p["n"] for p in parts])
        return self._directories[number]

    def _file(self, shard: int, column: int) -> np.ndarray:
        """A shard's column of numbers, or its keys for column -1."""
        if (shard, column) not in self._files:
            number, at = divmod(shard, self.wide)
            part = self._directory(number)[0][at]
            suffix, kind = ("keys", "<u8") if column < 0 else (str(column), part["kinds"][column])
            self._files[shard, column] = store.mapped(self.folder, f"{self.name}-{shard}-{suffix}", kind, part["n"])
        return self._files[shard, column]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each of the sorted keys in the whole table, -1 where it is not."""
        out = np.full(len(keys), -1, np.int64)
        for s, at in cut_by_shard(keys, self.shards):
            parts, starts = self._directory(s // self.wide)
            if parts[s % self.wide]["n"]:
                have = self._file(s, -1)
                place = np.searchsorted(have, keys[at])
                there = have[np.minimum(place, len(have) - 1)] == keys[at]
                out[at] = np.where(there, place + starts[s % self.wide], -1)
        return out

    def values(self, places: np.ndarray, column: int) -> np.ndarray:
        """Numbers at places of the table; 0 where the place is -1."""
        out = np.zeros(len(places), np.float64)
        number = np.searchsorted(self.starts, places, "right") - 1
        for d in np.unique(number[places >= 0]):
            _, starts = self._directory(int(d))
            here = np.flatnonzero((number == d) & (places >= 0))
            within = np.searchsorted(starts, places[here], "right") - 1
            for i in np.unique(within):
                at = here[within == i]
                out[at] = self._file(int(d) * self.wide + int(i), column)[places[at] - starts[i]]
        return out


def directory_width(shards: int) -> int:
    """Shards per directory: as many as there may be directories, and more if those do not do."""
    return max(DIRECTORIES, shards // DIRECTORIES)


def write_directories(parts: DataFrame, folder: str, name: str, shards: int) -> tuple[list[int], dict[str, list[int]]]:
    """Write what ``parts`` (shard, part) tell of a table's files; give back the keys per directory and the sums of all other numbers."""
    wide = directory_width(shards)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        told = [json.loads(p) for p in rows["part"]]
        files = sorted(({k: p[k] for k in ("shard", "n", "kinds")} for p in told), key=lambda p: p["shard"])
        store.put(folder, f"{name}-shards-{key[0]}", json.dumps(files).encode())
        sums = {k: np.sum([p[k] for p in told], axis=0).tolist() for k in told[0] if k not in ("shard", "n", "kinds")}
        return pd.DataFrame({"number": [key[0]], "n": [sum(p["n"] for p in told)], "sums": [json.dumps(sums)]})

    number = F.floor(F.col("shard") / wide).cast("int").alias("number")
    grouped = parts.select(number, "part").groupBy("number")
    rows = grouped.applyInPandas(run, "number int, n long, sums string").collect()  # at most DIRECTORIES short rows
    sizes = [0] * -(-shards // wide)
    sums: dict[str, list[int]] = {}
    for row in rows:
        sizes[row["number"]] = row["n"]
        for k, v in json.loads(row["sums"]).items():
            sums[k] = (np.asarray(v) + np.asarray(sums.get(k, 0))).tolist()
    return sizes, sums


def token_ids(vocabulary: Table, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of tokens, and their places in the vocabulary (-1: unknown)."""
    distinct, inverse = np.unique(hashes, return_inverse=True)
    places = vocabulary.find(distinct)
    return np.where(places < 0, UNKNOWN_ID, places + 1).astype(np.uint32)[inverse], places[inverse]


def grams(ids: np.ndarray, counts: np.ndarray, order: int) -> np.ndarray:
    """One row per token: the ids of the ``order`` - 1 tokens before it in its text (start marks before the first), and its own."""
    within = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
    columns = []
    for back in range(order - 1, -1, -1):
        shifted = np.concatenate((np.zeros(back, np.uint32), ids))[: len(ids)]
        columns.append(np.where(within >= back, shifted, np.uint32(START_ID)))
    return np.column_stack(columns).astype("<u4")


def count_words(docs: DataFrame, folder: str, shards: int) -> tuple[list[int], int]:
    """Write the vocabulary, sorted hashes of all tokens and their counts; give back its sizes and the number of tokens."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, tokens, _ in stretches(batches, COUNT_CHARACTERS):
            keys, times = np.unique(tokens, return_counts=True)
            yield pd.DataFrame(block_rows("word", keys, keys, times, shards), columns=["kind", "shard", "ids", "counts"])

    def merge(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        keys, _, (times,) = summed(unsqueeze(blocks["ids"], "<u8"), unsqueeze(blocks["counts"], "<i8"))
        part = Table.write(folder, "words", key[0], keys, times)
        return pd.DataFrame({"shard": [key[0]], "part": [json.dumps(part | {"sum": int(times.sum())})]})

    blocks = docs.select("text").mapInPandas(count, _BLOCK)
    parts = blocks.groupBy("shard").applyInPandas(merge, "shard int, part string")
    sizes, sums = write_directories(parts, folder, "words", shards)
    return sizes, sums.get("sum", 0)


def count_grams(docs: DataFrame, folder: str, order: int, shards: int, words: list[int]) -> DataFrame:
    """Blocks of the distinct grams of the highest order with their counts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Table(folder, "words", words, shards)
        for _, tokens, counts in stretches(batches, COUNT_CHARACTERS):
            rows = grams(token_ids(vocabulary, tokens)[0], counts, order)
            keys, one, (times,) = summed(gram_keys(rows), np.ones(len(rows), np.int64))
            yield pd.DataFrame(block_rows("gram", keys, rows[one], times, shards), columns=["kind", "shard", "ids", "counts"])

    return docs.select("text").mapInPandas(count, _BLOCK)


def merge_level(blocks: DataFrame, folder: str, level: int, shards: int) -> DataFrame:
    """Write the grams of one level; give back blocks for the level below, for the contexts, and the counts of counts."""

    def merge(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        ids = unsqueeze(blocks["ids"], "<u4", level).reshape(-1, level)
        keys, one, (times,) = summed(gram_keys(ids), unsqueeze(blocks["counts"], "<i8"))
        ids = ids[one]
        part = Table.write(folder, f"grams{level}", key[0], keys, times)
        part["of"] = [int((times == j).sum()) for j in range(1, 5)]
        part["sum"] = int(times.sum())
        out = [("part", int(key[0]), json.dumps(part).encode(), b"")]
        if level > 1:
            # A gram that begins with a start mark follows nothing; its own count stands for its continuations.
            suffix = ids[:, 1:]
            weight = np.where(suffix[:, 0] == START_ID, times, 1)
            below, at, (follows,) = summed(gram_keys(suffix), weight)
            out += block_rows("gram", below, np.ascontiguousarray(suffix[at]), follows, shards)
            contexts, at, sums = summed(gram_keys(ids[:, :-1]), times, times == 1, times == 2, times > 2)
            out += block_rows("context", contexts, contexts, np.column_stack(sums).astype("<i8"), shards)
        return pd.DataFrame(out, columns=["kind", "shard", "ids", "counts"])

    return blocks.groupBy("shard").applyInPandas(merge, _BLOCK)


def merge_contexts(blocks: DataFrame, folder: str, level: int, shards: int) -> list[int]:
    """Write per context of a level: the sum of its grams' counts, and its grams of count 1, 2 and more; give back the sizes."""

    def merge(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        keys, _, sums = summed(unsqueeze(blocks["ids"], "<u8"), *unsqueeze(blocks["counts"], "<i8", 4).T)
        part = Table.write(folder, f"contexts{level}", key[0], keys, *sums)
        return pd.DataFrame({"shard": [key[0]], "part": [json.dumps(part)]})

    parts = blocks.groupBy("shard").applyInPandas(merge, "shard int, part string")
    return write_directories(parts, folder, f"contexts{level}", shards)[0]


def discounts(n: list[int]) -> list[float]:
    """Discounts of counts 1, 2 and more from the numbers of grams of count 1 to 4; within [0, count]."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    raw = [j - (j + 1) * y * n[j] / n[j - 1] if n[j - 1] else j / 2 for j in (1, 2, 3)]
    return [min(max(d, 0.0), float(j)) for j, d in zip((1, 2, 3), raw)]


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """Shuffle files of a job go when it ends, not when the driver next collects its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def train(docs: DataFrame, order: int = ORDER) -> str:
    """Count ``docs`` and write the model to a new folder of the shared folder; return the folder."""
    with shuffle_files_removed(docs.sparkSession):
        return _train(docs, order)


def _train(docs: DataFrame, order: int) -> str:
    spark: SparkSession = docs.sparkSession
    folder = new_folder(spark, "language-model")
    shards = shards_for(docs)
    words, tokens = count_words(docs, folder, shards)
    model = {"order": order, "shards": shards, "words": words, "tokens": tokens, "levels": {}}
    assert sum(words) < UNKNOWN_ID - 1, "the vocabulary is beyond 32-bit ids"
    blocks, above = count_grams(docs, folder, order, shards, words), None
    for level in range(order, 0, -1):
        held = new_folder(spark, f"grams{level}")
        merged = write_through(merge_level(blocks, folder, level, shards), folder=held)
        if above:
            remove_folder(spark, above)
        parts = merged.filter("kind = 'part'").select("shard", F.col("ids").cast("string").alias("part"))
        sizes, sums = write_directories(parts, folder, f"grams{level}", shards)
        contexts = merge_contexts(merged.filter("kind = 'context'"), folder, level, shards) if level > 1 else []
        of, n = sums.get("of", [0] * 4), sum(sizes)
        model["levels"][str(level)] = {
            "sizes": sizes, "contexts": contexts, "discounts": discounts(of), "sum": sums.get("sum", 0),
            "more": [of[0], of[1], n - of[0] - of[1]]}
        blocks, above = merged.filter("kind = 'gram'"), held
    remove_folder(spark, above)
    store.put(folder, "model.json", json.dumps(model).encode())
    return folder


class Scorer:
    """The model of a folder, with its arrays mapped."""

    def __init__(self, folder: str):
        m = json.loads(store.read(folder, "model.json"))
        self.order, self.tokens = m["order"], m["tokens"]
        self.words = Table(folder, "words", m["words"], m["shards"])
        self.size = len(self.words)
        self.levels = {int(k): v for k, v in m["levels"].items()}
        self.grams = {k: Table(folder, f"grams{k}", v["sizes"], m["shards"]) for k, v in self.levels.items()}
        self.contexts = {k: Table(folder, f"contexts{k}", v["contexts"], m["shards"]) for k, v in self.levels.items() if k > 1}

    def _discounted(self, level: int, count: np.ndarray) -> np.ndarray:
        d = np.array([0.0, *self.levels[level]["discounts"]])
        return np.maximum(count - d[np.minimum(count, 3).astype(int)], 0)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """P(last id | the ids before it) for rows of ids, each distinct row looked up once."""
        level = rows.shape[1]
        keys, one, _ = summed(gram_keys(rows))
        distinct = rows[one]
        count = self.grams[level].values(self.grams[level].find(keys), 0)
        about = self.levels[level]
        d = about["discounts"]
        if level == 1:
            total = about["sum"]
            spread = sum(a * b for a, b in zip(d, about["more"])) / total if total else 1.0
            p = self._discounted(1, count) / max(total, 1) + spread / (self.size + 1)
        else:
            lower = self.probabilities(distinct[:, 1:])
            context, context_one, _ = summed(gram_keys(distinct[:, :-1]))
            where = self.contexts[level].find(context)
            total, *more = (self.contexts[level].values(where, j) for j in range(4))
            seen = total > 0
            share = np.where(seen, sum(a * b for a, b in zip(d, more)) / np.where(seen, total, 1), 1.0)
            back = np.searchsorted(context, gram_keys(distinct[:, :-1]))
            total, share = total[back], share[back]
            p = np.where(total > 0, self._discounted(level, count) / np.where(total > 0, total, 1), 0.0) + share * lower
        return p[np.searchsorted(keys, gram_keys(rows))]

    def score(self, tokens: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Sums over each text's tokens."""
        ids, places = token_ids(self.words, tokens)
        distinct, inverse = np.unique(places, return_inverse=True)
        c = self.words.values(distinct, 0)[inverse]
        base = np.log10((c + 0.1) / (self.tokens + 0.1 * (self.size + 1)))
        p = np.log10(self.probabilities(grams(ids, counts, self.order)))
        starts = np.cumsum(counts) - counts
        return {"n_tokens": counts, "n_known": np.add.reduceat(c > 0, starts, dtype=np.int64),
                "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(p, starts)}


_scorers: dict[str, Scorer] = {}


def scorer(folder: str) -> Scorer:
    """The worker's scorer of a folder; one model is held at a time."""
    if folder not in _scorers:
        _scorers.clear()
        _scorers[folder] = Scorer(folder)
    return _scorers[folder]


def score(docs: DataFrame, folder: str, held_out: Column) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    kind = dict(docs.dtypes)["doc_id"]
    columns = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = scorer(folder)
        for rows, tokens, counts in stretches(batches, SCORE_CHARACTERS):
            out = pd.DataFrame({"doc_id": rows["doc_id"], "held_out": rows["held_out"]}).reset_index(drop=True)
            found = model.score(tokens, counts)
            for name in ("n_tokens", "n_known"):
                out[name] = found[name]
            out["train_tokens"] = model.tokens
            out["base_score"], out["score"] = found["base_score"], found["score"]
            out["perplexity"] = 10.0 ** (-found["score"] / found["n_tokens"])
            yield out

    return docs.select("doc_id", "text", held_out.alias("held_out")).mapInPandas(run, columns)
