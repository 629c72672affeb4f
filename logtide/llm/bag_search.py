"""Ranked lexical search over whole documents, scored once per class of equal bags.

Documents are reduced to the terms that some item asks for: their bag. Documents of equal bag and
equal length norm m have equal scores for every item, so they form a class; classes are found by
hash and told apart by the whole bag. Each class is scored once: classes come in shards,
items in blocks, every block meets every shard in one sparse-by-dense product, and only the
best classes per item leave a tile. The best classes of an item, by score and smallest doc_id, hold all
its best documents; only these classes are expanded, by ascending doc_id.

Defined results: a null text has no terms; documents without terms count nowhere; documents
without any term of the items count in N and L only; every row of documents and of items is one of its
own, so repeated ids give repeated rows; a missing doc_id sorts last; an item without terms, or that no
document matches, gives no rows; empty tables give no rows. Ids are
whole numbers. Only ``doc_id``, ``item_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import write_through
from .common import lowered, text_or_empty

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 20
VOCABULARY_TERMS = 1 << 17  # up to so many terms of items, of so many bytes, every worker holds them all
VOCABULARY_BYTES = 4 << 20
ITEMS = 256  # items of a block
ITEM_TERMS = 1 << 15  # terms of a block, summed over its items, unless one item has more
SHARD = 2048  # classes of a shard
SHARD_ENTRIES = 1 << 18  # terms of a shard, summed over its classes
CELL = 4  # shards that share one copy of the item blocks
FAN_IN = 32  # short lists merged by one window
DENSE = 1 << 22  # numbers of a dense matrix
PIECE = 4 << 20  # bytes of a text that are split at once

#: ASCII letters and digits and all bytes of longer characters stay, A-Z in lower case; all else separates terms.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def term_lists(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_BYTES)
    at = 0
    while len(data) - at > PIECE:
        cut = data.rfind(b" ", at, at + PIECE)
        cut = data.find(b" ", at + PIECE) if cut <= at else cut
        if cut < 0:
            break
        yield data[at:cut].split()
        at = cut
    yield data[at:].split()


def listed_items(items: DataFrame) -> DataFrame:
    """item (a number of its own), item_id and the terms in order."""
    words = F.regexp_extract_all(lowered(text_or_empty()), F.lit(TERM), F.lit(0))
    return write_through(items.select("item_id", words.alias("words")).withColumn("item", F.monotonically_increasing_id()), "items")


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*values, np.empty(0, np.int64)]).astype(np.int64)))


def bags(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """doc_id, n, terms, tfs, hash of every document with terms; ``terms`` are numbers of the vocabulary, in order."""
    size = vocabulary.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("bytes")).first()
    small = size.n <= VOCABULARY_TERMS and size.bytes <= VOCABULARY_BYTES
    found = _bags_by_table(docs, vocabulary) if small else _bags_by_join(docs, vocabulary)
    return write_through(found.withColumn("hash", F.xxhash64("terms", "tfs")), "bags")


def _bags_by_table(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast({r.term.encode(): r.number for r in vocabulary.collect()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            rows, n, terms, tfs = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                held: Counter = Counter()
                for words in term_lists(text.as_py()):
                    held.update(map(number, words))
                total = sum(held.values())
                if not total:
                    continue
                held.pop(None, None)
                order = sorted(held)
                rows.append(i)
                n.append(total)
                terms.append(np.array(order, np.int64))
                tfs.append(np.array([held[t] for t in order], np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), _lists(terms), _lists(tfs)], ["doc_id", "n", "terms", "tfs"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n long, terms array<long>, tfs array<long>")


def _bags_by_join(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """For vocabularies of any size: each document's distinct terms meet the vocabulary in a join."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = []
            for text in batch["text"]:
                c: Counter = Counter()
                for words in term_lists(text):
                    c.update(words)
                held.append(c)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n": [sum(c.values()) for c in held],
                "words": [[w.decode("utf-8", "surrogatepass") for w in c] for c in held], "times": [list(c.values()) for c in held]})

    kind = dict(docs.dtypes)["doc_id"]
    counted = docs.select("doc_id", "text").mapInPandas(count, f"doc_id {kind}, n long, words array<string>, times array<long>").filter("n > 0")
    counted = write_through(counted.withColumn("row", F.monotonically_increasing_id()), "counted")
    pairs = counted.select("row", F.inline(F.arrays_zip("words", "times"))).join(vocabulary, F.col("words") == F.col("term"))
    held = pairs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("number", "times"))).alias("bag"))
    bag = F.coalesce("bag", F.expr("cast(array() as array<struct<number:bigint,times:bigint>>)"))
    return counted.select("row", "doc_id", "n").join(held, "row", "left").withColumn("bag", bag).select(
        "doc_id", "n", F.col("bag.number").alias("terms"), F.col("bag.times").alias("tfs"))


def with_norm(held: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Bags with m = 100 - 25 + (25 * n * N) div L, the product in decimals so that it has room."""
    product = f"cast(n as decimal(19,0)) * cast({25 * n_docs} as decimal(19,0))"
    return held.withColumn("m", F.expr(f"cast(75 + ({product}) div {n_terms} as bigint)"))


def bag_classes(held: DataFrame) -> DataFrame:
    """class, hash, m, terms, tfs, members, first_id: documents of equal bag and m. Keys are met by hash, then compared in whole."""
    found = held.filter(F.size("terms") > 0).groupBy("hash", "m", "terms", "tfs").agg(
        F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("first_id"))
    return write_through(found.withColumn("class", F.monotonically_increasing_id()), "classes")


def term_weights(classes: DataFrame, n_docs: int) -> DataFrame:
    """number, weight = floor(1000 * ln((2 * N + 2) / (2 * df + 1))); df counts all members of a class at once."""
    df = classes.select(F.explode("terms").alias("number"), "members").groupBy("number").agg(F.sum("members").alias("df"))
    return df.select("number", F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).alias("weight"))


def item_blocks(listed: DataFrame, vocabulary: DataFrame, weights: DataFrame) -> DataFrame:
    """Blocks of items, each with its terms and term weights (times repeats) as flat arrays."""
    terms = listed.select("item", "item_id", F.explode("words").alias("term")).groupBy("item", "item_id", "term").agg(F.count(F.lit(1)).alias("times"))
    weighed = terms.join(vocabulary, "term").join(weights, "number").filter("weight > 0")
    rows = weighed.groupBy("item").agg(F.collect_list("number").alias("terms"), F.collect_list(F.col("weight") * F.col("times")).alias("weights"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, terms, weights, size = [], [], [], 0

        def flush() -> pd.DataFrame:
            return pd.DataFrame({
                "items": [np.array(items, "<i8").tobytes()], "item_of": [np.repeat(np.arange(len(items)), [len(t) for t in terms]).astype("<i8").tobytes()],
                "item_terms": [np.concatenate(terms).astype("<i8").tobytes()], "item_weights": [np.concatenate(weights).astype("<i8").tobytes()]})

        for batch in batches:
            for item, t, w in zip(batch["item"], batch["terms"], batch["weights"]):
                if items and (len(items) == ITEMS or size + len(t) > ITEM_TERMS):
                    yield flush()
                    items, terms, weights, size = [], [], [], 0
                items.append(item)
                terms.append(np.asarray(t, np.int64))
                weights.append(np.asarray(w, np.int64))
                size += len(t)
        if items:
            yield flush()

    found = rows.mapInPandas(build, "items binary, item_of binary, item_terms binary, item_weights binary")
    return write_through(found.withColumn("block", F.monotonically_increasing_id()), "item_blocks")


def class_shards(classes: DataFrame) -> DataFrame:
    """Shards of classes as flat arrays, within a shard by smallest doc_id (a missing one last), so that ties go to the first."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush() -> pd.DataFrame:
            rows = sorted(held, key=lambda r: r[:3])
            flat = lambda values: np.array(values, "<i8").tobytes()
            return pd.DataFrame({
                "nones": [flat([r[0] for r in rows])], "firsts": [flat([r[1] for r in rows])], "classes": [flat([r[2] for r in rows])], "norms": [flat([r[3] for r in rows])],
                "class_of": [flat(np.repeat(np.arange(len(rows)), [len(r[4]) for r in rows]))],
                "terms": [flat(np.concatenate([r[4] for r in rows]))], "tfs": [flat(np.concatenate([r[5] for r in rows]))]})

        for batch in batches:
            for row in zip(batch["none"], batch["first"], batch["class"], batch["m"], batch["terms"], batch["tfs"]):
                if held and (len(held) == SHARD or size + len(row[4]) > SHARD_ENTRIES):
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield flush()

    rows = classes.select(
        F.col("first_id").isNull().cast("int").alias("none"), F.coalesce(F.col("first_id").cast("long"), F.lit(0).cast("long")).alias("first"), "class", "m", "terms", "tfs")
    found = rows.mapInPandas(build, "nones binary, firsts binary, classes binary, norms binary, class_of binary, terms binary, tfs binary")
    return write_through(found.withColumn("shard", F.monotonically_increasing_id()), "shards")


def tile_scores(block, shard) -> Iterator[tuple[int, np.ndarray]]:
    """(first class, scores of some classes by items) of one tile. In doubles where no sum can pass 2^53, else in longs."""
    read = lambda data: np.frombuffer(data, "<i8")
    n_items, n_classes, norms = len(read(block.items)), len(read(shard.classes)), read(shard.norms)
    terms, place = np.unique(read(block.item_terms), return_inverse=True)
    weights = np.zeros((len(terms), n_items), np.int64)
    weights[place, read(block.item_of)] = read(block.item_weights)
    entry, row, tf = read(shard.terms), read(shard.class_of), read(shard.tfs)
    column = np.minimum(np.searchsorted(terms, entry), len(terms) - 1)
    known = terms[column] == entry
    column, row, tf = column[known], row[known], tf[known]
    impact = 1_000_000_000 * tf // (1000 * tf + 12 * norms[row])
    if 1e6 * float(weights.sum(axis=0).max()) < 2.0**53:
        weights, impact = weights.astype(np.float64), impact.astype(np.float64)
    step = max(1, DENSE // max(len(terms), n_items))
    for first in range(0, n_classes, step):
        low, high = np.searchsorted(row, (first, first + step))
        dense = np.zeros((min(step, n_classes - first), len(terms)), weights.dtype)
        dense[row[low:high] - first, column[low:high]] = impact[low:high]
        yield first, (dense @ weights).astype(np.int64)


def best_rows(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best rows above 0 of every column; ties go to the row further up."""
    last = len(scores) - k
    least = np.partition(scores, last, axis=0)[last] if last > 0 else np.zeros(scores.shape[1], scores.dtype)
    row, column = np.nonzero((scores >= np.maximum(least, 1)[None, :]))
    order = np.lexsort((row, -scores[row, column], column))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(column, column)
    return row[rank < k], column[rank < k]


def best_classes(classes: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """item, class, score: the k best classes of every item, by score, then smallest doc_id."""
    shards = class_shards(classes)
    n_cells = -(-shards.count() // CELL)
    if not n_cells:
        return classes.sparkSession.createDataFrame([], "item long, class long, score long")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_cells - 1).cast("long"))).alias("cell")
    tiles = blocks.select("*", each).join(shards.withColumn("cell", F.pmod(F.xxhash64("shard"), F.lit(n_cells))).hint("merge"), "cell")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch.itertuples(index=False):
                items, names, firsts, nones = (np.frombuffer(x, "<i8") for x in (t.items, t.classes, t.firsts, t.nones))
                held = []
                for first, scores in tile_scores(t, t):
                    row, column = best_rows(scores, k)
                    held.append((row + first, column, scores[row, column]))
                row, column, found = (np.concatenate(x) for x in zip(*held))
                yield pd.DataFrame({
                    "item": items[column], "class": names[row], "score": found, "none": nones[row], "first": firsts[row], "cell": np.full(len(row), t.cell)})

    lists = tiles.mapInPandas(score, "item long, class long, score long, none int, first long, cell long")
    n = n_cells
    while True:
        n = -(-n // FAN_IN)
        lists = lists.withColumn("cell", F.expr(f"cell div {FAN_IN}"))
        best = W.partitionBy("item", "cell").orderBy(F.desc("score"), "none", "first", "class")
        lists = lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank")
        if n == 1:
            return lists.select("item", "class", "score")


def members_of(held: DataFrame, classes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """class, doc_id: of every wanted class the k members of smallest doc_id.

    Members are found by hash and m alone; only if two classes share these does the whole bag decide.
    """
    key: list[str] = ["hash", "m"]
    if classes.groupBy(*key).count().filter("count > 1").limit(1).count():
        key += ["terms", "tfs"]
    chosen = wanted.join(classes.select("class", *key), "class")
    found = held.filter(F.size("terms") > 0).select("doc_id", *key).join(chosen, key)
    order: list[Column] = [F.col("doc_id").asc_nulls_last()]
    return found.withColumn("nth", F.row_number().over(W.partitionBy("class").orderBy(*order))).filter(F.col("nth") <= k).select("class", "doc_id")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item, equal scores by ascending doc_id."""
    listed = listed_items(items)
    terms = listed.select(F.explode("words").alias("term")).distinct()
    vocabulary = write_through(terms.withColumn("number", F.monotonically_increasing_id()), "vocabulary")
    held = bags(docs, vocabulary)
    total = held.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(1)).alias("terms")).first()
    held = with_norm(held, total.n, total.terms)
    classes = bag_classes(held)
    blocks = item_blocks(listed, vocabulary, term_weights(classes, total.n))
    best = write_through(best_classes(classes, blocks, k), "best")
    members = members_of(held, classes, best.select("class").distinct(), k)
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.join(members, "class").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(listed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
