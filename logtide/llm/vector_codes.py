"""Vector compression: integer product codes, assigned by a trie over distinct parts.

Components become whole numbers, vectors are cut into PARTS equal parts, and each part position has a
codebook. Equal parts are counted once over the whole table and kept in lexicographic
order, so every task holds a stretch of the trie of its parts. The trie is walked depth
first: the squared distances from a prefix to the prefixes of all entries are summed once and
shared by all parts below it; at a leaf the nearest entry is taken and the part is added
to that entry's sum as often as it occurs. The driver holds the codebooks, which are of
fixed size, and the sums that make the next ones.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped;
shorter vectors are filled up with zeros, and the part length is rounded up; rows without an id come last in order;
rows of equal id are taken in the order of their components; components beyond a long stay at its
ends, as do errors; with fewer than ENTRIES rows there are as many entries as rows; a table without
usable rows gives no rows. Only ``vec_id``, ``label`` and the vector are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_through

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096.0
SUBTREE = 4096  # parts of a subtree whose nodes of one depth are taken at once

_SAFE = 1 << 62
_LONGEST = (1 << 63) - 1

Book = np.ndarray  # (entries, part length)


def whole_vectors(vectors: DataFrame, vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """vec_id, label and the components as whole numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return vectors.filter(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))).select("vec_id", "label", whole.alias("v"))


def numbers(parts: np.ndarray, book: Book) -> tuple[np.ndarray, Book]:
    """Both as longs where no distance can pass their range, else as numbers of any size."""
    largest = max((int(abs(int(x))) for a in (parts, book) if a.size for x in (a.min(), a.max())), default=0)
    kind = np.int64 if (2 * largest) ** 2 * max(book.shape[1], 1) < _SAFE else object
    return parts.astype(kind), book.astype(kind)


def nearest(parts: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and its squared distance for parts in lexicographic order, by a walk over their trie.

    Any order gives the same result; equal prefixes that are not neighbours are only walked again.
    """
    parts, book = numbers(parts, book)
    n, depth_end = parts.shape
    entry, distance = np.zeros(n, np.int64), np.zeros(n, parts.dtype)
    stack = [(0, n, 0, np.zeros(len(book), parts.dtype))] if n else []
    while stack:
        low, high, depth, sums = stack.pop()
        while depth < depth_end and high - low > SUBTREE:
            column = parts[low:high, depth]
            starts = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1])))
            if len(starts) > 1:
                # The first child is walked first.
                for a, b in reversed(list(zip(starts, [*starts[1:], high - low]))):
                    stack.append((low + a, low + b, depth + 1, sums + (column[a] - book[:, depth]) ** 2))
                break
            sums = sums + (column[0] - book[:, depth]) ** 2
            depth += 1
        else:
            found, at = subtree(parts[low:high, depth:], book[:, depth:], sums)
            best = found.argmin(axis=1)
            entry[low:high], distance[low:high] = best[at], found[np.arange(len(found)), best][at]
    return entry, distance


def subtree(parts: np.ndarray, book: Book, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaves' distances to all entries below a node with ``sums``, and each part's leaf; nodes of one depth are taken at once."""
    edge = np.zeros(len(parts), bool)
    edge[0] = True
    node, found = np.zeros(len(parts), np.int64), sums[None, :]
    for depth in range(parts.shape[1]):
        edge[1:] |= parts[1:, depth] != parts[:-1, depth]
        first = np.flatnonzero(edge)
        found = found[node[first]] + (parts[first, depth][:, None] - book[None, :, depth]) ** 2
        node = np.cumsum(edge) - 1
    return found, node


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, and each row's place among them."""
    order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))
    ordered = parts[order]
    edge = np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(axis=1))) if len(parts) else np.zeros(0, bool)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(edge) - 1
    return ordered[edge], place


def weighed_parts(rows: DataFrame, dim: int) -> DataFrame:
    """pos, part, n: every distinct part with the number of rows that hold it, in lexicographic order."""
    width = -(-dim // PARTS)
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width * PARTS) - F.size("v")))
    cut = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.struct(p.alias("pos"), F.slice(filled, p * width + 1, width).alias("part")))
    return rows.select(F.inline(cut)).groupBy("pos", "part").agg(F.count(F.lit(1)).alias("n")).orderBy("pos", "part")


def entry_sums(parts: DataFrame, books: list[Book]) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(position, entry) -> number and componentwise sum of all parts that are nearest to it."""
    width = books[0].shape[1]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros((len(b), width + 1), object) for b in books]  # the last column counts
        for batch in batches:
            pos, n = batch["pos"].to_numpy(), batch["n"].to_numpy(np.int64)
            for p in np.unique(pos):
                at = np.flatnonzero(pos == p)
                held = np.stack(list(batch["part"].iloc[at])).reshape(len(at), width).astype(np.int64)
                entry, _ = nearest(held, books[p])
                weights = n[at].astype(object)
                largest = max((int(abs(int(x))) for x in (held.min(), held.max())), default=0) if held.size else 0
                if (largest + 1) * int(n[at].sum()) < _SAFE:
                    weights = n[at]
                else:
                    held = held.astype(object)
                for e in np.unique(entry):
                    mine = entry == e
                    sums[p][e, :width] += (held[mine] * weights[mine][:, None]).sum(axis=0)
                    sums[p][e, width] += int(weights[mine].sum())
        rows = [(p, e, j, str(int(x))) for p, s in enumerate(sums) for e, row in enumerate(s) if row[width] for j, x in enumerate(row)]
        yield pd.DataFrame(rows, columns=["pos", "entry", "j", "total"])

    partial = parts.mapInPandas(walk, "pos int, entry int, j int, total string")
    found: dict[tuple[int, int], list[int]] = {}
    # One number for each component of the codebooks.
    for r in partial.groupBy("pos", "entry", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        found.setdefault((r.pos, r.entry), [0] * (width + 1))[r.j] = int(r.total)
    return {key: (row[width], row[:width]) for key, row in found.items()}


def next_books(books: list[Book], sums: dict[tuple[int, int], tuple[int, list[int]]]) -> list[Book]:
    """Every entry as the mean of its parts, rounded down; entries without parts stay."""
    return [
        np.array([[x // sums[p, e][0] for x in sums[p, e][1]] if (p, e) in sums else list(row) for e, row in enumerate(book)], np.int64).reshape(book.shape)
        for p, book in enumerate(books)]


def fit(rows: DataFrame, dim: int, rounds: int = ROUNDS) -> list[Book]:
    """The codebooks of all part positions, from the rows of the smallest ids on."""
    width = -(-dim // PARTS)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    start = np.zeros((len(first), width * PARTS), np.int64)
    for i, r in enumerate(first):
        start[i, : len(r.v)] = r.v
    books = [start[:, p * width : (p + 1) * width] for p in range(PARTS)]
    parts = write_through(weighed_parts(rows, dim), "parts")
    for _ in range(rounds):
        books = next_books(books, entry_sums(parts, books))
    return books


def coded(rows: DataFrame, books: list[Book]) -> DataFrame:
    """vec_id, label, code, error of every row; a batch's distinct parts are coded once."""
    width = books[0].shape[1]
    kinds = dict(rows.dtypes)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = np.zeros((len(batch), width * PARTS), np.int64)
            for i, v in enumerate(batch["v"]):
                whole[i, : len(v)] = v
            digits, error = np.zeros((len(batch), PARTS), np.uint8), np.zeros(len(batch), object)
            for p, book in enumerate(books):
                held, place = distinct_parts(whole[:, p * width : (p + 1) * width])
                entry, distance = nearest(held, book)
                digits[:, p] = entry[place]
                error += distance[place].astype(object)
            yield pd.DataFrame({
                "vec_id": batch["vec_id"], "label": batch["label"], "code": [d.tobytes().hex() for d in digits],
                "error": [min(int(e), _LONGEST) for e in error]})

    return rows.mapInPandas(code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def books_digest(books: list[Book]) -> str:
    """SHA-256 of all components in decimals by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for row in book for x in row).encode()).hexdigest()


def compress(vectors: DataFrame, vector: str = "embedding", scale: float = SCALE, rounds: int = ROUNDS) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    rows = write_through(whole_vectors(vectors, vector, scale), "vectors")
    dim = rows.agg(F.max(F.size("v"))).first()[0]
    if dim is None:
        kind = dict(vectors.dtypes)["vec_id"]
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    books = fit(rows, dim, rounds)
    codes = write_through(coded(rows, books), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONGEST).cast("decimal(38,0)")).cast("long")
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
