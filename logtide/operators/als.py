"""Alternating least squares over blocks of ratings that read each other's factors from the shared folder.

Each side's ids are dealt to blocks by a hash. A block keeps its ratings, ordered by its own ids, with the
place of each rating's partner among the partner's factors, and solves its ids' normal equations in every
half-round. A half-round writes each factor once, whatever the number of blocks; a block
maps the files of the other side and reads the rows that it rates. Files are whole or absent, so
a task may run twice, and a lost executor takes nothing with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder, remove_at_exit, remove_folder, write_through

# Ratings that are gathered before they are dealt, and those whose partners' factors are held at once.
DEAL_RATINGS = 500_000
CHUNK_RATINGS = 200_000

# Ids of equally many ratings that are solved at once.
SOLVED_IDS = 512

_DEALT = "block int, ids binary, others binary, rates binary"


def parts_of(ids: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` parts an id falls into."""
    return (((ids.astype(np.uint32) * np.uint32(2654435769)).astype(np.uint64) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _put(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array as file ``name`` of ``folder``, whole or not at all."""
    store, root = FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    part = f"{root}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(np.ascontiguousarray(values).data.cast("B") if values.size else b"")
    store.move(part, f"{root}/{name}")


def _get(folder: str, name: str, dtype: str) -> np.ndarray:
    """The array of a file: mapped where the folder is mounted, else read."""
    store, root = FileSystem.from_uri(folder)
    path = f"{root}/{name}"
    if not store.get_file_info(path).size:
        return np.empty(0, dtype)
    if isinstance(store, LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def _valid(ratings: DataFrame) -> DataFrame:
    """user int, item int, rate float; an id or rate that is none stops the job."""

    def whole(name: str) -> Column:
        number = F.col(name).try_cast("int")
        return F.when(number == F.col(name), number).otherwise(F.raise_error(F.lit(f"{name} is not a whole number in the range of int"))).alias(name)

    rate = F.col("rate").cast("float")
    real = F.when(rate.isNotNull() & ~F.isnan(rate), rate).otherwise(F.raise_error(F.lit("rate is not a number"))).alias("rate")
    return ratings.select(whole("user"), whole("item"), real)


def _deal(blocks: int):
    """Ratings by user block and by item block, many in a row."""

    def packed(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        users, items, rates = (np.concatenate([b.column(c).to_numpy() for b in waiting]) for c in ("user", "item", "rate"))
        rows = []
        for side, (ids, others) in enumerate(((users, items), (items, users))):
            part = parts_of(ids, blocks).astype(np.min_scalar_type(blocks))
            order = np.argsort(part, kind="stable")
            found, starts = np.unique(part[order], return_index=True)
            for block, low, high in zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)]):
                mine = order[low:high]
                rows.append((side * blocks + block, *(x[mine].tobytes() for x in (ids, others, rates))))
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))], ["block", "ids", "others", "rates"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                held += batch.num_rows
            if held >= DEAL_RATINGS:
                yield packed(waiting)
                waiting, held = [], 0
        if waiting:
            yield packed(waiting)

    return run


def _keep(folder: str):
    """Write the ratings of a task's block, ids with few ratings first, and the block's ids in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, packs = None, []
        for batch in batches:
            if batch.num_rows:
                block = batch.column("block")[0].as_py()
                packs += zip(*(batch.column(c).to_pylist() for c in ("ids", "others", "rates")))
        if block is None:
            return
        ids, others, rates = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*packs), ("<i4", "<i4", "<f4")))
        del packs
        own, row, counts = np.unique(ids, return_inverse=True, return_counts=True)
        turn = np.argsort(counts, kind="stable")
        place = np.empty(len(own), np.int64)
        place[turn] = np.arange(len(own))
        # By the partner's id as well, so that the order of a sum does not hang on the order of arrival.
        order = np.argsort((place[row] << 32) + (others.astype(np.int64) + (1 << 31)))
        _put(f"{folder}/ids", str(block), own)
        _put(f"{folder}/turn", str(block), turn.astype("<i4"))
        _put(f"{folder}/counts", str(block), counts[turn].astype("<i8"))
        _put(f"{folder}/others", str(block), others[order])
        _put(f"{folder}/rates", str(block), rates[order])
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32())], ["block"])

    return run


def _chunks(ends: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """First and last rating, first and last id of chunks that end with an id; an id beyond a chunk has chunks of its own."""
    first = low = 0
    while first < len(ends):
        if ends[first] - low > CHUNK_RATINGS:
            yield low, low + CHUNK_RATINGS, first, first
            low += CHUNK_RATINGS
            continue
        whole = low == (ends[first - 1] if first else 0)
        last = int(np.searchsorted(ends, low + CHUNK_RATINGS, "right")) if whole else first + 1
        yield low, int(ends[last - 1]), first, last
        first, low = last, int(ends[last - 1])


def _place(folder: str, blocks: int):
    """For each chunk of a block: its partners by their block and row there, the cuts between blocks, and each rating's place among them."""

    def place(block: int) -> None:
        theirs = 0 if block >= blocks else blocks
        others = _get(f"{folder}/others", str(block), "<i4")
        slots, rows, cuts = np.empty(len(others), "<i4"), np.empty(len(others), "<i4"), []
        for low, high, _, _ in _chunks(np.cumsum(_get(f"{folder}/counts", str(block), "<i8"))):
            part = parts_of(others[low:high], blocks)
            order = np.lexsort((others[low:high], part))
            slots[low + order] = np.arange(len(order))
            cuts.append(np.searchsorted(part[order], np.arange(blocks + 1)))
            partners = others[low:high][order]
            for p in np.flatnonzero(np.diff(cuts[-1])).tolist():
                a, b = cuts[-1][p], cuts[-1][p + 1]
                rows[low + a : low + b] = np.searchsorted(_get(f"{folder}/ids", str(theirs + p), "<i4"), partners[a:b])
        _put(f"{folder}/slots", str(block), slots)
        _put(f"{folder}/rows", str(block), rows)
        _put(f"{folder}/cuts", str(block), np.concatenate(cuts).astype("<i8"))

    return place


def _begin(folder: str, to: str, rank: int, seed: int):
    """Factors of length 1 in random directions."""

    def begin(block: int) -> None:
        drawn = np.random.default_rng([seed & 0xFFFFFFFF, block]).normal(size=(len(_get(f"{folder}/ids", str(block), "<i4")), rank))
        _put(to, str(block), (drawn / np.sqrt((drawn * drawn).sum(axis=1))[:, None]).astype("<f4"))

    return begin


def _sums(vectors: np.ndarray, rates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per id, of (ids, ratings, rank) factors: their products with each other, and with the rates."""
    vectors = vectors.astype(float)
    across = vectors.transpose(0, 2, 1)
    return across @ vectors, across @ rates[:, :, None].astype(float)


def _solved(square: np.ndarray, right: np.ndarray, count: int, reg: float) -> np.ndarray:
    """The weight of ``reg`` is an id's number of ratings."""
    axes = np.arange(square.shape[1])
    square[:, axes, axes] += reg * count
    return np.linalg.solve(square, right)[:, :, 0]


def _solve(folder: str, blocks: int, source: str, to: str, rank: int, reg: float):
    """Factors of a block's ids, given those of the other side."""

    def solve(block: int) -> None:
        theirs = 0 if block >= blocks else blocks
        turn, counts = _get(f"{folder}/turn", str(block), "<i4"), np.array(_get(f"{folder}/counts", str(block), "<i8"))
        slots, rows, rates = (_get(f"{folder}/{name}", str(block), kind) for name, kind in (("slots", "<i4"), ("rows", "<i4"), ("rates", "<f4")))
        cuts = _get(f"{folder}/cuts", str(block), "<i8").reshape(-1, blocks + 1)
        factors = {}
        out = np.empty((len(turn), rank), "<f4")
        held = None
        for (low, high, first, last), cut in zip(_chunks(np.cumsum(counts)), cuts):
            partners = np.empty((high - low, rank), "<f4")
            for p in np.flatnonzero(np.diff(cut)).tolist():
                if p not in factors:
                    factors[p] = _get(source, str(theirs + p), "<f4").reshape(-1, rank)
                np.take(factors[p], rows[low + cut[p] : low + cut[p + 1]], axis=0, out=partners[cut[p] : cut[p + 1]], mode="clip")
            vectors = partners.take(slots[low:high], axis=0)
            rated = rates[low:high]
            if held is not None or first == last:  # a piece of one id's ratings
                piece = _sums(vectors[None], rated[None])
                held = piece if held is None else (held[0] + piece[0], held[1] + piece[1])
                if last > first:
                    out[turn[first]] = _solved(*held, counts[first], reg)[0]
                    held = None
                continue
            at = 0
            runs = [first, *(np.flatnonzero(np.diff(counts[first:last])) + first + 1).tolist(), last]
            for begin, end in zip(runs, runs[1:]):
                count = int(counts[begin])
                for i in range(begin, end, SOLVED_IDS):
                    some = min(SOLVED_IDS, end - i)
                    take = slice(at, at := at + some * count)
                    out[turn[i : i + some]] = _solved(*_sums(vectors[take].reshape(some, count, rank), rated[take].reshape(some, count)), count, reg)
        _put(to, str(block), out)

    return solve


def _each(spark: SparkSession, blocks: list[int], work) -> None:
    """Do the work of each block in a task of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column("id").to_pylist():
                work(blocks[at])
            yield batch

    spark.range(0, len(blocks), 1, len(blocks)).mapInArrow(run, "id bigint").count()


def _factors(spark: SparkSession, blocks: list[int], folder: str, source: str, rank: int) -> DataFrame:
    """id, features of a side, as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column("id").to_pylist():
                ids = _get(f"{folder}/ids", str(blocks[at]), "<i4")
                values = _get(source, str(blocks[at]), "<f4").reshape(-1, rank)
                for low in range(0, len(ids), SOLVED_IDS):
                    some = values[low : low + SOLVED_IDS]
                    lists = pa.ListArray.from_arrays(np.arange(0, some.size + 1, rank, "i4"), pa.array(some.ravel(), pa.float32()))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[low : low + SOLVED_IDS], pa.int32()), lists], ["id", "features"])

    read = spark.range(0, len(blocks), 1, len(blocks)).mapInArrow(run, "id int, features array<float>")
    return write_through(read, "factors")


def train_factors(ratings: DataFrame, rank: int, max_iter: int, reg: float, seed: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """id, features of the users and of the items after ``max_iter`` rounds, of (user, item, rate).

    The items are solved first, from random factors of the users. Each rating counts, repeated ones too;
    ids and rates that are null or no numbers stop the job, and so does a table without ratings.
    """
    spark = ratings.sparkSession
    folder = new_folder(spark, "als")
    remove_at_exit(spark, folder)
    dealt = _valid(ratings).mapInArrow(_deal(blocks), _DEALT).repartitionById(2 * blocks, F.col("block"))
    found = sorted(r.block for r in dealt.mapInArrow(_keep(folder), "block int").collect())
    if not found:
        raise ValueError("no ratings")
    sides = [b for b in found if b < blocks], [b for b in found if b >= blocks]
    _each(spark, found, _place(folder, blocks))
    remove_folder(spark, f"{folder}/others")
    at = [f"{folder}/factors-{uuid.uuid4().hex}" for _ in sides]
    for side, to in zip(sides, at):
        _each(spark, side, _begin(folder, to, rank, seed))
    for _ in range(max_iter):
        for mine, theirs in ((1, 0), (0, 1)):
            to = f"{folder}/factors-{uuid.uuid4().hex}"
            _each(spark, sides[mine], _solve(folder, blocks, at[theirs], to, rank, reg))
            remove_folder(spark, at[mine])
            at[mine] = to
    made = tuple(_factors(spark, side, folder, source, rank) for side, source in zip(sides, at))
    remove_folder(spark, folder)
    return made
