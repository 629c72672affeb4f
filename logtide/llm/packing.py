"""Best-fit packing of tokenized documents by bin completion.

The number of sequences depends on the pieces' lengths only, and there are at most as many
lengths as a sequence has tokens. So Spark counts the pieces per length, the search fills
bins from these counts (at most 1024 numbers, whatever the corpus), and Spark numbers the
pieces of each length and gives each number its place. Nothing but the counts leaves the
executors.

The search is branch and bound: around the largest piece left, it enumerates the
undominated fillings of the rest of the sequence, follows those of least waste, and prunes
when the waste so far excludes fewer sequences than the best solution found. The first
incumbent is best-fit decreasing; a solution at the lower bound ends the search.

Defined results: null and empty texts are one piece of one token (the end id); rows of
equal id and text are packed each; an empty table gives no rows. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_through
from .mixing import STRETCH, numbered
from .tokens import encoder

CAPACITY = 1024
END_ID = 2
FILLINGS = 12  # fillings followed around one piece
NODES = 20_000  # nodes of the search; beyond them the best solution so far stands

Counts = dict[int, int]
Bins = list[tuple[tuple[int, ...], int]]  # lengths in one sequence, and how many such sequences


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): documents cut so that all pieces but the first are full."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).ids
        end = np.asarray([END_ID], "<u4").tobytes()
        for batch in batches:
            which, rows = [], []
            for i, ids in enumerate(encode([t or "" for t in batch["text"]])):
                ids += end
                n = len(ids) // 4
                first = n % capacity or capacity
                for piece, (a, b) in enumerate(zip([0, *range(first, n, capacity)], [*range(first, n, capacity), n])):
                    part = ids[4 * a : 4 * b]
                    which.append(i)
                    rows.append((piece, a, b - a, zlib.crc32(part)) + (part,) * keep_ids)
            out = pd.DataFrame(rows, columns=["piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)
            out.insert(0, "doc_id", batch["doc_id"].iloc[which].reset_index(drop=True))
            yield out

    return docs.select("doc_id", "text").mapInPandas(cut, schema)


def lower_bound(counts: Counts, capacity: int) -> int:
    """No packing has fewer sequences: Martello and Toth's bound over all thresholds."""
    total = sum(s * n for s, n in counts.items())
    best = -(-total // capacity)
    for k in range(capacity // 2 + 1):
        alone = sum(n for s, n in counts.items() if s > capacity - k)
        large = [(s, n) for s, n in counts.items() if capacity / 2 < s <= capacity - k]
        n_large = sum(n for _, n in large)
        free = n_large * capacity - sum(s * n for s, n in large)
        small = sum(s * n for s, n in counts.items() if k <= s <= capacity / 2)
        best = max(best, alone + n_large + max(0, -(-(small - free) // capacity)))
    return best


def best_fit(counts: Counts, capacity: int) -> Bins:
    """Best-fit decreasing on counts: bins of equal content are held as one entry with a number."""
    open_bins: dict[int, list[list]] = {}  # free tokens -> [content, number]
    for size in sorted(counts, reverse=True):
        left = counts[size]
        for free in range(size, capacity + 1):
            if not left:
                break
            fit, kept = free // size, []
            for content, number in ([[(), 1 << 62]] if free == capacity else open_bins.pop(free, [])):
                full = min(number, left // fit)
                if full:
                    open_bins.setdefault(free - fit * size, []).append([content + (size,) * fit, full])
                left -= full * fit
                if left and number > full and left < fit:
                    open_bins.setdefault(free - left * size, []).append([content + (size,) * left, 1])
                    full, left = full + 1, 0
                if number > full and free < capacity:
                    kept.append([content, number - full])
            if kept:
                open_bins.setdefault(free, []).extend(kept)
    return [(tuple(c), n) for bins in open_bins.values() for c, n in bins if c]


def _fits_inside(small: tuple[int, ...], large: tuple[int, ...]) -> bool:
    """Whether the items of ``small`` can be put into bins of the sizes in ``large``."""
    if not small:
        return True
    seen = set()
    for i, room in enumerate(large):
        if room >= small[0] and room not in seen:
            seen.add(room)
            if _fits_inside(small[1:], tuple(sorted(large[:i] + large[i + 1 :] + (room - small[0],), reverse=True))):
                return True
    return False


def fillings(sizes: list[int], counts: Counts, room: int, waste: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` that waste at most ``waste``, least waste first, large items first."""
    found: list[tuple[int, ...]] = []
    steps = 0

    def extend(at: int, room: int, chosen: tuple[int, ...]) -> None:
        nonlocal steps
        steps += 1
        if len(found) >= 4 * FILLINGS or steps > 3000:
            return
        while at < len(sizes) and sizes[at] > room:
            at += 1
        if at == len(sizes) or not room:
            if room <= waste:
                found.append(chosen)
            return
        for i in range(at, len(sizes)):
            size = sizes[i]
            if chosen.count(size) < counts[size]:
                extend(i, room - size, chosen + (size,))
        if room <= waste and all(chosen.count(s) >= counts[s] for s in sizes[at:]):
            found.append(chosen)

    if counts.get(room):
        return [(room,)]  # an exact single item dominates every other filling
    extend(0, room, ())
    found = sorted(set(found), key=lambda f: (-sum(f), len(f)))
    kept: list[tuple[int, ...]] = []
    for filling in found:
        if len(kept) == FILLINGS:
            break
        if not any(len(filling) <= 8 and len(g) <= 8 and _fits_inside(filling, g) for g in kept):
            kept.append(filling)
    return kept


def bin_completion(counts: Counts, capacity: int = CAPACITY, nodes: int = NODES) -> Bins:
    """The bins of the best packing found; every count is used up."""
    total = sum(s * n for s, n in counts.items())
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    best_bins = sum(n for _, n in best)
    # Depth first; a node is (counts of its parent, content of the next bins, bins and waste so far,
    # path). Its own counts are made when it is taken up, so only those on one path are held.
    stack: list[tuple] = [(counts, (), 0, 0, None)]
    while stack and nodes and best_bins > bound:
        nodes -= 1
        above, content, bins, waste, path = stack.pop()
        left = dict(above)
        if content:
            # The same content as often as the counts allow, while its waste stays within the bound.
            empty = capacity - sum(content)
            times = min(left[s] // content.count(s) for s in set(content))
            if empty:
                times = min(times, max(1, ((best_bins - 1) * capacity - total - waste) // empty))
            for s in set(content):
                left[s] -= times * content.count(s)
                if not left[s]:
                    del left[s]
            bins, waste, path = bins + times, waste + times * empty, ((content, times), path)
        allowed = (best_bins - 1) * capacity - total - waste
        if allowed < 0:
            continue
        if not left:
            best, best_bins = [], bins
            while path:
                entry, path = path
                best.append(entry)
            continue
        sizes = sorted(left, reverse=True)
        largest = sizes[0]
        left_but = {**left, largest: left[largest] - 1}
        for filling in reversed(fillings([s for s in sizes if left_but[s]], left_but, capacity - largest, allowed)):
            stack.append((left, (largest, *filling), bins, waste, path))
    return best


def places(bins: Bins) -> dict[str, np.ndarray]:
    """Stretches of piece numbers per length: where each begins, its first sequence, offset and pieces per sequence."""
    used: Counts = {}
    rows, base = [], 0
    for content, times in bins:
        offset = 0
        for size in sorted(set(content), reverse=True):
            per = content.count(size)
            rows.append((size, used.get(size, 0), base, offset, per))
            used[size] = used.get(size, 0) + per * times
            offset += per * size
        base += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("size", "first", "base", "offset", "per"), table.T))


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    cut = write_through(pieces(docs, capacity, tokenizer, keep_ids), "pieces")
    counts = {int(r["length"]): r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    where = places(bin_completion(counts, capacity))
    parts = sum(counts.values()) // STRETCH + 1
    parted = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    ranked = numbered(parted, ["length"], "part", ["doc_id", "piece", "ids_crc32"], "nth").drop("part")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = where["size"] * (1 << 48) + where["first"]
        for batch in batches:
            size, nth = batch["length"].to_numpy(), batch["nth"].to_numpy()
            at = np.searchsorted(starts, size * (1 << 48) + nth, "right") - 1
            nth = nth - where["first"][at]
            batch["sequence_id"] = where["base"][at] + nth // where["per"][at]
            batch["offset"] = where["offset"][at] + nth % where["per"][at] * size
            yield batch.drop(columns="nth")

    kinds = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes)
    return ranked.mapInPandas(place, kinds + ", sequence_id long, offset long")
