"""Hashed words of many texts at once, in numpy.

A word is a longest run of characters other than space and U+0009..U+000D. Its
hash is a 64-bit polynomial over its UTF-8 bytes: differences of one running sum
over the joined bytes give the hashes of all words without a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CHUNK_BYTES = 1 << 20  # bytes hashed at once; bounds memory, not the texts

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit words over all bits (the splitmix64 finish)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(*hashes: np.ndarray) -> np.ndarray:
    """One hash for aligned sequences of hashes, order counting."""
    out = hashes[0]
    for h in hashes[1:]:
        out = mix(out * np.uint64(_BASE) + h)
    return out


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def _hash_bytes(data: np.ndarray, prefix: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (of the first ``prefix`` bytes) and start positions of the words in ``data``."""
    up, down = _power_tables(len(data) + 1)
    word = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if prefix:
        ends = np.minimum(ends, starts + prefix)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _pieces(texts: Iterable[str | None]) -> Iterator[tuple[int, bytes]]:
    """(text number, bytes), long texts cut at a space so that no piece is much over CHUNK_BYTES."""
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        at = 0
        while len(data) - at > CHUNK_BYTES:
            cut = max(data.rfind(c, at, at + CHUNK_BYTES) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut <= at:
                found = [p for p in (data.find(c, at + CHUNK_BYTES) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p > 0]
                if not found:
                    break
                cut = min(found)
            yield i, data[at:cut]
            at = cut
        yield i, data[at:]


def word_hashes(texts: list[str | None], lower: bool = False, prefix: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text.

    ``lower`` lower-cases A-Z; ``prefix`` hashes the first bytes of each word only.
    """
    counts = np.zeros(len(texts), np.int64)
    out: list[np.ndarray] = []
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if not held:
            return
        data = np.frombuffer(b" ".join(d for _, d in held), np.uint8)
        if lower:
            data = _LOWER[data]
        hashes, starts = _hash_bytes(data, prefix)
        bounds = np.cumsum([len(d) + 1 for _, d in held])
        per_piece = np.diff(np.searchsorted(starts, np.concatenate(([0], bounds))))
        np.add.at(counts, [i for i, _ in held], per_piece)
        out.append(hashes)
        held, size = [], 0

    for i, data in _pieces(texts):
        if held and size + len(data) > CHUNK_BYTES:
            flush()
        held.append((i, data))
        size += len(data) + 1
    flush()
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), counts
