"""Product codes against a plain loop over all rows and entries."""

import hashlib
import math
import random

import numpy as np
import pytest

from logtide.llm import vector_codes


def plain(rows, scale=4096, rounds=6, parts=8, entries=16):
    kept = [(i, lab, [math.floor(x * scale) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, _, v in kept) // parts)
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    cut = lambda v: [(v + [0] * (width * parts - len(v)))[p * width : (p + 1) * width] for p in range(parts)]
    books = [list(book) for book in zip(*[cut(v) for _, _, v in first])]
    near = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for _, _, v in kept:
                groups.setdefault(near(cut(v)[p], book)[1], []).append(cut(v)[p])
            books[p] = [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else e for k, e in enumerate(book)]
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    coded = [(i, lab, [near(part, book) for part, book in zip(cut(v), books)]) for i, lab, v in kept]
    by_label = {}
    for _, lab, found in coded:
        by_label[lab] = by_label.get(lab, 0) + sum(d for d, _ in found)
    end = (1 << 63) - 1  # errors beyond a long stay at its end
    by_label = {lab: min(total, end) for lab, total in by_label.items()}
    return sorted([(i, "".join(f"{k:02x}" for _, k in found), min(sum(d for d, _ in found), end), by_label[lab], sha) for i, lab, found in coded], key=repr)


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, code string, pos int").repartition(3)


def found(df):
    return sorted(map(tuple, vector_codes.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def some(n, dim=16, seed=1, values=7):
    rng = random.Random(seed)
    return [(i, rng.choice([None, 0, 1, 1, 1]), [rng.randrange(-values, values) / 3 for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("rows", [
    some(200), some(5), some(60, dim=19), some(1), [],
    some(40) + [(3, 1, None), (4, 1, [None] * 16), (5, 1, [float("nan")] + [0.0] * 15), (6, 0, [float("inf")] * 16)],
    [(None, 1, [0.1] * 16), (7, None, [0.2] * 16), (7, None, [0.1] * 16), (7, None, [0.2] * 16)] * 4,
    [(i, 0, [0.5] * 8) for i in range(50)], [(1, 1, []), (2, 1, [])], [(1, 1, []), (2, 1, [0.25] * 16)],
    [(i, i % 2, [(-1) ** i * 1e6 * i] * 16) for i in range(40)],
])
def test_codes_equal_a_plain_loop(vectors, rows):
    assert found(vectors(rows)) == plain(rows)


def test_the_given_table(spark, data):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    assert found(spark.read.parquet(f"{data}/embeddings.parquet")) == plain(rows)


@pytest.mark.parametrize("size", [1, 3, 50, 4096])
@pytest.mark.parametrize("values", [3, 1 << 40])
def test_the_trie_finds_the_nearest_entry(monkeypatch, size, values):
    monkeypatch.setattr(vector_codes, "SUBTREE", size)
    rng = np.random.default_rng(size)
    rows = rng.integers(-values, values, (300, 5))
    rows[:, 0] = rng.integers(0, 2, 300)
    book = rng.integers(-values, values, (16, 5))
    book[9] = book[2]  # a tie
    parts, place = vector_codes.distinct_parts(rows)
    assert (parts[place] == rows).all() and [tuple(p) for p in parts] == sorted(set(map(tuple, rows.tolist())))
    entry, distance = vector_codes.nearest(parts, book)
    for part, e, d in zip(parts.tolist(), entry, distance):
        assert (int(d), e) == min((sum((a - b) ** 2 for a, b in zip(part, b_)), k) for k, b_ in enumerate(book.tolist()))


def test_prefixes_are_summed_once(monkeypatch):
    """Rows below one prefix of three components cost one sum for these."""
    shared = np.array([[1, 2, 3, x] for x in range(8)])
    found, leaf = vector_codes.subtree(shared, np.zeros((2, 4), np.int64), np.zeros(2, np.int64))
    assert len(found) == 8 and leaf.tolist() == list(range(8)) and found[:, 0].tolist() == [14 + x * x for x in range(8)]
