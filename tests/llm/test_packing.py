import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from logtide.llm import packing
from logtide.llm.tokens import COMMON, encoder


def test_both_libraries_give_the_same_ids(data):
    rng = random.Random(1)
    bits = [" ", "  ", "\n", "a", "bc", "é", "\t", "\u00a0", "1", "22", "!", "<|endoftext|>", "'s", " \n", "\x1c", "\x85", "🙂", "   ", ".", "..", "\r\n", "ß", "ŁÓ", "—", "…", "\u00ad", "½", "ª", "'Ll", "\u2028"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["".join(chr(c) for c in rng.choices([*range(9, 11), 13, *range(32, 127), *range(0xA1, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F)], k=20)) for _ in range(3000)]
    texts += ["ab" * 40_000, " " * 3000]
    e = encoder()
    assert e.ids(texts) == [e.slow_ids(t) for t in texts]
    assert sum(bool(COMMON.fullmatch(t)) for t in texts) > 3000
    texts = [r[0] for r in pd.read_parquet(f"{data}/documents.parquet", columns=["text"]).values]
    assert e.ids(texts) == [e.slow_ids(t) for t in texts]


def test_strings_of_added_tokens_are_their_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "x<|endoftext|>y"
    assert list(np.frombuffer(encoder().ids([text])[0], "<u4")) == plain.encode(text, add_special_tokens=False).ids == [87, 50256, 88]


def fewest(sizes, capacity):
    """Fewest bins by trying all assignments."""
    best = len(sizes)

    def go(i, free):
        nonlocal best
        if len(free) >= best:
            return
        if i == len(sizes):
            best = len(free)
            return
        for j in range(len(free)):
            if free[j] >= sizes[i]:
                go(i + 1, free[:j] + [free[j] - sizes[i]] + free[j + 1 :])
        go(i + 1, free + [capacity - sizes[i]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(12))
def test_bin_completion_is_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(4, 30) for _ in range(10)), reverse=True)
    bins = packing.bin_completion(dict(Counter(sizes)), 40)
    assert all(sum(c) <= 40 for c, _ in bins)
    used = Counter(itertools.chain.from_iterable(c * n for c, n in bins))
    assert used == Counter(sizes)
    assert sum(n for _, n in bins) == fewest(sizes, 40)


def test_best_fit_and_bound_on_many_items():
    rng = np.random.default_rng(4)
    counts = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, 1025, 50_000), return_counts=True))}
    bound = packing.lower_bound(counts, 1024)
    for bins in (packing.best_fit(counts, 1024), packing.bin_completion(counts, 1024)):
        used = Counter()
        for content, n in bins:
            assert sum(content) <= 1024
            for size in content:
                used[size] += n
        assert used == counts
        assert sum(n for _, n in bins) <= bound * 1.002


def test_packing_round_trip(spark, documents):
    texts = ["a b", None, "", "word " * 3000, "the same", "the same", "x" * 5000, "é ü\n\n z  y"]
    docs = documents(*texts, (3, "repeated id", "en", "s"), (None, "no id", None, None))
    rows = packing.pack(docs, keep_ids=True).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.start > 0 and None), []).append(r)
    e = encoder()
    for i, text in enumerate(texts):
        if i == 3:
            continue
        parts = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        ids = b"".join(bytes(r.ids) for r in parts)
        assert ids == e.slow_ids(text or "") + b"\x02\0\0\0"
        at = 0
        for k, r in enumerate(parts):
            assert (r.piece, r.start, r.length) == (k, at, len(r.ids) // 4) and r.ids_crc32 == zlib.crc32(bytes(r.ids))
            assert k == 0 or r.length == 1024
            at += r.length
    assert sum(r.doc_id is None for r in rows) == 1 and sum(r.doc_id == 3 and r.piece == 0 for r in rows) == 2
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) == packing.lower_bound(Counter(r.length for r in rows), 1024)


def test_packing_of_nothing(spark, documents):
    assert packing.pack(documents("a").limit(0)).count() == 0
