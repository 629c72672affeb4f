import json
import math
import pathlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide import session
from logtide.llm import kneser_ney, store

TEXTS = ["the cat sat", "the cat ran", "a cat sat down", "The  CAT\nsat", "", None, "dog", "the the the the", "a b c a b c a b d É é", "the cat sat", "x y z w", "a b c"]


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [None]


def discounts(counts):
    n = [sum(c == j for c in counts) for j in range(1, 5)]
    return kneser_ney.discounts(n)


class Plain:
    """The same model in dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.unigrams = Counter(t for text in texts for t in tokens(text))
        top = Counter()
        for text in texts:
            padded = ["<s>"] * (order - 1) + tokens(text)
            top.update(tuple(padded[i : i + order]) for i in range(len(padded) - order + 1))
        self.counts = {order: top}
        for k in range(order - 1, 0, -1):
            below = Counter()
            for gram, c in self.counts[k + 1].items():
                below[gram[1:]] += c if gram[1] == "<s>" else 1
            self.counts[k] = below
        self.d = {k: discounts(c.values()) for k, c in self.counts.items()}
        self.contexts = {k: defaultdict(list) for k in self.counts}
        for k, c in self.counts.items():
            for gram, n in c.items():
                self.contexts[k][gram[:-1]].append(n)

    def p(self, gram):
        k = len(gram)
        lower = self.p(gram[1:]) if k > 1 else 1 / (len(self.unigrams) + 1)
        found = self.contexts[k].get(gram[:-1])
        if not found:
            return lower
        c, total = self.counts[k].get(gram, 0), sum(found)
        spread = sum(self.d[k][min(n, 3) - 1] for n in found) / total
        return (max(c - self.d[k][min(c, 3) - 1], 0) / total if c else 0) + spread * lower

    def score(self, text):
        padded = ["<s>"] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(padded[i : i + self.order]))) for i in range(len(padded) - self.order + 1))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_model_equals_dictionaries(spark, documents, order):
    docs = documents(*TEXTS, (None, "the cat sat unseen", "en", "s"), (777, "the " * 4000, "en", "s"))
    held = F.coalesce(F.col("doc_id") % 4 == 3, F.lit(True))
    train = docs.filter(~held)
    folder = kneser_ney.train(train, order)
    model = Plain([r.text for r in train.collect()], order)
    total, size = sum(model.unigrams.values()), len(model.unigrams)
    text_of = {r.doc_id: r.text for r in docs.collect()}
    rows = kneser_ney.score(docs, folder, held).collect()
    assert len(rows) == docs.count()
    for r in rows:
        t = tokens(text_of[r.doc_id])
        assert r.n_tokens == len(t) and r.n_known == sum(w in model.unigrams for w in t) and r.train_tokens == total
        assert r.base_score == pytest.approx(sum(math.log10((model.unigrams[w] + 0.1) / (total + 0.1 * (size + 1))) for w in t))
        assert r.score == pytest.approx(model.score(text_of[r.doc_id]))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_add_up(spark, documents, order):
    folder = kneser_ney.train(documents(*TEXTS), order)
    model = kneser_ney.Scorer(folder)
    ids = np.concatenate([np.arange(1, model.size + 1), [kneser_ney.UNKNOWN_ID]]).astype(np.uint32)
    for context in ([0, 0], [0, 3], [2, 5], [1, kneser_ney.UNKNOWN_ID]):
        rows = np.column_stack([np.full(len(ids), c, np.uint32) for c in context[2 - order + 1 :]] + [ids]) if order > 1 else ids[:, None]
        assert model.probabilities(rows).sum() == pytest.approx(1.0)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_nothing_to_learn_from(spark, documents, order):
    docs = documents("a b", None)
    folder = kneser_ney.train(docs.limit(0), order)
    assert sorted((r.n_tokens, r.n_known, r.score) for r in kneser_ney.score(docs, folder, F.lit(True)).collect()) == [(1, 0, 0.0), (3, 0, 0.0)]


def test_several_directories_give_the_same_scores(spark, documents, monkeypatch):
    docs = documents(*TEXTS)

    def scores():
        folder = kneser_ney.train(docs, 2)
        found = kneser_ney.score(docs, folder, F.lit(False)).collect()
        return folder, sorted((r.doc_id, r.score, r.base_score, r.n_known) for r in found)

    one, expected = scores()
    monkeypatch.setattr(kneser_ney, "DIRECTORIES", 2)
    several, got = scores()
    sizes = json.loads(store.read(several, "model.json"))["words"]
    assert len(sizes) == 2 and len(json.loads(store.read(one, "model.json"))["words"]) == 1
    assert got == expected


def test_blocks_of_a_level_are_removed(spark, documents):
    root = pathlib.Path(session.work_root(spark).removeprefix("file:"))
    before = {p.name for p in root.iterdir()}
    kneser_ney.train(documents(*TEXTS), 3)
    assert [n.rsplit("-", 1)[0] for n in {p.name for p in root.iterdir()} - before] == ["language-model"]


def test_files_are_whole_and_written_again_alike(tmp_path):
    for data in (b"one", b"two"):
        store.put(f"file://{tmp_path}/a", "x", data)
    assert store.read(f"file://{tmp_path}/a", "x") == b"two" and [p.name for p in (tmp_path / "a").iterdir()] == ["x"]
