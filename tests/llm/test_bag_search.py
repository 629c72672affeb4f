"""Lexical search against a plain one that scores every document for every item."""

import math
import re
from collections import Counter

import pytest

from logtide.llm import bag_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=20):
    held = [(i, Counter(t)) for i, t in ((i, terms_of(x)) for i, x in docs) if t]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        asked = terms_of(text)
        scores = []
        for i, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in asked if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i, score))
        out += [(item, rank, s[3], s[4]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def tables(spark):
    def make(docs, items):
        d = spark.createDataFrame([(i, t, 1, 2.0, "x") for i, t in docs], "doc_id long, text string, m int, class double, hash string")
        return d.repartition(3), spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, item int")

    return make


def found(docs, items):
    return sorted(map(tuple, bag_search.search(docs, items).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


DOCS = [
    (1, "the red fox"), (2, "The RED fox!"), (3, None), (4, ""), (5, "..."), (6, "fox fox fox red"), (None, "the red fox"), (7, "other words only"),
    (1, "the red fox"), (-4, "the red fox"), (8, "fóx Éa red " * 400), (9, "fox-red\x00red the"), (10, "the " * 3000 + "blue"), *[(100 + i, "blue sky fox") for i in range(30)],
]
ITEMS = [(0, "red fox fox"), (1, "the blue sky"), (2, None), (3, "nothing here matches?"), (4, "fóx éa Éa"), (5, "red"), (5, "blue"), (None, "sky")]


def test_search_equals_a_plain_one(tables):
    assert found(*tables(DOCS, ITEMS)) == plain(DOCS, ITEMS)


def test_the_given_tables(spark, data):
    docs, items = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    rows = lambda df, *names: [tuple(r) for r in df.select(*names).collect()]
    assert found(docs, items) == plain(rows(docs, "doc_id", "text"), rows(items, "item_id", "text"))


def test_small_blocks_give_the_same(tables, monkeypatch):
    for name, value in {"ITEMS": 2, "ITEM_TERMS": 2, "SHARD": 2, "SHARD_ENTRIES": 3, "CELL": 1, "FAN_IN": 2, "DENSE": 4, "PIECE": 7}.items():
        monkeypatch.setattr(bag_search, name, value)
    assert found(*tables(DOCS, ITEMS)) == plain(DOCS, ITEMS)


def test_a_vocabulary_beyond_the_bound_is_joined(tables, monkeypatch):
    monkeypatch.setattr(bag_search, "VOCABULARY_TERMS", 1)
    assert found(*tables(DOCS, ITEMS)) == plain(DOCS, ITEMS)


def test_classes_of_one_hash_are_told_apart(tables, monkeypatch):
    whole = bag_search.bags
    monkeypatch.setattr(bag_search, "bags", lambda *a: whole(*a).withColumn("hash", bag_search.F.lit(1).cast("long")))
    assert found(*tables(DOCS, ITEMS)) == plain(DOCS, ITEMS)


def test_empty_tables(tables):
    assert found(*tables([], ITEMS)) == [] and found(*tables(DOCS, [])) == [] and found(*tables([(1, None)], ITEMS)) == []


def test_copies_are_scored_once(tables):
    docs, items = tables([(i, "red fox") for i in range(500)], [(0, "red")])
    listed = bag_search.listed_items(items)
    vocabulary = listed.select(bag_search.F.explode("words").alias("term")).distinct().withColumn("number", bag_search.F.lit(0).cast("long"))
    classes = bag_search.bag_classes(bag_search.with_norm(bag_search.bags(docs, vocabulary), 500, 1000))
    assert [(r.members, r.first_id) for r in classes.collect()] == [(500, 0)]


def test_scores_beyond_doubles_stay_exact(tables):
    items = [(0, "red " * 300_000 + "fox")]
    docs = [(1, "red"), (2, "red fox"), (3, "blue"), (4, "red red")]
    assert found(*tables(docs, items)) == plain(docs, items)
