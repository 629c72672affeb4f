import random
import re
from collections import defaultdict

import numpy as np
import pytest

from logtide.llm import jaccard_join


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else None


def brute(rows, threshold=0.8):
    sets = {i: shingles(t) for i, t in rows}
    classes = defaultdict(list)
    for i, s in sets.items():
        classes[s if s is not None else ("empty", i)].append(i)
    keys = list(classes)
    near = {k: [o for o in keys if o != k and isinstance(k, frozenset) and isinstance(o, frozenset) and len(k & o) >= threshold * len(k | o)] for k in keys}
    group = {}
    for k in keys:
        if k not in group:
            stack, members = [k], {k}
            while stack:
                for o in near[stack.pop()]:
                    if o not in members:
                        members.add(o)
                        stack.append(o)
            for m in members:
                group[m] = (min(min(classes[x]) for x in members), sum(len(classes[x]) for x in members))
    return sorted((i, min(classes[k]), len(near[k]), *group[k]) for k in keys for i in classes[k])


def near_copies(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 30, 120]))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    return texts + [None, "", " \n", "one", "one", "two words", texts[0] + "\n", " ".join(word() for _ in range(20_000))]


@pytest.mark.parametrize("block", [512, 3])
def test_join_equals_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_CLASSES", block)
    rows = list(enumerate(near_copies(block)))
    got = jaccard_join.jaccard_join(documents(*[t for _, t in rows]))
    assert sorted(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("copies", [2, 3, 4])
def test_empty_blocks_count_no_link_again(spark, documents, monkeypatch, copies):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 8)  # far more blocks than classes
    words = [f"w{i}" for i in range(60)]
    rows = list(enumerate(" ".join(words + [f"last{i}"]) for i in range(copies)))
    got = jaccard_join.jaccard_join(documents(*[t for _, t in rows]))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_nothing_and_missing_ids(spark, documents):
    assert jaccard_join.jaccard_join(documents("a").limit(0)).count() == 0
    same = "one two three four five six seven"
    got = jaccard_join.jaccard_join(documents((None, same, None, None), (4, same, None, None), (4, same, None, None), (None, None, None, None)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(None, 4, 0, 4, 3), (4, 4, 0, 4, 3), (4, 4, 0, 4, 3), (None, None, 0, None, 1)], key=repr)


def test_prefix_is_shortened_to_the_target():
    depth = jaccard_join.matched_depth()
    assert jaccard_join.meeting_probability(0.8, depth) >= jaccard_join.TARGET > jaccard_join.meeting_probability(0.8, depth + 1)
    rng, met = np.random.default_rng(3), 0
    for _ in range(300):
        base = rng.integers(1, 1 << 62, 90, dtype=np.uint64)
        a, b = base[:81], np.concatenate([base[9:81], base[81:]])  # 72 of 90 in common
        la, lb = jaccard_join.label_of(a, depth), jaccard_join.label_of(b, depth)
        met += bool((la == lb).all(axis=1).any())
    assert met >= 296


def test_pairs_at_the_threshold_meet():
    depth, rng, met = jaccard_join.matched_depth(), np.random.default_rng(5), 0
    for _ in range(5000):
        base = rng.integers(1, 1 << 62, 30, dtype=np.uint64)  # 24 of 30 in common
        met += bool((jaccard_join.label_of(base[:27], depth) == jaccard_join.label_of(base[3:], depth)).all(axis=1).any())
    assert met >= 4999  # 0.015 pairs are lost on average; 16 trees would lose 8.7


def test_prefix_is_shortened_until_the_queries_links_meet():
    depth = jaccard_join.matched_depth()
    assert jaccard_join.settled_depth({}) == jaccard_join.settled_depth({8: 40, depth: 1}) == depth
    assert jaccard_join.settled_depth({8: 40, 3: 1}) == 3 and jaccard_join.settled_depth({8: 40, 0: 1}) == 1


def test_queries_are_compared_with_whole_sets():
    rng = np.random.default_rng(7)
    base = np.sort(rng.integers(1, 1 << 62, 100, dtype=np.uint64))
    near, far = base[:85], np.sort(np.concatenate([base[:70], rng.integers(1, 1 << 62, 30, dtype=np.uint64)]))
    queries = jaccard_join.QuerySet([base, far], 0.8)
    label = jaccard_join.label_of(near)
    agree = next(d for d in range(jaccard_join.DEPTH, -1, -1) if (label[:, :d] == queries.labels[0][:, :d]).all(axis=1).any())
    assert queries.levels(near, jaccard_join.set_key(near), label) == [agree]
    assert queries.levels(base, jaccard_join.set_key(base), queries.labels[0]) == []
    assert jaccard_join.QuerySet([], 0.8).levels(near, b"", label) == []


def test_chains_settle(spark):
    edges = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(150)] + [("x", "x")], "a string, b string")
    roots = {r.node: r.root for r in jaccard_join.components(edges).collect()}
    assert roots.pop("x") == "x" and set(roots.values()) == {"000"} and len(roots) == 151


def test_one_of_each_group_keeps_columns(spark, documents):
    same = " ".join(f"w{i}" for i in range(60))
    docs = documents((5, same, "a", "b"), (3, same + " more", "c", "d"), (9, "other words are here now", None, None), (None, same, None, None), (7, None, None, None))
    got = jaccard_join.one_of_each_group(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [3, 7, 9]


def test_one_row_of_each_group_stays(spark, documents):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    docs = documents((0, a, "en", "s"), (1, a, "en", "s"), (1, b, "en", "s"), (1, b, "en", "s"), (1, b, "en", "r"), (None, None, "en", "s"), (None, None, "en", "s"))
    got = sorted(((r.doc_id, r.text, r.source) for r in jaccard_join.one_of_each_group(docs).collect()), key=repr)
    assert got == sorted([(0, a, "s"), (1, b, "r"), (None, None, "s"), (None, None, "s")], key=repr)
    copies = documents((None, a, "en", "s"), (None, a + " ", "en", "s"), (None, a, "en", "s"))
    assert jaccard_join.one_of_each_group(copies).count() == 1


def test_a_template_chains_no_texts(spark, documents, monkeypatch):
    """Half of the words of each page come from one template: similarity 0.33, no links, and hardly anything to verify."""
    rng, template = random.Random(4), [f"t{i}" for i in range(100)]
    texts = [" ".join(template + [f"w{rng.random()}" for _ in range(100)]) for _ in range(400)]
    docs = documents(*texts)
    rows = jaccard_join.signed(docs, jaccard_join.QuerySet([], 0.8))
    classes = jaccard_join.write_through(rows.select("key", "size", "label", "sketch"), "classes")
    depth = jaccard_join.matched_depth()
    shared = classes.select("key", jaccard_join.F.explode(jaccard_join.prefixes_of(depth)).alias("p")).groupBy("p").count().filter("count > 1")
    assert shared.count() > 10 and jaccard_join.candidate_blocks(classes, depth, 0.8).count() == 0


@pytest.mark.parametrize("small", [1, 2])
def test_large_buckets_lose_nothing(spark, documents, monkeypatch, small):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    rows = list(enumerate(near_copies(small)))
    assert sorted(map(tuple, jaccard_join.jaccard_join(documents(*[t for _, t in rows])).collect())) == brute(rows)


def test_components_of_random_graphs(spark):
    rng = random.Random(9)
    for n, m in ((40, 25), (60, 90), (30, 0)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i) for i in range(n)]
        root = list(range(n))
        for _ in range(n):
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        found = {r.node: r.root for r in jaccard_join.components(spark.createDataFrame(pairs, "a int, b int")).collect()}
        assert found == dict(enumerate(root))


def test_edges_shrink_with_every_round(spark, monkeypatch):
    sizes, whole = [], jaccard_join.write_through
    monkeypatch.setattr(jaccard_join, "write_through", lambda df, name: sizes.append((name, df.count())) or whole(df, name))
    edges = [(i, hub) for i in range(300) for hub in range(i % 7, 20, 7) if i > hub]
    jaccard_join.components(spark.createDataFrame(edges, "a int, b int")).count()
    left = [n for name, n in sizes if name == "edges"]
    assert left == sorted(left, reverse=True) and left[-1] == 0 and max(n for _, n in sizes) <= len(edges)


def test_prefixes_are_dealt_once(spark, documents, executed_plans):
    signed = jaccard_join.signed(documents(*near_copies(5)), jaccard_join.QuerySet([], 0.8)).filter("size > 0")
    classes = jaccard_join.write_through(signed.dropDuplicates(["key"]), "classes")
    plans = executed_plans(lambda: jaccard_join.candidate_edges(classes, 5, 0.8).collect())
    trees = [p.split("== Final Plan ==")[1].split("== Initial Plan ==")[0] for p in plans if "Generate (" in p and "WriteFiles" in p]
    assert [tree.count("Generate (") for tree in trees] == [1] and "ReusedExchange" in trees[0]
