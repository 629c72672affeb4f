import hashlib
import re
from collections import defaultdict

import pytest

from logtide.llm import exact_dedup, mixing

TEXTS = ["a b", "ab", None, "", " \t", "ab\x0b\n", "é b", "éb", "x" * 50_000, "ab", "a b"]


def expected_dedup(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i if i is not None else 0, i))
    out, done = [], set()
    for i, text, *_ in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        keep = min(groups[norm])[3]
        stays = (-len(text or ""), i is None, i if i is not None else 0, i) == min(groups[norm]) and norm not in done
        done |= {norm} if stays else set()
        out.append((i, keep, len(groups[norm]), stays, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup_equals_brute_force(spark, documents):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(None, "ab", "en", "s"), (None, "only null", "en", "s")]
    rows += [(50, "twice", "en", "s"), (50, "twice", "en", "s"), (50, "twi ce", "en", "s"), (None, "none", "en", "s"), (None, "none", "en", "t")]
    got = exact_dedup.exact_dedup(documents(*rows), exact_dedup.new_index(spark))
    assert sorted(map(tuple, got.collect()), key=repr) == expected_dedup(rows)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_exact_dedup_of_nothing(spark, documents):
    assert exact_dedup.exact_dedup(documents("a").limit(0), exact_dedup.new_index(spark)).count() == 0


def test_index_persists_between_batches(spark, documents, plan_of):
    index = exact_dedup.new_index(spark)
    first = exact_dedup.exact_dedup(documents((1, "a", None, None), (2, "b", None, None)), index)
    assert all(r.kept for r in first.collect())
    batch = documents((3, "a ", None, None), (4, "c", None, None), (5, "c", None, None))
    groups = exact_dedup.best_of_digest(exact_dedup.digests(batch))
    plan = plan_of(index.unseen(groups))
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Python" not in plan
    second = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_dedup(batch, index).collect()}
    assert second == {3: (1, False), 4: (4, True), 5: (4, False)}
    assert index.read().count() == 3


def test_the_registered_query_runs_the_anti_join(spark, data, executed_plans):
    from logtide import llm

    ran = executed_plans(lambda: llm.queries()["op8_exact_dedup"](spark, data).count())
    assert any("SortMergeJoin" in plan and "LeftAnti" in plan for plan in ran)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index")]


def test_buckets_are_kept_with_the_index(spark, documents):
    index = exact_dedup.new_index(spark)
    exact_dedup.exact_dedup(documents("a", "b"), index)
    again = exact_dedup.DigestIndex(spark, index.name, index.path)
    exact_dedup.exact_dedup(documents("c"), again)
    assert again.buckets == index.buckets == exact_dedup.LEAST_BUCKETS and again.read().count() == 3


def test_of_rows_equal_in_id_and_text_the_smallest_is_kept(spark, documents):
    docs = documents((1, "a", "en", "t"), (1, "a", "en", "s"), (1, "a", "en", None))
    got = exact_dedup.kept_documents(docs, exact_dedup.new_index(spark)).collect()
    assert [(r.doc_id, r.source) for r in got] == [(1, None)]


def test_a_text_in_two_sources_is_mixed_for_each(spark, documents):
    text = " ".join(f"w{i}" for i in range(50))
    docs = documents((1, text, "en", "x"), (1, text, "en", "y"), (1, text, "en", "y"), (1, text, "en", "y"))
    taken = {(r.source, r.copies) for r in mixing.mix(docs).select("source", "copies").distinct().collect()}
    got = mixing.mixed_documents(docs).groupBy("source").count().collect()
    assert {(r.source, r["count"]) for r in got} == {(s, n * (1 if s == "x" else 3)) for s, n in taken if n}


def test_kept_documents_carry_all_columns(spark, documents):
    docs = documents((1, "a", "en", "s"), (2, "a", "de", "t"), (1, "a", "en", "s"), (3, None, None, None), (None, " ", "fr", None))
    got = exact_dedup.kept_documents(docs, exact_dedup.new_index(spark))
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == [(1, "a"), (None, " ")]


def test_targets_share_all_words_and_stop_at_the_bound(spark, documents):
    rows = [(i, "w " * n, "en", s) for i, (s, n) in enumerate([("a", 90), ("b", 1), ("c", 2), (None, 7), ("d", 0)])]
    got = {r.source: (r.source_size, r.target) for r in mixing.source_targets(mixing.sized(documents(*rows))).collect()}
    sizes = {"a": 90, "b": 1, "c": 2, "d": 0, None: 7}
    weights = dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2]))
    targets, free = {}, dict(weights)
    while True:
        left = sum(sizes.values()) - sum(targets.values())
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in share if share[s] > 3 * sizes[s]]
        if not over:
            targets.update(share)
            break
        for s in over:
            targets[s] = 3 * sizes[s]
            del free[s]
    assert {s: v[0] for s, v in got.items()} == sizes
    for s, target in targets.items():
        assert got[s][1] == pytest.approx(target)


def test_mix_comes_near_its_targets_and_reruns_agree(spark, documents):
    rows = [(i, "word " * (1 + i * 37 % 200), "en", f"s{min(i % 9, 4)}") for i in range(400)]
    rows += [(1000, None, "en", "s1"), (1001, "", "en", None), (1002, "one two", "en", None), (None, "a b c", "en", "s2"), (5, rows[5][1], "en", rows[5][3])]
    docs = documents(*rows)
    first = sorted(map(tuple, mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()), key=repr)
    again = sorted(map(tuple, mixing.mix(docs.repartition(7)).select("doc_id", "size", "source_size", "target", "taken").collect()), key=repr)
    assert first == again and len(first) == len(rows)
    taken, target = defaultdict(int), {}
    for _, size, source_size, t, took in first:
        assert 0 <= took <= 3 * size
        taken[source_size] += took
        target[source_size] = t
    for s in target:
        assert abs(taken[s] - target[s]) <= max(2, 0.01 * target[s])


def test_schedule_spreads_each_source(spark, documents):
    rows = [(i, "w " * 100, "en", "ab"[i % 2]) for i in range(40)]
    plan = mixing.block_plan(mixing.source_targets(mixing.sized(documents(*rows))))
    slots = sorted((r.slot, r.nth) for r in mixing.schedule(plan).collect())
    share = sum(n == 1 for _, n in slots) / len(slots)
    for at in range(0, len(slots) - 256, 256):
        part = sum(n == 1 for _, n in slots[at : at + 256]) / 256
        assert abs(part - share) < 0.03
    ranks = sorted(r["rank"] for r in mixing.schedule(plan).filter("nth = 1").collect())
    assert ranks == list(range(len(ranks)))


def test_mix_of_nothing_and_of_empty_texts(spark, documents):
    assert mixing.mix(documents("a").limit(0)).count() == 0
    assert [(r.size, r.target, r.taken) for r in mixing.mix(documents(None, "")).collect()] == [(0, 0.0, 0)] * 2


def test_mixed_documents_keep_their_columns(spark, documents):
    docs = documents(*[(i, f"w{i} " * 50, "en", f"s{i % 3}") for i in range(60)], (99, None, None, None))
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert 99 not in counts and max(counts.values()) <= 3


@pytest.mark.parametrize("name", ["op6_mixing", "op8_exact_dedup"])
def test_native_queries_run_no_python(spark, data, plan_of, name):
    from logtide import llm

    plan = plan_of(llm.queries()[name](spark, data))
    assert not any(p in plan for p in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))
