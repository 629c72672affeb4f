import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from logtide.operators import parsers, textindex, textsim
from logtide.session import new_folder


@pytest.fixture
def docs(lines):
    return parsers.split_tagged_docs(lines("a,x x y", "b,x z", "c,w w"))


def test_counts(docs, rows):
    tf = textsim.term_frequency(docs)
    assert ("a", "x", 2) in rows(tf) and len(rows(tf)) == 5
    assert rows(textsim.document_frequency(tf)) == [("w", 1), ("x", 2), ("y", 1), ("z", 1)]
    assert rows(textsim.term_doc_counts(docs)) == [(3, 4)]


def test_real_and_whole_number_weights(docs):
    tf = textsim.term_frequency(docs)
    real = {r.term: r.idf for r in textsim.idf(docs, tf).collect()}
    whole = {r.term: r.idf for r in textsim.idf(docs, tf, compat=True).collect()}
    assert math.isclose(real["x"], 1 + math.log(1.5)) and whole["x"] == 1.0
    assert math.isclose(whole["w"], 1 + math.log(3))
    real = {(r.name, r.term): r.tf for r in textsim.tf_weight(docs).collect()}
    whole = {(r.name, r.term): r.tf for r in textsim.tf_weight(docs, compat=True).collect()}
    assert math.isclose(real["a", "x"], math.sqrt(2 / 3))
    assert whole["a", "x"] == 0.0 and whole["c", "w"] == 1.0


def test_vectors_keep_names_and_dense_ids(docs):
    got = {(r.name, r.term): r.term_id for r in textsim.tfidf_vectors(docs).collect()}
    assert got == {("a", "x"): 1, ("a", "y"): 2, ("b", "x"): 1, ("b", "z"): 3, ("c", "w"): 0}


def test_score_equals_the_formula(spark, docs):
    terms = textsim.vocabulary(docs)
    vectors = textsim.tfidf_vectors(docs, terms=terms)
    query = spark.createDataFrame([("x",), ("y",), ("x",), ("unknown",)], "term string")
    got = {r.name: r.score for r in textsim.score_query(vectors, query, terms).collect()}
    idf = {"x": 1 + math.log(3 / 2), "y": 1 + math.log(3)}
    norm = math.sqrt(sum(v * v for v in idf.values()))
    a = (math.sqrt(2 / 3) * idf["x"] ** 2 + math.sqrt(1 / 3) * idf["y"] ** 2) / norm * 2 / 3
    b = math.sqrt(1 / 2) * idf["x"] ** 2 / norm * 1 / 3
    assert set(got) == {"a", "b"} and math.isclose(got["a"], a) and math.isclose(got["b"], b)


def test_repeated_names_are_one_document(lines, rows):
    docs = parsers.split_tagged_docs(lines("a,x", "a,x y"))
    got = {r.term: (r.cnt, r.total) for r in textsim.tf_weight(docs).collect()}
    assert got == {"x": (2, 3), "y": (1, 3)}
    assert rows(textsim.term_doc_counts(docs)) == [(1, 2)]


def test_scores_from_documents_equal_scores_from_vectors(spark, docs, rows):
    query = spark.createDataFrame([("x",), ("w",), ("x",), ("unknown",)], "term string")
    terms = textsim.vocabulary(docs)
    slow = textsim.score_query(textsim.tfidf_vectors(docs, terms=terms), query, terms)
    fast = textsim.score_documents(docs, query)
    key = lambda df: [(n, m, round(s, 9)) for n, m, s in rows(df, "name", "matched", "score")]
    assert key(fast) == key(slow) and len(key(fast)) == 3


@pytest.fixture
def index(spark):
    root = new_folder(spark, f"index-{uuid.uuid4().hex}")
    textindex.create_index(spark, root)
    return root


@pytest.fixture
def many(spark):
    """Six hundred documents of which a third share a word, and one word is rare."""
    rng = random.Random(6)
    made = [(f"d{i:03}", [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.randrange(1, 40))]
             + (["hot"] * (1 + i % 5) if i % 3 == 0 else []) + (["rare"] * 9 if i in (5, 77) else [])) for i in range(600)]
    return spark.createDataFrame(made, "name string, words array<string>")


def ranked(df, k):
    best = df.orderBy(F.round("score", 9).desc(), "name").limit(k).collect()
    return [(r.name, r.matched, round(r.score, 9)) for r in best]


def test_the_index_answers_as_the_documents_do(spark, index, many):
    part = F.pmod(F.xxhash64("name"), F.lit(2))
    for batch in range(2):
        textindex.append_documents(many.where(part == batch), index, batch, buckets=8, block_docs=10)
    for terms, k, most in (
        (["rare"], 1, 1.0), (["hot", "w1", "w7", "none"], 1000, 1.0), (["w3", "rare", "hot", "w3"], 1, 0.5),
        (["hot", "w1"], 7, 1.0), (["none"], 3, 0.0), ([], 3, 0.0),
    ):
        query = spark.createDataFrame([(t,) for t in terms], "term string")
        scored = []
        got = textindex.search(spark, index, query, k, scored)
        assert ranked(got, k) == ranked(textsim.score_documents(many, query), k)
        assert scored[0] <= scored[1] * most


def test_a_query_reads_its_buckets_only(spark, index, many, executed_plans):
    textindex.append_documents(many, index, 0, buckets=8)
    query = spark.createDataFrame([("rare",)], "term string")
    ran = executed_plans(lambda: textindex.search(spark, index, query, 3).collect())
    reads = [line for plan in ran for line in plan.split("\n") if "PartitionFilters" in line and "bucket" in line]
    assert reads and all("bucket" in line and (" IN " in line or "=" in line) for line in reads)
    # The maxima are read without the entries.
    assert any("ReadSchema: struct<term:string,block:bigint,docs:bigint,max_tf:double>" in plan for plan in ran)


def test_batches_are_replaced_and_known_names_passed_over(spark, index, rows):
    docs = lambda *made: spark.createDataFrame(made, "name string, words array<string>")
    first = docs(("a", ["x", "y"]), ("b", ["x"]), ("b", ["z"]), (None, ["x"]), ("e", []), ("n", None))
    textindex.append_documents(first, index, 0, buckets=4)
    second = docs(("a", ["x"] * 9), ("c", ["z", "z", None]))
    for _ in range(2):  # the second time replaces the first
        textindex.append_documents(second, index, 1, buckets=99)
    query = spark.createDataFrame([("x",), ("z",), (None,)], "term string")
    whole = docs(("a", ["x", "y"]), ("b", ["x", "z"]), ("e", []), ("n", []), ("c", ["z", "z", None]))
    want = textsim.score_documents(whole, query)
    assert ranked(textindex.search(spark, index, query, 9), 9) == ranked(want, 9)
    # A batch that broke off before its last table is not seen.
    docs(("q", ["x"])).select("name").write.parquet(f"{index}/names/batch=7")
    assert ranked(textindex.search(spark, index, query, 9), 9) == ranked(want, 9)
    textindex.append_documents(docs(("q", ["x"])), index, 7)
    assert "q" in [r.name for r in textindex.search(spark, index, query, 9).collect()]


def test_an_empty_index_finds_nothing(spark, index, many):
    query = spark.createDataFrame([("x",)], "term string")
    assert textindex.search(spark, index, query, 5).count() == 0
    textindex.append_documents(many.limit(0), index, 0)
    assert textindex.search(spark, index, query, 5).count() == 0


def test_texts_are_shuffled_once_and_words_not(spark, plan_of):
    docs = spark.createDataFrame([("a", ["x", "y", "x"]), ("a", ["y"]), ("b", []), ("c", ["", None])], "name string, words array<string>")
    weights = textsim.tf_weight(docs)
    got = {(r.name, r.term): (r.cnt, r.total) for r in weights.collect()}
    assert got == {("a", "x"): (2, 4), ("a", "y"): (2, 4), ("c", ""): (1, 2), ("c", None): (1, 2)}
    plan = plan_of(textsim.tf_weight(docs))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate") < plan.index("Exchange hashpartitioning")
