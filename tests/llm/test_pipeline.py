"""The pipeline and the registered queries over the small tables."""

import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_answers import compare, connect
from logtide import llm
from logtide.llm.tokens import encoder
from logtide.session import write_through


@pytest.mark.parametrize("name", sorted(llm.oracles()))
def test_query_equals_its_sql(spark, data, name):
    result = compare(llm.queries()[name](spark, data), connect(data), llm.oracles()[name])
    assert result.startswith("ok") and not result.startswith("ok 0 "), result


def test_all_thirteen_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")} == set(range(1, 14))


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = write_through(stage(spark, docs, data), name)
        assert docs.columns == columns, name
        seen[name] = (before, docs)
        assert docs.select("doc_id", "text").exceptAll(before.select("doc_id", "text")).count() == 0 or name == "mixing"
    before, after = seen["exact_dedup"]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    texts = [norm(r.text) for r in after.collect()]
    assert len(texts) == len(set(texts)) == len({norm(r.text) for r in before.collect()})
    before, after = seen["mixing"]
    copies = Counter(r.doc_id for r in after.collect())
    assert max(copies.values()) <= 3 and set(copies) <= {r.doc_id for r in before.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
    tokens = Counter()
    for r in docs.collect():
        tokens[r.doc_id] += len(encoder().ids([r.text])[0]) // 4 + 1
    found = Counter()
    for r in packed:
        found[r.doc_id] += r.length
    assert found == tokens


def test_stages_stand_odd_documents(spark, data, documents):
    docs = documents(None, "", "plain words to keep", "plain words to keep", (None, "text without an id", None, None), (5, "x" * 30_000, None, "s"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data)
        assert out.count() >= 0
        assert name == "packing" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), data).count() == 0
