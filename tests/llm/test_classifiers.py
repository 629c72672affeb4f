import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logtide.llm import langid, ordinal
from logtide.llm.words import mix, word_hashes


def labelled(data):
    docs = pd.read_parquet(f"{data}/documents.parquet")
    return docs.merge(pd.read_parquet(f"{data}/labels.parquet"), on="doc_id")


SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def rated():
    rows = labelled(SF).drop_duplicates("text")
    rows["grade"] = np.where(rows["toxic"] == 1, 0, np.where(rows["quality"] == 0, 1, 2))
    return rows.sort_values("doc_id").reset_index(drop=True)


def test_quality_on_held_out_documents(rated):
    learn, test = rated[rated["doc_id"] % 4 != 0], rated[rated["doc_id"] % 4 == 0]
    model = ordinal.fit(*ordinal.features(list(learn["text"])), learn["grade"].to_numpy(), 3)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(list(test["text"]))
    assert (np.diff(tails, axis=1) <= 0).all()
    kept = tails[:, 1] >= 0.5
    grade = test["grade"].to_numpy()
    assert kept[grade == 2].mean() > 0.98
    assert kept[grade == 0].mean() < 0.2 and kept[grade == 1].mean() < 0.2


def test_gradient_raises_the_likelihood_of_ordered_grades():
    texts = ["bad " * 5 + f"x{i}" for i in range(30)] + ["middling " * 5 + f"y{i}" for i in range(30)] + ["good " * 5 + f"z{i}" for i in range(30)]
    grade = np.repeat([0, 1, 2], 30)
    model = ordinal.fit(*ordinal.features(texts), grade, 3)
    expected = model.tails(texts).sum(axis=1)
    assert expected[:30].max() < 0.5 and 0.6 < expected[30:60].mean() < 1.4 and expected[60:].min() > 1.5


def test_shapes_of_words():
    assert ordinal.shaped("Hello WORLD 123, a|b!!") == "Aa A 0, a|a!!"
    assert ordinal.shaped("") == ""


def test_quality_of_odd_rows(spark, documents):
    docs = documents(None, "", " \n", "word", "w " * 60_000, (7, "dup", "en", "s"), (7, "dup", "en", "s"), (None, "no id", None, None))
    ratings = spark.createDataFrame([(3, 2), (3, 0), (4, None), (None, 1), (7, 2)], "doc_id long, grade int")
    model = ordinal.train(docs, ratings, 3)
    got = docs.select("doc_id", "text", ordinal.graded(model, F.col("text")).alias("g")).collect()
    assert len(got) == 8
    for r in got:
        assert 0 <= r.g.tail <= 1 and 0 <= r.g.expected_grade <= 2
        if not (r.text or "").strip():
            assert (r.g.expected_grade, r.g.tail, r.g.selected) == (0.0, 0.0, False)
    unrated = ordinal.train(docs, ratings.limit(0), 3)
    kept = ordinal.select_documents(docs, unrated)
    assert kept.columns == docs.columns and kept.count() == 5
    assert ordinal.select_documents(docs.limit(0), unrated).count() == 0


def test_sample_has_one_row_per_id(spark, documents):
    docs = documents(*[(i // 3, f"text {i}", "en", "s") for i in range(30)])
    ratings = spark.range(10).select(F.col("id").alias("doc_id"), F.lit(1).alias("grade"))
    rows = ordinal.rated_sample(docs, ratings).collect()
    assert sorted(r.doc_id for r in rows) == list(range(10))


def test_ratings_from_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 0, 1), (5, None, 0), (6, 0, None), (7, None, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.grade for r in ordinal.quality_ratings(labels).collect()}
    assert got == {1: 2, 2: 0, 3: 1, 4: 0, 5: None, 6: 1, 7: 0}


ODD_TEXTS = ["", " \n", "One word", "The THE the 12 3.4 x-y!", "naïve Ünïcode 日本 日本 a b c", "same " * 300, "Mixed CASE 99 lines\n" * 40, "unseen zebra"]


def plain_tails(model, text):
    """One text by dictionaries: its features, their log counts at unit length, one sigmoid per threshold."""

    def spaced(t):
        return re.findall(r"[^\x20\x09-\x0D]+", t)

    def key(number):
        return int(np.asarray(number, np.uint64).ravel()[0]) & ((1 << ordinal.BITS) - 1)

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = spaced(lowered)
    if not words:
        return [0.0] * len(model.thresholds)
    found = [key(word_hashes([w])[0]) for w in words]
    found += [key(mix(word_hashes([w], prefix=ordinal.PREFIX)[0] + np.uint64(2))) for w in words]
    shape = re.sub(r"0+", "0", re.sub(r"a+", "a", re.sub(r"A+", "A", re.sub(r"[0-9]", "0", "".join(
        "A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" or ord(c) > 127 else c for c in text)))))
    found += [key(mix(word_hashes([w])[0] + np.uint64(1))) for w in spaced(shape)]
    tenths, size = 10 * len(set(words)) // len(words), math.floor(2 * math.log2(len(words)))
    found += [key(mix(np.array([7 + tenths], np.uint64))), key(mix(np.array([1007 + tenths + 64 * size], np.uint64)))]
    known = {k: math.log1p(n) for k, n in Counter(found).items() if not math.isnan(model.weights[k])}
    length = math.sqrt(sum(v * v for v in known.values()))
    score = sum(float(model.weights[k]) * v / length for k, v in known.items()) if known else 0.0
    return [1 / (1 + math.exp(-min(max(score - t, -40), 40))) for t in model.thresholds]


def test_tails_equal_the_plain_ones(spark, documents, rated):
    some = rated.head(600)
    model = ordinal.fit(*ordinal.features(list(some["text"])), some["grade"].to_numpy(), 3)
    model.weights = model.weights.astype(np.float32)
    texts = [*ODD_TEXTS, *rated["text"].iloc[600:640]]
    expected = {i: plain_tails(model, t) for i, t in enumerate(texts)}
    got = documents(*texts).select("doc_id", ordinal.graded(model, F.col("text")).alias("g")).collect()
    assert len(got) == len(texts)
    for r in got:
        plain = expected[r.doc_id]
        assert (r.g.expected_grade, r.g.tail) == pytest.approx((sum(plain), plain[-1]), abs=1e-9)
        assert r.g.selected == (r.g.tail >= ordinal.KEEP_AT)


def test_first_step_follows_the_gradient_of_the_likelihood():
    texts = [f"bad worse b{i % 7}" for i in range(20)] + [f"so so m{i % 5}" for i in range(30)] + [f"good better b{i % 7}" for i in range(40)]
    grade = np.repeat([0, 1, 2], [20, 30, 40])
    model = ordinal.fit(*ordinal.features(texts), grade, 3, epochs=1, rate=1.0, batch=1000, seldom=1)
    used = np.flatnonzero(~np.isnan(model.weights))
    zero = np.where(np.isnan(model.weights), np.nan, 0.0)
    # At weights of 0 the thresholds already fit the shares of the grades, so the step leaves them.
    assert model.thresholds == pytest.approx([-math.log(70 / 20), -math.log(40 / 50)], abs=1e-6)

    def likelihood(weights):
        tails = np.column_stack([np.ones(90), ordinal.Model(weights, model.thresholds).tails(texts), np.zeros(90)])
        i = np.arange(90)
        return np.log(tails[i, grade] - tails[i, grade + 1]).mean()

    for f in used:
        step = np.zeros(len(zero))
        step[f] = 1e-5
        slope = (likelihood(zero + step) - likelihood(zero - step)) / 2e-5
        # The first adaptive step is g / sqrt(g^2 + 1e-8).
        assert model.weights[f] == pytest.approx(slope / math.sqrt(slope * slope + 1e-8), abs=1e-4)


def test_windows_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 509, 3000):
        text = "".join(chr(97 + i * 7 % 26) for i in range(n))
        w = langid.windows(text)
        step = langid.WINDOW - langid.OVERLAP
        joined = b"".join(bytes(x[:step]) for x in w) + bytes(w[-1][step:])
        assert joined.rstrip(b" ").decode() == text


def test_pooled_responses_equal_the_plain_ones():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    net = langid.fit(x, np.array([0, 1, 0, 1, 0]), ["a", "b"], epochs=1)
    assert np.allclose(net._pooled(x), net.responses(x)[1], atol=1e-5)


def plain_language(net, text):
    """Mean over the windows of one text, each by loops over its places and filters."""
    data = text.lower().encode("utf-8", "surrogatepass")
    step = langid.WINDOW - langid.OVERLAP
    starts = range(0, max(len(data) - langid.OVERLAP, 1), step)
    total = np.zeros(len(net.languages))
    for start in starts:
        window = data[start : start + langid.WINDOW].ljust(langid.WINDOW, b" ")
        tops = []
        for table in net.tables:
            places = range(langid.WINDOW - len(table) + 1)
            responses = [[sum(table[j][window[at + j]][f] for j in range(len(table))) for at in places] for f in range(langid.FILTERS)]
            tops += [max(r) for r in responses]
        z = np.array([max(t + b, 0) for t, b in zip(tops, net.bias)]) @ net.weights + net.offsets
        total += np.exp(z) / np.exp(z).sum()
    return total / len(starts)


def test_predictions_of_whole_texts_equal_the_plain_ones(spark, documents, monkeypatch):
    known = [("the quick brown fox and the dog", "en"), ("le renard brun et le chien", "fr"), ("der schnelle braune fuchs und der hund", "de")] * 4
    x = np.concatenate([langid.windows(t) for t, _ in known])
    languages = ["de", "en", "fr"]
    net = langid.fit(x, np.array([languages.index(lang) for _, lang in known]), languages, epochs=20)
    texts = ["Hello there", "a" * 253, "b" * 254, "le chien et " * 40, "Größe und Straße 日本 " * 30]
    expected = [plain_language(net, t) for t in texts]
    monkeypatch.setattr(langid, "_ROUND", 512)  # two windows at once: texts are cut over several rounds
    assert np.allclose(net.languages_of(texts), expected, atol=1e-5)
    got = {r.doc_id: r for r in langid.predict(documents(*texts), net).collect()}
    for i, p in enumerate(expected):
        assert got[i].lang_pred == languages[int(p.argmax())] and got[i].score == pytest.approx(p.max(), abs=1e-5)


def test_network_gradient_equals_differences():
    rng = np.random.default_rng(1)
    x, y = rng.integers(97, 123, (6, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])
    net = langid.fit(x, y, ["a", "b"], epochs=1)

    def loss():
        return -np.log(net.head(net.responses(x)[1])[1][np.arange(6), y]).mean()

    _, tops = net.responses(x)
    hidden, p = net.head(tops)
    p[np.arange(6), y] -= 1
    grad = hidden.T @ (p / 6)
    before = loss()
    net.weights[3, 1] += 1e-6
    assert (loss() - before) / 1e-6 == pytest.approx(grad[3, 1], abs=1e-4)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 3000")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    net = langid.train(docs, ~held)
    got = langid.predict(docs, net).join(docs.select("doc_id", "lang"), "doc_id").filter(held).toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.98 and got["score"].between(0, 1).all()


def test_rare_languages_and_copies_are_sampled(spark):
    rows = [(f"common words number {i}", "en") for i in range(3000)] + [("a copy of one text", "en")] * 20_000 + [(f"seldom {i}", "xx") for i in range(6)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = {r.lang: r["count"] for r in langid.labelled_windows(docs, F.lit(True), sample=300, each=50).groupBy("lang").count().collect()}
    assert got["xx"] == 6 and 220 < got["en"] < 380


def test_rare_grades_are_sampled(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    ratings = docs.select("doc_id", F.when(F.col("doc_id") % 200 == 0, 0).otherwise(2).alias("grade"))
    got = {r.grade: r["count"] for r in ordinal.rated_sample(docs, ratings, sample=400, each=50).groupBy("grade").count().collect()}
    assert got[0] == 20 and 320 < got[2] < 480


def test_languages_of_odd_rows(spark, documents):
    docs = documents(None, "", "123 !!", (3, "hello there my friend", "en", "s"), (4, "bonjour mon ami", "fr", None), (5, "no label here", None, "s"), (None, "hello", "en", "s"), (3, "hello there my friend", "en", "s"), (8, "x" * 100_000, "en", "s"))
    rows = langid.predict(docs, langid.train(docs, F.lit(True))).collect()
    assert len(rows) == 9 and sum(r.lang_pred == "und" for r in rows) == 3
    assert all(r.lang_pred in ("en", "fr") and 0 <= r.score <= 1 or (r.lang_pred, r.score) == ("und", 0.0) for r in rows)
    nothing = langid.train(docs, F.lit(False))
    assert nothing is None and {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), None).count() == 0
