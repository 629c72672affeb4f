"""TF-IDF over tokenised documents, and the score of a query against them.

Documents are rows of (name, words); rows of one name count as one document.
``compat=True`` divides counts as whole numbers, which makes most weights
degenerate (tf is 0 unless a document is one repeated word); the default
divides as real numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_through
from .lookups import lookup_join, term_lookup
from .numbering import dense_index


def term_frequency(docs: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """name, term, cnt: how often each word occurs in each document.

    With ``only`` (one row per ``term``) other words are left out before the count. Without it the texts are
    shuffled by name, not their words: a row per word takes several times the room of the word.
    """
    if only is None:
        docs = docs.select("name", "words").repartition("name")
    words = docs.select("name", F.explode("words").alias("term"))
    if only is not None:
        words = _only_terms(words, only)
    return words.groupBy("name", "term").agg(F.count("*").alias("cnt"))


def _only_terms(rows: DataFrame, only: DataFrame) -> DataFrame:
    """Rows whose term is listed in ``only``; the list is the side that may be broadcast."""
    return lookup_join(rows, only.select("term").distinct(), ["term"], "left_semi")


def document_frequency(frequencies: DataFrame) -> DataFrame:
    """term, df: in how many documents each word occurs (input: one row per name and term)."""
    return frequencies.groupBy("term").agg(F.count("*").alias("df"))


def term_doc_counts(docs: DataFrame) -> DataFrame:
    """One row: number of documents and of distinct words."""
    words = docs.select(F.explode("words").alias("term")).distinct().agg(F.count("*").alias("terms"))
    names = docs.select("name").distinct().agg(F.count("*"))
    return words.select(names.scalar().alias("docs"), "terms")


def _ratio(a: Column, b: Column, compat: bool) -> Column:
    quotient = a / b
    return F.floor(quotient).cast("double") if compat else quotient


def _idf(docs: Column, df: Column, compat: bool) -> Column:
    return F.lit(1.0) + F.ln(_ratio(docs, df, compat))


def _weighed(frequencies: DataFrame, documents: int, compat: bool) -> DataFrame:
    weight = _idf(F.lit(documents), F.col("df"), compat)
    return document_frequency(frequencies).select("term", "df", weight.alias("idf"))


def idf(docs: DataFrame, frequencies: DataFrame, compat: bool = False) -> DataFrame:
    """term, df, idf = 1 + ln(documents / df)."""
    names = docs.select("name").distinct().agg(F.count("*"))
    weight = _idf(names.scalar(), F.col("df"), compat)
    return document_frequency(frequencies).select("term", "df", weight.alias("idf"))


def document_lengths(docs: DataFrame) -> DataFrame:
    """name, total: words per document, from the unexploded rows."""
    return docs.groupBy("name").agg(F.sum(F.size("words")).cast("bigint").alias("total"))


def counts_with_totals(docs: DataFrame) -> DataFrame:
    """name, term, cnt, total: :func:`term_frequency` and the words of the document, where the counts lie."""
    return term_frequency(docs).withColumn("total", F.sum("cnt").over(Window.partitionBy("name")))


def tf_weight(
    docs: DataFrame, compat: bool = False, frequencies: DataFrame | None = None,
    lengths: DataFrame | None = None,
) -> DataFrame:
    """name, term, cnt, total, tf = sqrt(cnt / words in the document).

    Pass ``frequencies`` and ``lengths`` (name, total) where they have been computed already.
    """
    if frequencies is None and lengths is None:
        return _weights(counts_with_totals(docs), compat)
    counts = term_frequency(docs) if frequencies is None else frequencies
    if lengths is None:
        lengths = document_lengths(docs)
    return _weights(lookup_join(counts, lengths, ["name"], "inner"), compat)


def _weights(joined: DataFrame, compat: bool) -> DataFrame:
    weight = F.sqrt(_ratio(F.col("cnt"), F.col("total"), compat))
    named = joined.where(F.col("name").isNotNull())
    return named.select("name", "term", "cnt", "total", weight.alias("tf"))


def vocabulary(
    docs: DataFrame, compat: bool = False, frequencies: DataFrame | None = None
) -> DataFrame:
    """term, term_id (contiguous, by term), df, idf."""
    counts = term_frequency(docs) if frequencies is None else frequencies
    return dense_index(write_through(idf(docs, counts, compat), "terms"), ["term"], "term_id")


def tfidf_vectors(
    docs: DataFrame,
    compat: bool = False,
    terms: DataFrame | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Sparse vectors in long form: name, term_id, term, tf, idf.

    Neither the vocabulary nor the weights visit the driver. Word counts feed
    the vocabulary, the document lengths and the weights, so they are written once and
    the text is read once. Pass ``terms`` (from :func:`vocabulary`)
    to weigh new documents by earlier ones; ``only`` then limits the vectors to
    some terms, as a query needs them.
    """
    if terms is None:
        counts = write_through(counts_with_totals(docs), "word-counts")
        documents = counts.select("name").distinct().count()
        terms = dense_index(write_through(_weighed(counts, documents, compat), "terms"), ["term"], "term_id")
        weights = _weights(counts, compat)
    else:
        weights = tf_weight(docs, compat, term_frequency(docs, only))
        if only is not None:
            terms = _only_terms(terms, only)
    weighted = term_lookup(weights, terms.select("term", "term_id", "idf"))
    return weighted.select("name", "term_id", "term", "tf", "idf")


def score_query(vectors: DataFrame, query: DataFrame, terms: DataFrame) -> DataFrame:
    """name, matched, score of a query (one row per ``term``) against every document it touches.

    score = sum(tf * idf^2) / sqrt(sum of idf^2 over the query) * matched / query terms.
    Documents without any query term score 0 and are not listed.
    """
    wanted = query.select("term").distinct()
    weights = _only_terms(terms.select("term", "idf"), wanted)
    norm = weights.agg(F.sqrt(F.sum(F.col("idf") * F.col("idf")))).scalar()
    size = wanted.agg(F.count("*")).scalar()
    hits = _only_terms(vectors.select("name", "term", "tf", "idf"), wanted)
    matched = F.count(F.when(F.col("tf") > 0, True))
    sums = hits.groupBy("name").agg(
        matched.alias("matched"), F.sum(F.col("tf") * F.col("idf") * F.col("idf")).alias("_sum")
    )
    score = F.coalesce(F.try_divide(F.col("_sum"), norm), F.lit(0.0)) * F.col("matched") / size
    return sums.select("name", "matched", score.alias("score"))


def score_documents(docs: DataFrame, query: DataFrame, compat: bool = False) -> DataFrame:
    """:func:`score_query` straight from the documents: name, matched, score.

    Words are limited to the query's before anything is counted, so document frequencies,
    weights and the join with the lengths see only those; no vocabulary is numbered.
    """
    wanted = write_through(query.select("term").distinct(), "query")
    counts = write_through(term_frequency(docs, wanted), "query-counts")
    lengths = write_through(document_lengths(docs), "lengths")
    terms = write_through(_weighed(counts, lengths.count(), compat), "query-terms")
    weighted = tf_weight(docs, compat, counts, lengths)
    vectors = term_lookup(weighted, terms.select("term", "idf")).select("name", "term", "tf", "idf")
    return score_query(vectors, wanted, terms)
