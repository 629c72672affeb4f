"""TF-IDF and query scores over the documents."""

from pyspark.sql import functions as F

from ..operators import parsers, textindex, textsim
from .inputs import Inputs
from .registry import register

TF_SQL = "(SELECT name, word AS term, count(*) AS cnt FROM {WORDS} GROUP BY ALL)"
DF_SQL = f"(SELECT term, count(*) AS df FROM {TF_SQL} GROUP BY term)"
SIZE_SQL = "(SELECT count(*) FROM documents)"


def _idf_sql(ratio: str) -> str:
    return f"(SELECT term, df, 1 + ln({ratio}) AS idf FROM {DF_SQL})"


def _tf_sql(ratio: str) -> str:
    return f"""(SELECT f.name AS name, f.term AS term, f.cnt AS cnt, t.total AS total, sqrt({ratio}) AS tf
      FROM {TF_SQL} f JOIN (SELECT name, count(*) AS total FROM {{WORDS}} GROUP BY name) t ON f.name = t.name)"""


IDF_SQL = _idf_sql(f"{SIZE_SQL} / df")
IDF_COMPAT_SQL = _idf_sql(f"{SIZE_SQL} // df")
TFW_SQL = _tf_sql("cnt / total")
TFW_COMPAT_SQL = _tf_sql("cnt // total")
ID_SQL = f"(SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM {DF_SQL})"


def _docs(inputs: Inputs):
    return parsers.split_tagged_docs(inputs.tagged_doc())


@register("term_frequency", f"SELECT name, term, cnt FROM {TF_SQL}")
def term_frequency(inputs: Inputs):
    return textsim.term_frequency(_docs(inputs))


@register("document_frequency", f"SELECT term, df FROM {DF_SQL}")
def document_frequency(inputs: Inputs):
    return textsim.document_frequency(textsim.term_frequency(_docs(inputs)))


@register("term_doc_counts", f"SELECT {SIZE_SQL} AS docs, count(*) AS terms FROM {DF_SQL}")
def term_doc_counts(inputs: Inputs):
    return textsim.term_doc_counts(_docs(inputs))


def _idf(inputs: Inputs, compat: bool):
    docs = _docs(inputs)
    weights = textsim.idf(docs, textsim.term_frequency(docs), compat)
    return weights.select("term", "df", F.round("idf", 6).alias("idf"))


@register("idf", f"SELECT term, df, round(idf, 6) AS idf FROM {IDF_SQL}")
def idf(inputs: Inputs):
    return _idf(inputs, compat=False)


@register("idf_compat", f"SELECT term, df, round(idf, 6) AS idf FROM {IDF_COMPAT_SQL}")
def idf_compat(inputs: Inputs):
    return _idf(inputs, compat=True)


def _tf_weight(inputs: Inputs, compat: bool):
    weights = textsim.tf_weight(_docs(inputs), compat)
    return weights.select("name", "term", "cnt", "total", F.round("tf", 6).alias("tf"))


@register("tf_weight", f"SELECT name, term, cnt, total, round(tf, 6) AS tf FROM {TFW_SQL}")
def tf_weight(inputs: Inputs):
    return _tf_weight(inputs, compat=False)


@register("tf_weight_compat", f"SELECT name, term, cnt, total, round(tf, 6) AS tf FROM {TFW_COMPAT_SQL}")
def tf_weight_compat(inputs: Inputs):
    return _tf_weight(inputs, compat=True)


@register("tfidf_vectors", f"""
    SELECT f.name AS name, i.term_id AS term_id, f.term AS term, round(f.tf, 6) AS tf, round(w.idf, 6) AS idf
    FROM {TFW_SQL} f JOIN {ID_SQL} i ON f.term = i.term JOIN {IDF_SQL} w ON f.term = w.term""")
def tfidf_vectors(inputs: Inputs):
    vectors = textsim.tfidf_vectors(_docs(inputs))
    return vectors.withColumns({"tf": F.round("tf", 6), "idf": F.round("idf", 6)})


SCORE_SQL = f"""
    WITH query AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS term FROM benchmark),
    size AS (SELECT count(*) AS n FROM query),
    norm AS (SELECT sqrt(sum(idf * idf)) AS n FROM {IDF_SQL} w JOIN query q ON w.term = q.term)
    SELECT f.name AS name, count(*) AS matched,
      round(sum(f.tf * w.idf * w.idf) / any_value(norm.n) * count(*) / any_value(size.n), {{DIGITS}}) AS score
    FROM {TFW_SQL} f JOIN query q ON f.term = q.term JOIN {IDF_SQL} w ON f.term = w.term, norm, size
    GROUP BY f.name"""


def _query(inputs: Inputs):
    return inputs.table("benchmark").select(F.explode(F.split("text", " ")).alias("term"))


@register("score_query", SCORE_SQL.replace("{DIGITS}", "6"))
def score_query(inputs: Inputs):
    scores = textsim.score_documents(_docs(inputs), _query(inputs))
    return scores.select("name", "matched", F.round("score", 6).alias("score"))


@register("index_search", f"""
    SELECT name, matched, score FROM ({SCORE_SQL.replace("{DIGITS}", "9")}) ORDER BY score DESC, name LIMIT 100""")
def index_search(inputs: Inputs):
    """The 100 best documents from a stored index of two batches."""
    root = inputs.new_folder("text-index")
    docs = _docs(inputs).withColumn("batch", F.pmod(F.xxhash64("name"), F.lit(2)))
    textindex.create_index(inputs.spark, root)
    for batch in (0, 1):
        textindex.append_documents(docs.where(F.col("batch") == batch), root, batch)
    return textindex.search(inputs.spark, root, _query(inputs), 100).withColumn("score", F.round("score", 9))
