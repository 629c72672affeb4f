"""URL filters: host rules first, then naive Bayes over segmented host names and path words.

Runs of letters in a host are split into words by a unigram Viterbi search; the unigram
counts are those of all page titles and url words. Multinomial naive Bayes is trained on all
urls that a rule decides and scores the words of host and path. Counts, the substrings of
host names and the scores are joins and sums; Python only walks one name's substrings.

Defined results: a null url, or one without ``://``, has empty host and path and is judged
by the prior alone; no rule decides nothing, and without any decided url all are allowed; a
rule's path must be the start of the url's path as it stands; rows of equal url get equal
verdicts each; an empty table gives no rows. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_through

LONGEST_WORD = 63  # characters of a label of a host name at most, so no word of one is longer
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TITLE = r"(?is)<title\b[^>]*>([^<]*)"
_NAME = r"\p{L}+"
_PATH_WORD = r"[\p{L}]+|[0-9]+"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def url_columns(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path: what follows the first ``://``, up to ``/ ? #``, and on to ``? #``."""
    rest = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, rest, 1), F.lit(""))
    return F.translate(host, _UPPER, _LOWER), F.coalesce(F.regexp_extract(url, rest, 2), F.lit(""))


def longest_rule(rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits ``host`` and ``path``; null where none does."""
    text, verdict = [], []
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        host = F.col("host")
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        text.append(F.when(fits, rule.text))
        verdict.append(F.when(fits, rule.verdict))
    none = F.lit(None).cast("string")
    return F.coalesce(*text, none), F.coalesce(*verdict, none)


def path_words() -> Column:
    """Words of the path, digits of a number as one sign per length."""
    return F.transform(
        F.regexp_extract_all(F.lower("path"), F.lit(_PATH_WORD), F.lit(0)),
        lambda w: F.concat(F.lit("/"), F.regexp_replace(w, "[0-9]", "0")),
    )


def lexicon(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """word, n: how often each word of at most LONGEST_WORD letters occurs in page titles and urls."""
    names = lambda c: F.explode(F.regexp_extract_all(F.lower(c), F.lit(_NAME), F.lit(0))).alias("word")
    titles = pages.select(names(F.regexp_extract("html", _TITLE, 1)))
    spoken = urls.select(names(F.col("path")))
    return titles.unionAll(spoken).filter(F.char_length("word") <= LONGEST_WORD).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def split_name(length: int, found: list[tuple[int, int, int]], total: int) -> list[tuple[int, int]]:
    """Most probable split of a name of ``length`` letters, as (start, length) of its words.

    ``found`` holds (start, length, count) of its substrings in the lexicon. A stretch that
    is no word has probability 10 / (total * 10^length).
    """
    ends: dict[int, list[tuple[int, float]]] = {}
    for start, n, count in found:
        ends.setdefault(start + n, []).append((n, math.log10(count / total)))
    best, back = [0.0] + [-math.inf] * length, [0] * (length + 1)
    unknown = 1 - math.log10(max(total, 1))
    for end in range(1, length + 1):
        known = dict(ends.get(end, []))
        for n in range(1, min(end, LONGEST_WORD) + 1):
            score = best[end - n] + known.get(n, unknown - n)
            if score > best[end]:
                best[end], back[end] = score, n
    out, end = [], length
    while end:
        out.append((end - back[end], back[end]))
        end -= back[end]
    return out[::-1]


def segmented_names(names: DataFrame, words: DataFrame) -> DataFrame:
    """name, words: the split of each distinct name. A name's substrings meet the lexicon in a join."""
    total = words.agg(F.sum("n")).first()[0] or 1
    at = F.sequence(F.lit(1), F.char_length("name"))
    size = F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.char_length("name") - F.col("start") + 1))
    parts = (
        names.select("name", F.explode(at).alias("start")).select("name", "start", F.explode(size).alias("size"))
        .withColumn("word", F.substring("name", F.col("start"), F.col("size")))
    )
    found = parts.join(words, "word").groupBy("name").agg(
        F.collect_list(F.struct((F.col("start") - 1).alias("start"), "size", "n")).alias("found"))

    @F.pandas_udf("array<string>")
    def split(name: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([
            [text[a : a + n] for a, n in split_name(len(text), [(f["start"], f["size"], f["n"]) for f in (parts if parts is not None else [])], total)]
            for text, parts in zip(name, found)])

    return names.join(found, "name", "left").select("name", split("name", "found").alias("words"))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, log_odds of block (null where a rule decides)."""
    host, path = url_columns()
    rule, verdict = longest_rule(rules)
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumns({"rule": rule, "ruled": verdict})
    # One row per distinct url from here on: copies of a url, however many, are counted before any join.
    urls = write_through(rows.groupBy("host", "path", "ruled").agg(F.count(F.lit(1)).alias("n")), "urls")
    words = write_through(lexicon(pages, urls), "lexicon")
    hosts = urls.select("host").distinct().withColumn("name", F.explode(F.regexp_extract_all("host", F.lit(_NAME), F.lit(0))))
    split = segmented_names(hosts.select("name").distinct(), words)
    host_words = write_through(hosts.join(split, "name").select("host", F.explode("words").alias("word")), "host_words")
    url_words = urls.select("host", "path", "ruled", "n", F.explode(path_words()).alias("word"))

    blocked = F.sum(F.when(F.col("ruled") == "block", F.col("n")).otherwise(0))
    allowed = F.sum(F.when(F.col("ruled") == "allow", F.col("n")).otherwise(0))
    decided = urls.filter(F.col("ruled").isNotNull())
    per_host = decided.groupBy("host", "ruled").agg(F.sum("n").alias("n"))
    seen = host_words.join(per_host, "host").select("word", "ruled", "n").unionAll(
        url_words.filter(F.col("ruled").isNotNull()).select("word", "ruled", "n"))
    counts = write_through(seen.groupBy("word").agg(blocked.alias("blocked"), allowed.alias("allowed")), "counts")
    size = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("blocked"), F.lit(0)), F.coalesce(F.sum("allowed"), F.lit(0))).first()
    prior = decided.agg(F.coalesce(blocked, F.lit(0)), F.coalesce(allowed, F.lit(0))).first()
    if not prior[0] or not prior[1]:
        base, weights = (math.inf if prior[0] else -math.inf), counts.select("word", F.lit(0.0).alias("weight"))
    else:
        base = math.log(prior[0] / prior[1])
        shift = math.log((size[2] + size[0]) / (size[1] + size[0]))
        weights = counts.select("word", (F.log((F.col("blocked") + 1) / (F.col("allowed") + 1)) + shift).alias("weight"))

    open_urls = urls.filter(F.col("ruled").isNull()).select("host", "path")
    of_host = host_words.join(weights, "word").groupBy("host").agg(F.sum("weight").alias("host_weight"))
    open_words = url_words.filter(F.col("ruled").isNull()).select("host", "path", "word")
    of_path = open_words.join(weights, "word").groupBy("host", "path").agg(F.sum("weight").alias("path_weight"))
    none = F.lit(0.0)
    scores = write_through(
        open_urls.join(of_path, ["host", "path"], "left").join(of_host, "host", "left").select(
            F.col("host").alias("_host"), F.col("path").alias("_path"),
            (F.lit(base) + F.coalesce("path_weight", none) + F.coalesce("host_weight", none)).alias("log_odds")), "scores")
    same = (rows["host"] == scores["_host"]) & (rows["path"] == scores["_path"])
    return rows.join(scores, same, "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("log_odds") > 0, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("ruled").isNull(), F.col("log_odds")).alias("log_odds"))
