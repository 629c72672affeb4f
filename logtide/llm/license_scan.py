"""License detection by ordered signature rules, in built-in Spark expressions only.

A text becomes its lower-case words, each between spaces of its own, so that no match needs a space of another. One pattern finds the
keywords that stand in it; only rules of these keywords are run. Every match is a detection:
an interval of words with the rule's label and priority. A detection is suppressed where
another one of the same or a better priority contains it; of equal intervals the better priority
stays, then the earlier rule. Generic rules (priority 9) name no license and count only
in texts without another label.

All of it happens within the row: there is no shuffle and no key. Texts of more than STRETCH
words are scanned in stretches, each with MARGIN words of its neighbours, so the work grows in
proportion to the text; a rule's matches are looked for from the left anew in every stretch.

Defined results: a null text counts as empty; a text without words has no detections; repeated
rows and ids are rows of their own; an empty table gives no rows; other columns are passed on
whatever their names are.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lowered, text_or_empty
from .license_rules import GENERIC, RULES, Rule, keyword_pattern, pattern_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STRETCH = 2048  # words scanned at once
MARGIN = 64  # words of both neighbours that a stretch sees; more than any rule matches

#: How sure a label is, by the best priority of its detections.
CONFIDENCE = {1: 1.0, 2: 0.95, 3: 0.8, GENERIC: 0.3}

DETECTION = "first:bigint,last:bigint,priority:int,rule:int,label:string,base:boolean,kept:boolean"


def spaced_words(text: Column) -> Column:
    """The words of a text, lower-case, each between spaces of its own, and a space at both ends: "  a  b  "."""
    return F.regexp_replace(F.concat(F.lit(" "), lowered(text), F.lit(" ")), SEPARATORS, "  ")


def words_before(part: Column) -> Column:
    """Words of a part of such a text that begins with it or after a word: half its spaces."""
    return F.floor((F.char_length(part) - F.char_length(F.replace(part, F.lit(" "), F.lit("")))) / 2)


def rule_table(rules: list[Rule] = RULES) -> Column:
    """The rules as one constant array; it has a fixed number of rows."""
    rows = [{"priority": r.priority, "rule": i, "label": r.label, "keyword": r.keyword, "pattern": pattern_of(r), "base": r.base} for i, r in enumerate(rules)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<priority:int,rule:int,label:string,keyword:string,pattern:string,base:boolean>>")


def stretches(spaced: Column, words: Column, n_words: Column) -> Column:
    """Every stretch of a text that holds a keyword: its number, the words before it, its text with margins, its keywords."""
    none = F.lit(0).cast("bigint")

    def cut(nth: Column) -> Column:
        before = F.greatest(nth * STRETCH - MARGIN, none)
        part = F.slice(words, (before + 1).cast("int"), (nth * STRETCH + STRETCH + MARGIN - before).cast("int"))
        return F.struct(nth.alias("nth"), before.alias("before"), F.concat(F.lit("  "), F.array_join(part, "  "), F.lit("  ")).alias("spaced"))

    def with_keywords(part: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(part.getField("spaced"), F.lit(keyword_pattern()), F.lit(1)))
        return F.struct(*[part.getField(name).alias(name) for name in ("nth", "before", "spaced")], found.alias("keywords"))

    whole = F.array(F.struct(none.alias("nth"), none.alias("before"), spaced.alias("spaced")))
    parts = F.when(n_words <= STRETCH, whole).otherwise(F.transform(F.sequence(none, F.floor((n_words - 1) / STRETCH)), cut))
    return F.filter(F.transform(parts, with_keywords), lambda part: F.size(part.getField("keywords")) > 0)


def places(stretch: Column, rule: Column) -> Column:
    """The matches of a rule in a stretch, as detections; text between and in matches tells the words before them."""
    spaced = stretch.getField("spaced")
    parts = F.arrays_zip(
        F.split(spaced, rule.getField("pattern"), -1).alias("gap"), F.regexp_extract_all(spaced, rule.getField("pattern"), F.lit(0)).alias("match"))

    def add(found: Column, part: Column) -> Column:
        first = found.getField("at") + words_before(part.getField("gap"))
        after = first + words_before(part.getField("match"))
        detection = F.struct(
            first.alias("first"), (-after).alias("minus_after"), rule.getField("priority").alias("priority"), rule.getField("rule").alias("rule"),
            rule.getField("label").alias("label"), rule.getField("base").alias("base"))
        return F.struct(after.alias("at"), F.concat(found.getField("out"), F.array(detection)).alias("out"))

    none = F.expr("cast(array() as array<struct<first:bigint,minus_after:bigint,priority:int,rule:int,label:string,base:boolean>>)")
    start = F.struct(stretch.getField("before").alias("at"), none.alias("out"))
    # The last gap has no match after it.
    return F.aggregate(F.filter(parts, lambda p: p.getField("match").isNotNull()), start, add, lambda found: found.getField("out"))


def resolved(detections: Column) -> Column:
    """Detections in order of their first word, longer ones first, each with ``kept``: no other one that is as strong contains it."""
    ordered = F.array_sort(detections)
    ends = [1, 2, 3, GENERIC]

    def add(state: Column, d: Column) -> Column:
        after, priority = -d.getField("minus_after"), d.getField("priority")
        # The furthest end so far of all detections up to each priority; they begin no later than this one.
        reached = F.coalesce(*[F.when(priority <= p, state.getField(f"end{p}")) for p in ends])
        new = F.struct(
            d.getField("first").alias("first"), (after - 1).alias("last"), priority.alias("priority"), d.getField("rule").alias("rule"),
            d.getField("label").alias("label"), d.getField("base").alias("base"), (after > reached).alias("kept"))
        return F.struct(
            *[F.when(priority <= p, F.greatest(state.getField(f"end{p}"), after)).otherwise(state.getField(f"end{p}")).alias(f"end{p}") for p in ends],
            F.concat(state.getField("out"), F.array(new)).alias("out"))

    start = F.struct(
        *[F.lit(-1).cast("bigint").alias(f"end{p}") for p in ends], F.expr(f"cast(array() as array<struct<{DETECTION}>>)").alias("out"))
    return F.aggregate(ordered, start, add, lambda state: state.getField("out"))


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Per row of ``docs``: the row as struct ``_row``, n_words, and ``detections``: all matches with label, first and last word, and whether they are kept."""
    if not {r.keyword for r in rules} <= {r.keyword for r in RULES}:
        raise ValueError("every rule needs a keyword of the prefilter")
    table = rule_table(rules)

    def detected(part: Column) -> Column:
        run = F.filter(table, lambda r: F.array_contains(part.getField("keywords"), r.getField("keyword")) & F.rlike(part.getField("spaced"), r.getField("pattern")))
        found = resolved(F.flatten(F.transform(run, lambda r: places(part, r))))
        own = part.getField("nth") * STRETCH
        return F.filter(found, lambda d: (d.getField("first") >= own) & (d.getField("first") < own + STRETCH))

    rows = docs.select(F.struct("*").alias("_row"), spaced_words(text_or_empty()).alias("_spaced"))
    rows = rows.withColumn("n_words", words_before(F.col("_spaced")) - 1)
    rows = rows.withColumn("_words", F.when(F.col("n_words") > STRETCH, F.split(F.trim("_spaced"), "  ")))
    rows = rows.select("_row", "n_words", stretches(F.col("_spaced"), F.col("_words"), F.col("n_words")).alias("_parts"))
    return rows.select("_row", "n_words", F.flatten(F.transform("_parts", detected)).alias("detections"))


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of scanned documents."""
    base = F.filter("detections", lambda d: d.getField("base"))
    kept = F.filter("detections", lambda d: d.getField("kept"))
    named = F.filter("_kept", lambda d: d.getField("priority") < GENERIC)
    labels = lambda found: F.array_distinct(F.transform(found, lambda d: d.getField("label")))
    strongest = F.array_min(F.transform("_kept", lambda d: d.getField("priority")))
    score = F.coalesce(*[F.when(strongest == p, F.lit(c)) for p, c in CONFIDENCE.items()], F.lit(0.0))
    rows = scanned.select("_row.doc_id", "n_words", base.alias("_base"), kept.alias("_kept"))
    rows = rows.withColumn("_named", F.array_union(labels(F.col("_base")), labels(named)))
    rows = rows.withColumn("_labels", F.when(F.size("_named") > 0, F.col("_named")).otherwise(labels(F.col("_kept"))))
    joined = lambda found: F.array_join(F.array_sort(found), ",")
    return rows.select(
        "doc_id", "n_words", F.size("_base").cast("long").alias("n_base"),
        F.array_min(F.transform("_base", lambda d: d.getField("first"))).alias("first_word"),
        F.array_max(F.transform("_base", lambda d: d.getField("first"))).alias("last_word"),
        joined(labels(F.col("_base"))).alias("base_labels"), joined(F.col("_labels")).alias("labels"), score.alias("score"))
