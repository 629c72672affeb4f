"""The registered queries opN_<name> of this subpackage, with SQL answers where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bag_search, exact_dedup, html_extract, jaccard_join, kneser_ney, langid, license_rules, license_scan, mixing, ordinal, packing, topk, urls, vector_codes,
)
from .common import crc_remainder, register, table

DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256,
                  length(coalesce(text, '')) AS n FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
"""


@register("op8_exact_dedup", DEDUP_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    with exact_dedup.scratch_index(spark) as index:
        return exact_dedup.exact_dedup(table(spark, folder, "documents"), index)


MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS shuffled FROM documents),
sources AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source IS NULL, source) AS nth
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source)),
weighed AS (SELECT *, (nth - 1) % 3 + 1 AS weight FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::BIGINT AS words,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS shares,
         row_number() OVER (ORDER BY source_size::DOUBLE / weight, nth) AS place
  FROM weighed WINDOW before AS (ORDER BY source_size::DOUBLE / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fulls AS (SELECT *, words * weight >= 3 * source_size * shares AS is_full FROM levels),
targets AS (
  SELECT source, nth, source_size,
         CASE WHEN is_full THEN (3 * source_size)::DOUBLE
              ELSE weight::DOUBLE * first_words::DOUBLE / first_shares::DOUBLE END AS target
  FROM fulls LEFT JOIN (SELECT words AS first_words, shares AS first_shares FROM fulls
                        WHERE place = (SELECT count(*) FILTER (is_full) FROM fulls) + 1) ON true),
cut AS (SELECT *, greatest(1, least(2048, source_size // 1024))::BIGINT AS block_words FROM targets WHERE source_size > 0),
counted AS (
  SELECT *, (source_size + block_words - 1) // block_words AS blocks, floor(target / source_size)::BIGINT AS rounds FROM cut),
slotted AS (
  SELECT *, least(rounds * blocks + floor((target - (rounds * source_size)::DOUBLE) / block_words + 0.5)::BIGINT, 3 * blocks) AS slots
  FROM counted),
plan AS (SELECT *, (sum(slots) OVER (ORDER BY nth))::BIGINT AS high, (sum(slots) OVER ())::BIGINT AS points FROM slotted),
points AS (SELECT nth, blocks, bin(points) AS width, unnest(range(high - slots, high)) AS point FROM plan),
ranked AS (
  SELECT nth, blocks, row_number() OVER (PARTITION BY nth ORDER BY reverse(lpad(bin(point), length(width)::INTEGER, '0'))) - 1 AS rank FROM points),
times AS (SELECT nth, rank % blocks AS block, count(*) AS times FROM ranked GROUP BY ALL),
placed AS (
  SELECT s.*, p.nth, p.block_words, p.target, p.source_size,
         (coalesce(sum(size) OVER (PARTITION BY p.nth ORDER BY shuffled, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS ahead
  FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source WHERE size > 0),
pieces AS (SELECT *, unnest(range(ahead // block_words, (ahead + size - 1) // block_words + 1)) AS block FROM placed)
SELECT doc_id, size, source_size, target,
       sum((least(ahead + size, (block + 1) * block_words) - greatest(ahead, block * block_words)) * coalesce(times, 0))::BIGINT AS taken
FROM pieces LEFT JOIN times USING (nth, block) GROUP BY nth, ahead, doc_id, size, source_size, target
UNION ALL
SELECT doc_id, size, source_size, target, 0::BIGINT FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source WHERE size = 0
"""


@register("op6_mixing", MIX_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op1_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@register("op3_langid")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc_remainder("doc_id", 5) == 0
    found = langid.predict(docs, langid.train(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op5_topk")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return topk.exact_topk(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


RULES = [
    urls.Rule("allow", "com"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"),
]


@register("op7_urls")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), RULES)


@register("op9_html")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


@register("op10_quality")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = ordinal.train(docs, ordinal.quality_ratings(table(spark, folder, "labels")), grades=3)
    return docs.select("doc_id", ordinal.graded(model, F.col("text")).alias("grade")).select("doc_id", "grade.*")


@register("op2_language_model")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc_remainder("doc_id", 10) == 0
    return kneser_ney.score(docs, kneser_ney.train(docs.filter(~held_out)), held_out)


@register("op4_jaccard_join")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, folder, "documents"))


def _values(rules: list[license_rules.Rule]) -> str:
    return ", ".join(f"({i}, {r.priority}, '{r.label}', ' {r.keyword} ', '{license_rules.pattern_of(r)}', {r.base})" for i, r in enumerate(rules))


LICENSE_SQL = r"""
WITH rules(rule, priority, label, keyword, pattern, base) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_replace(' ' || translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || ' ', '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g') AS s
      FROM documents),
m AS (SELECT rid, rule, priority, label, base, regexp_extract_all(s, pattern) AS ms, string_split_regex(s, pattern) AS gaps
      FROM d JOIN rules ON contains(s, keyword) WHERE regexp_matches(s, pattern)),
n AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m),
found AS (
  SELECT rid, rule, priority, label, base,
         list_sum(list_transform(gaps[1:i], lambda x: (len(x) - len(replace(x, ' ', ''))) // 2)) + list_sum(list_transform(ms[1:i], lambda x: (len(x) - len(replace(x, ' ', ''))) // 2)) AS after,
         (len(ms[i]) - len(replace(ms[i], ' ', ''))) // 2 AS width FROM n),
placed AS (SELECT *, (after - width)::BIGINT AS first FROM found),
kept AS (
  SELECT * FROM placed d WHERE NOT EXISTS (
    SELECT 1 FROM placed e WHERE e.rid = d.rid AND e.first <= d.first AND e.after >= d.after AND e.priority <= d.priority
      AND (e.after - e.first > d.after - d.first OR e.priority < d.priority OR e.rule < d.rule))),
bases AS (SELECT rid, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
          FROM placed WHERE base GROUP BY rid),
named AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT rid, label FROM placed WHERE base UNION ALL SELECT rid, label FROM kept WHERE priority < 9) GROUP BY rid),
others AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM kept GROUP BY rid),
best AS (SELECT rid, min(priority) AS priority FROM kept GROUP BY rid)
SELECT doc_id, ((len(s) - len(replace(s, ' ', ''))) // 2 - 1)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(named.labels, others.labels, '') AS labels,
       CASE priority WHEN 1 THEN 1.0 WHEN 2 THEN 0.95 WHEN 3 THEN 0.8 WHEN 9 THEN 0.3 ELSE 0.0 END::DOUBLE AS score
FROM d LEFT JOIN bases USING (rid) LEFT JOIN named USING (rid) LEFT JOIN others USING (rid) LEFT JOIN best USING (rid)
""".replace("{rules}", _values(license_rules.RULES))


@register("op11_licenses", LICENSE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(table(spark, folder, "documents")))


SEARCH_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
sized AS (SELECT rid, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM sized),
tf AS MATERIALIZED (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) GROUP BY rid, term),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, totals GROUP BY term, nd),
norms AS (SELECT rid, doc_id, 75 + (25 * n * nd) // l AS m FROM sized, totals),
i AS (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
asked AS (SELECT iid, item_id, term, count(*) AS times FROM (SELECT iid, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
scores AS (
  SELECT iid, item_id, rid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN norms USING (rid) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
QUALIFY rank <= 20
"""


@register("op12_lexical_search", SEARCH_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return bag_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    nearest = """a{k} AS MATERIALIZED (
  SELECT rid, pos, part, arg_min(entry, dist * 16 + entry) AS entry, min(dist) AS dist
  FROM (SELECT p.rid, p.pos, p.part, b.entry, list_sum(list_transform(range(1, len(p.part) + 1), lambda i: (p.part[i] - b.part[i]) * (p.part[i] - b.part[i])))::BIGINT AS dist
        FROM p JOIN b{k} b USING (pos)) GROUP BY rid, pos, part)"""
    means = """s{k} AS (SELECT pos, entry, list(mean ORDER BY j) AS part FROM (
    SELECT pos, entry, j, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
    FROM (SELECT pos, entry, unnest(part) AS x, generate_subscripts(part, 1) AS j FROM a{k}) GROUP BY pos, entry, j) GROUP BY pos, entry),
b{next} AS MATERIALIZED (SELECT b.pos, b.entry, coalesce(s.part, b.part) AS part FROM b{k} b LEFT JOIN s{k} s USING (pos, entry))"""
    steps = [s.format(k=k, next=k + 1) for k in range(rounds) for s in (nearest, means)] + [nearest.format(k=rounds)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT rid, pos, q[pos * (len(q) // 8) + 1 : (pos + 1) * (len(q) // 8)] AS part FROM v, range(8) r(pos)),
start AS (SELECT row_number() OVER (ORDER BY vec_id, q) - 1 AS entry, rid FROM v QUALIFY entry < 16),
b0 AS MATERIALIZED (SELECT pos, entry, part FROM start JOIN p USING (rid)),
{", ".join(steps)},
coded AS (SELECT rid, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY pos) AS code, sum(dist)::BIGINT AS error FROM a{rounds} GROUP BY rid)
SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, entry)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN v USING (rid)
"""


@register("op13_vector_codes", _codes_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))
