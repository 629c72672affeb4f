"""Aggregations, numbering, sorting and set operations."""

from pyspark.sql import functions as F

from ..operators import numbering, parsers, rollups, setops
from .inputs import DAY_START, Inputs
from .registry import register

MEDIA_MINUTE_SQL = """
    SELECT m.domain AS domain, c.userid AS userid, m.timestamp AS timestamp, CAST(sum(m.cs) AS BIGINT) AS cs
    FROM (SELECT {DOMAIN} AS domain, {CS} AS cs, CAST({SEC} // 60 * 60 AS VARCHAR) AS timestamp
          FROM events WHERE event_id % 11 <> 0 AND event_type = 'click') m
    LEFT JOIN {CHANNEL} c ON m.domain = c.domain GROUP BY ALL"""


@register("media_traffic_minute", MEDIA_MINUTE_SQL)
def media_traffic_minute(inputs: Inputs):
    return rollups.media_traffic_minute(
        parsers.parse_media_log(inputs.media_log(), only="publish"), inputs.channels()
    )


@register("dir_traffic_minute", """
    SELECT concat('d', user_id % 4, '.example.com') AS domain, event_type AS dir1,
      concat('a', event_id % 3) AS dir2, {SEC} // 60 * 60 AS timestamp, CAST(sum({CS}) AS BIGINT) AS cs
    FROM events WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0 GROUP BY ALL""")
def dir_traffic_minute(inputs: Inputs):
    return rollups.dir_traffic_minute(parsers.parse_access_log(inputs.access_log()))


@register("pno_traffic_5min", """
    SELECT {DOMAIN} AS domain, concat('p', event_id % 5) AS pno,
      CAST((1704067200 + {EPOCH} % 21600) // 300 * 300 + 300 AS VARCHAR) AS timestamp,
      '2024010100' AS write_time, CAST(sum({CS}) AS BIGINT) AS cs FROM events GROUP BY ALL""")
def pno_traffic_5min(inputs: Inputs):
    return rollups.pno_traffic_5min(inputs.pno_minute(), DAY_START, "2024010100")


@register("distinct_ids", """
    SELECT DISTINCT 'user' AS side, CAST("user" AS INTEGER) AS id FROM {RATING}
    UNION ALL SELECT DISTINCT 'item', CAST(item AS INTEGER) FROM {RATING}""")
def distinct_ids(inputs: Inputs):
    rated = parsers.parse_ratings(inputs.rating_txt())
    sides = [
        rollups.distinct_ids(rated, side).select(F.lit(side).alias("side"), F.col(side).alias("id"))
        for side in ("user", "item")
    ]
    return setops.union_streams(sides)


@register("batch_counts", """
    SELECT topic, partition_id, count(*) AS records, min(msg_offset) AS from_offset,
      max(msg_offset) + 1 AS until_offset FROM {MESSAGE} GROUP BY topic, partition_id""")
def batch_counts(inputs: Inputs):
    return rollups.batch_counts(inputs.message())


@register("dense_index", """
    SELECT word AS term, row_number() OVER (ORDER BY word) - 1 AS idx FROM (SELECT DISTINCT word FROM {WORDS})""")
def dense_index(inputs: Inputs):
    words = parsers.tokenize_tagged_docs(inputs.tagged_doc()).select(F.col("word").alias("term")).distinct()
    return numbering.dense_index(words, ["term"], "idx")


@register("unique_id", "SELECT count(*) AS docs, count(*) AS ids, true AS every_doc_has_one FROM documents")
def unique_id(inputs: Inputs):
    numbered = numbering.unique_id(parsers.split_tagged_docs(inputs.tagged_doc()).select("name"), "uid")
    return numbered.agg(
        F.count("*").alias("docs"),
        F.countDistinct("uid").alias("ids"),
        F.every(F.col("uid").isNotNull()).alias("every_doc_has_one"),
    )


SCORES_SQL = """
    (SELECT o_custkey AS "user", l_partkey AS item, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS score
     FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)"""


def _scores(inputs: Inputs):
    bought = inputs.table("orders").join(inputs.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return bought.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("score")
    )


@register("rank_per_user", f"""
    SELECT "user", item, score, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank
    FROM {SCORES_SQL}""")
def rank_per_user(inputs: Inputs):
    return numbering.rank_per_user(_scores(inputs))


@register("top_k_per_key", f"""
    SELECT * FROM (SELECT "user", item, score, CAST(row_number() OVER (PARTITION BY "user"
      ORDER BY score DESC, item) AS INTEGER) AS rank FROM {SCORES_SQL}) WHERE rank <= 3""")
def top_k_per_key(inputs: Inputs):
    return numbering.top_k_per_key(_scores(inputs), 3, ["user"], [F.col("score").desc(), "item"])


@register("global_sort", """
    SELECT CAST("user" AS INTEGER) AS "user", CAST(item AS INTEGER) AS item, rate FROM {RATING}
    ORDER BY "user", item, rate""")
def global_sort(inputs: Inputs):
    return numbering.global_sort(parsers.parse_ratings(inputs.rating_txt()), "user", "item", "rate")


@register("take_n", """SELECT DISTINCT CAST("user" AS INTEGER) AS "user" FROM {RATING} ORDER BY "user" LIMIT 5""")
def take_n(inputs: Inputs):
    users = rollups.distinct_ids(parsers.parse_ratings(inputs.rating_txt()), "user")
    return numbering.take_n(users, 5, "user")


@register("top_k", f"""
    SELECT item, CAST(sum(score) AS BIGINT) AS score FROM {SCORES_SQL} GROUP BY item
    ORDER BY score DESC, item LIMIT 10""")
def top_k(inputs: Inputs):
    totals = inputs.table("lineitem").groupBy(F.col("l_partkey").alias("item")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("score")
    )
    return numbering.top_k(totals, 10, F.col("score").desc(), "item")


@register("union_streams", """
    SELECT 'media' AS source, {DOMAIN} AS domain, {CS} AS cs FROM events WHERE event_id % 11 <> 0
    UNION ALL
    SELECT 'access', concat('d', user_id % 4, '.example.com'), {CS} FROM events
    WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0""")
def union_streams(inputs: Inputs):
    media = parsers.parse_media_log(inputs.media_log()).select(F.lit("media").alias("source"), "domain", "cs")
    access = parsers.parse_access_log(inputs.access_log()).select("cs", F.lit("access").alias("source"), "domain")
    return setops.union_streams([media, access])


@register("set_difference", """
    SELECT o_custkey AS custkey FROM orders EXCEPT SELECT l_suppkey FROM lineitem""")
def set_difference(inputs: Inputs):
    customers = inputs.table("orders").select(F.col("o_custkey").alias("custkey"))
    suppliers = inputs.table("lineitem").select(F.col("l_suppkey").alias("custkey"))
    return setops.set_difference(customers, suppliers)
