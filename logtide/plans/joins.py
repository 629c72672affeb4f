"""Dimension, range and rating joins."""

from pyspark.sql import functions as F

from ..operators import filters, ipranges, lookups, parsers, ratings, textsim, versions
from ..session import write_through
from .inputs import Inputs
from .registry import register


@register("attach_userid", """
    SELECT m.domain AS domain, c.userid AS userid, m.flag AS flag, m.cs AS cs, m.timestamp AS timestamp
    FROM (SELECT {DOMAIN} AS domain, {FLAG} AS flag, {CS} AS cs, CAST({SEC} // 60 * 60 AS VARCHAR) AS timestamp
          FROM events WHERE event_id % 11 <> 0) m LEFT JOIN {CHANNEL} c ON m.domain = c.domain""")
def attach_userid(inputs: Inputs):
    media = parsers.parse_media_log(inputs.media_log())
    return lookups.attach_userid(media, inputs.channels()).select("domain", "userid", "flag", "cs", "timestamp")


@register("domain_semi_join", """
    SELECT {DOMAIN} AS domain, concat('p', event_id % 5) AS pno, {CS} AS cs FROM events
    WHERE {DOMAIN} IN (SELECT domain FROM {CHANNEL} WHERE userid = '3038')""")
def domain_semi_join(inputs: Inputs):
    listed = filters.export_domains(inputs.channel_csv())
    return lookups.domain_semi_join(inputs.pno_minute(), listed).select("domain", "pno", "cs")


@register("domain_anti_join", """
    SELECT {DOMAIN} AS domain, concat('p', event_id % 5) AS pno, {CS} AS cs FROM events
    WHERE {DOMAIN} NOT IN (SELECT domain FROM {CHANNEL} WHERE userid = '3038')""")
def domain_anti_join(inputs: Inputs):
    listed = filters.export_domains(inputs.channel_csv())
    return lookups.domain_anti_join(inputs.pno_minute(), listed).select("domain", "pno", "cs")


def predictions(inputs: Inputs):
    """A supplied prediction per rated pair: the part's size, in the range of the ratings."""
    rated = parsers.parse_ratings(inputs.rating_txt())
    part = inputs.table("part").select(
        F.col("p_partkey").cast("int").alias("item"), (F.col("p_size") + F.lit(0.5)).alias("pred")
    )
    return rated.join(part, "item").select("user", "item", "pred")


PREDICTED_SQL = """
    (SELECT r."user" AS "user", r.item AS item, p_size + 0.5::DOUBLE AS pred
     FROM {RATING} r JOIN part ON item = p_partkey)"""


RATED_SQL = f"""
    SELECT CAST(r."user" AS INTEGER) AS "user", CAST(r.item AS INTEGER) AS item, r.rate AS rate,
      CAST(p.pred AS DOUBLE) AS pred, count(*) AS pairs
    FROM {{RATING}} r JOIN {PREDICTED_SQL} p ON r."user" = p."user" AND r.item = p.item GROUP BY ALL"""


@register("rating_prediction_join", RATED_SQL)
def rating_prediction_join(inputs: Inputs):
    return ratings.rating_prediction_join(parsers.parse_ratings(inputs.rating_txt()), predictions(inputs))


@register("stored_rating_join", RATED_SQL)
def stored_rating_join(inputs: Inputs):
    """The same join between tables bucketed by (user, item)."""
    buckets = int(inputs.spark.conf.get("spark.sql.shuffle.partitions"))
    rated = parsers.parse_ratings(inputs.rating_txt())
    with ratings.scratch_pairs(rated, "rate", buckets) as mine, ratings.scratch_pairs(predictions(inputs), "pred", buckets) as theirs:
        return write_through(ratings.stored_join(mine, theirs), "rated")


@register("mean_squared_error", f"""
    SELECT count(*) AS pairs, round(avg(pow(r.rate - p.pred, 2)), 6) AS mse
    FROM {{RATING}} r JOIN {PREDICTED_SQL} p ON r."user" = p."user" AND r.item = p.item""")
def mean_squared_error(inputs: Inputs):
    error = ratings.prediction_error(parsers.parse_ratings(inputs.rating_txt()), predictions(inputs))
    return error.select("pairs", F.round("mse", 6).alias("mse"))


@register("ip_to_company", """
    SELECT e.event_id AS event_id, e.ip AS ip, coalesce(s_name, 'none') AS company
    FROM (SELECT event_id, CASE WHEN event_id % 31 = 0 THEN 'bad.ip'
            ELSE concat('10.', user_id % 32, '.', event_id % 256, '.1') END AS ip,
          CASE WHEN event_id % 31 = 0 THEN -1
            ELSE 167772160 + (user_id % 32) * 65536 + (event_id % 256) * 256 + 1 END AS address FROM events) e
    LEFT JOIN supplier ON address BETWEEN 167772160 + s_suppkey * 65536 AND 167772160 + s_suppkey * 65536 + 51199""")
def ip_to_company(inputs: Inputs):
    named = ipranges.ip_to_company(inputs.ip_event(), inputs.ip_range())
    return named.select("event_id", "ip", F.coalesce("company", F.lit("none")).alias("company"))


@register("term_lookup", """
    SELECT w.name AS name, w.word AS term, v.term_id AS term_id FROM {WORDS} w
    JOIN (SELECT word, row_number() OVER (ORDER BY word) - 1 AS term_id FROM (SELECT DISTINCT word FROM {WORDS}))
      v ON w.word = v.word""")
def term_lookup(inputs: Inputs):
    docs = parsers.split_tagged_docs(inputs.tagged_doc())
    terms = docs.select("name", F.explode("words").alias("term"))
    known = textsim.vocabulary(docs).select("term", "term_id")
    return lookups.term_lookup(terms, known).select("name", "term", "term_id")


@register("as_of_userid", """
    SELECT e.event_id AS event_id, e.domain AS domain, e.cs AS cs, v.userid AS userid
    FROM (SELECT event_id, {DOMAIN} AS domain, {CS} AS cs, {MOMENT} AS moment FROM events) e
    ASOF LEFT JOIN (
      SELECT domain, valid_from, max(userid) AS userid
      FROM (SELECT concat('d', c_custkey % 25, '.example.com') AS domain,
              CASE WHEN c_custkey % 10 <> 0 THEN concat('u', c_custkey) END AS userid,
              make_timestamp((1704067200 - 10800 + c_custkey * 977 % 21600) * 1000000) AS valid_from FROM customer)
      GROUP BY ALL) v
    ON e.domain = v.domain AND e.moment >= v.valid_from""")
def as_of_userid(inputs: Inputs):
    named = versions.as_of_join(inputs.hour_events(), inputs.channel_history(), ["domain"], "moment")
    return named.select("event_id", "domain", "cs", "userid")
