"""Parsers and filters over derived log lines."""

from pyspark.sql import functions as F

from ..operators import filters, parsers
from ..sources.streams import message_handler
from .inputs import WHITE_TOPICS, Inputs
from .registry import register

MEDIA_SQL = """
    SELECT {DOMAIN} AS domain, {FLAG} AS flag, {CS} AS cs, CAST({SEC} // 60 * 60 AS VARCHAR) AS timestamp
    FROM events WHERE event_id % 11 <> 0"""

ACCESS_SQL = """
    SELECT concat('d', user_id % 4, '.example.com') AS domain, event_type AS dir1,
      concat('a', event_id % 3) AS dir2, {SEC} // 60 * 60 AS timestamp, {CS} AS cs
    FROM events WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0"""


@register("parse_media_log", MEDIA_SQL)
def parse_media_log(inputs: Inputs):
    return parsers.parse_media_log(inputs.media_log())


@register("parse_access_log", ACCESS_SQL)
def parse_access_log(inputs: Inputs):
    return parsers.parse_access_log(inputs.access_log())


@register("parse_counter_csv", """
    SELECT concat('h', user_id % 20, '.example.com') AS host, user_id % 4 AS isp, user_id % 31 AS region,
      {EPOCH} AS timestamp, event_id % 100 AS count, user_id AS userid, user_id % 9 AS zone,
      event_id % 60 AS viewid FROM events WHERE event_id % 29 <> 0""")
def parse_counter_csv(inputs: Inputs):
    return parsers.parse_counter_csv(inputs.counter_csv())


@register("hour_key", """
    SELECT msg_offset, strftime(sent - INTERVAL 8 HOUR, '%Y/%m/%d/%H') AS hour
    FROM {MESSAGE} WHERE msg_offset % 37 <> 0""")
def hour_key(inputs: Inputs):
    return parsers.hour_key(inputs.message()).select("msg_offset", "hour")


@register("reshape_firewall_log", """
    SELECT concat('CDNLOG_cache h', user_id % 9, ' KS_FWLOG_TAG GET ', event_id, ' 10.1.0.', user_id % 256,
      ' 10.1.0.', user_id % 256) AS line FROM events WHERE event_type <> 'error'""")
def reshape_firewall_log(inputs: Inputs):
    return parsers.reshape_firewall_log(inputs.firewall_log())


@register("parse_offset_manifest", "SELECT topic, partition_id, start_offset, end_offset FROM {MANIFEST}")
def parse_offset_manifest(inputs: Inputs):
    return parsers.parse_offset_manifest(inputs.offset_info())


@register("parse_ratings", """
    SELECT CAST("user" AS INTEGER) AS "user", CAST(item AS INTEGER) AS item, rate FROM {RATING}""")
def parse_ratings(inputs: Inputs):
    return parsers.parse_ratings(inputs.rating_txt())


@register("parse_points", """
    SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_orderkey % 50 AS DOUBLE) AS y FROM lineitem""")
def parse_points(inputs: Inputs):
    points = parsers.parse_points(inputs.point_txt())
    return points.select(F.get("point", F.lit(0)).alias("x"), F.get("point", F.lit(1)).alias("y"))


@register("parse_labeled_points", """
    SELECT CAST(l_quantity AS DOUBLE) AS label, CAST(l_orderkey % 50 AS DOUBLE) AS feature FROM lineitem""")
def parse_labeled_points(inputs: Inputs):
    return parsers.parse_labeled_points(inputs.point_txt())


@register("tokenize_tagged_docs", """
    SELECT name, CAST(unnest(range(0, len(words))) AS INTEGER) AS pos, unnest(words) AS word
    FROM (SELECT concat('doc', doc_id) AS name, string_split(rtrim(replace(replace(replace(text,
          chr(10), ' '), chr(13), ' '), ',', ' '), ' '), ' ') AS words FROM documents)""")
def tokenize_tagged_docs(inputs: Inputs):
    return parsers.tokenize_tagged_docs(inputs.tagged_doc())


@register("parse_json_request", """
    SELECT event_id, concat('d', user_id % 20) AS domain, concat('s', event_id % 50) AS stream_name,
      concat('10.0.0.', user_id % 256) AS node FROM events WHERE event_id % 13 <> 0 AND event_id % 7 <> 0""")
def parse_json_request(inputs: Inputs):
    return parsers.parse_json_request(inputs.request_json(), keep=["event_id"])


@register("json_extract", """
    SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events""")
def json_extract(inputs: Inputs):
    return parsers.json_extract(inputs.table("events"), "props", "k bigint", keep=["event_id"])


@register("variant_extract", """
    SELECT event_id, concat('d', user_id % 20) AS domain, concat('10.0.0.', user_id % 256) AS node,
      event_id AS op_time FROM events WHERE event_id % 13 <> 0 AND event_id % 7 <> 0""")
def variant_extract(inputs: Inputs):
    fields = {"domain": ("$.domain", "string"), "node": ("$.node", "string"), "op_time": ("$.op_time", "bigint")}
    return parsers.variant_extract(inputs.request_json(), "req", fields, keep=["event_id"])


@register("to_documents", """
    SELECT concat('d', user_id % 4, '.example.com') AS domain, concat('a', event_id % 3) AS directory,
      {CS} AS bytes, '2024010100' AS write_time
    FROM events WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0""")
def to_documents(inputs: Inputs):
    parsed = parsers.parse_access_log(inputs.access_log())
    names = {"domain": "domain", "dir2": "directory", "cs": "bytes"}
    return parsers.to_documents(parsed, names, write_time="2024010100")


@register("drop_malformed", """
    SELECT event_id, concat('s', event_id % 50) AS stream_name FROM events WHERE event_id % 13 <> 0""")
def drop_malformed(inputs: Inputs):
    fields = inputs.request_json().select("event_id", F.get_json_object("req", "$.stream_name").alias("stream_name"))
    return filters.drop_malformed(fields, ["event_id", "stream_name"])


@register("publish_only", MEDIA_SQL + " AND event_type = 'click'")
def publish_only(inputs: Inputs):
    return filters.publish_only(parsers.parse_media_log(inputs.media_log()))


@register("tag_contains", r"""
    SELECT replace(concat('{"hostname":"h', user_id % 9, '","si":"10.1.0.', user_id % 256,
      '","ori":"KS_FWLOG_TAG GET ', event_id, ' tail","z":"1"}'), '"', '\"') AS line
    FROM events WHERE event_type <> 'error'""")
def tag_contains(inputs: Inputs):
    return filters.tag_contains(inputs.firewall_log(), parsers.FIREWALL_TAG)


@register("usable_offset_ranges", """
    SELECT topic, partition_id, start_offset, end_offset FROM {MANIFEST}
    WHERE topic <> 't4' AND start_offset < end_offset""")
def usable_offset_ranges(inputs: Inputs):
    return filters.usable_offset_ranges(parsers.parse_offset_manifest(inputs.offset_info()), WHITE_TOPICS)


@register("event_time_guard", """
    SELECT o_orderkey, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS seconds FROM orders
    WHERE abs(CAST(floor(epoch(o_orderdate)) AS BIGINT) - 883612800) < 31104000""")
def event_time_guard(inputs: Inputs):
    # 883612800 is 1998-01-01, inside the range of order dates.
    seconds = inputs.table("orders").select("o_orderkey", F.unix_timestamp("o_orderdate").alias("seconds"))
    return seconds.where(filters.event_time_guard("seconds", 883612800))


@register("live_domains", "SELECT DISTINCT domain FROM {CHANNEL} WHERE business = '2'")
def live_domains(inputs: Inputs):
    return filters.live_domains(inputs.channel_csv())


@register("export_domains", "SELECT DISTINCT domain FROM {CHANNEL} WHERE userid = '3038'")
def export_domains(inputs: Inputs):
    return filters.export_domains(inputs.channel_csv())


@register("message_handler", """
    SELECT concat(topic, '/', partition_id) AS source, msg_offset, CAST(length(value) AS INTEGER) AS size
    FROM {MESSAGE}""")
def handled_messages(inputs: Inputs):
    def handler(rows):
        return rows.select(
            F.concat_ws("/", "topic", "partition_id").alias("source"), "msg_offset", F.length("value").alias("size")
        )

    return message_handler(inputs.message(), handler)


