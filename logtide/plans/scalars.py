"""Scalar expressions over whole tables."""

from pyspark.sql import functions as F

from ..functions import net, text, times, vectors
from ..operators.filters import http_get_only
from .inputs import ACCESS_LINE, Inputs
from .registry import register

SECONDS_OR_WORD = "CASE WHEN event_id % 10 = 0 THEN concat('x', event_id) ELSE CAST({} AS STRING) END AS s"


def _second_texts(inputs: Inputs):
    return inputs.table("events").selectExpr("event_id", SECONDS_OR_WORD.format("unix_timestamp(ts)"))


@register("minute_floor", """
    SELECT event_id, CASE WHEN event_id % 10 = 0 THEN concat('x', event_id)
      ELSE CAST({EPOCH} // 60 * 60 AS VARCHAR) END AS minute FROM events""")
def minute_floor(inputs: Inputs):
    return _second_texts(inputs).select("event_id", times.minute_floor("s").alias("minute"))


@register("hour_floor", """
    SELECT event_id, CASE WHEN event_id % 10 = 0 THEN concat('x', event_id)
      ELSE CAST({EPOCH} // 3600 * 3600 AS VARCHAR) END AS hour FROM events""")
def hour_floor(inputs: Inputs):
    return _second_texts(inputs).select("event_id", times.hour_floor("s").alias("hour"))


@register("five_minute_mark", """
    SELECT o_orderkey, (o_orderkey * 100) // 300 * 300 + 300 AS mark FROM orders""")
def five_minute_mark(inputs: Inputs):
    return inputs.table("orders").select(
        "o_orderkey", times.five_minute_mark(F.col("o_orderkey") * 100).alias("mark")
    )


@register("epoch_to_text", """
    SELECT event_id, strftime(make_timestamp({EPOCH} * 1000000), '%Y-%m-%d %H:%M:%S') AS moment FROM events""")
def epoch_to_text(inputs: Inputs):
    return inputs.table("events").select(
        "event_id", times.epoch_to_text(F.unix_timestamp("ts"), "yyyy-MM-dd HH:mm:ss").alias("moment")
    )


@register("text_to_time", "SELECT event_id, {EPOCH} // 3600 * 3600 AS seconds FROM events")
def text_to_time(inputs: Inputs):
    hours = inputs.table("events").select("event_id", F.date_format("ts", "yyyyMMdd-HH").alias("h"))
    return hours.select("event_id", F.unix_timestamp(times.text_to_time("h", "yyyyMMdd-HH")).alias("seconds"))


@register("plus_days", """
    SELECT o_orderkey, strftime(o_orderdate + INTERVAL 10 DAY, '%Y%m%d') AS later FROM orders""")
def plus_days(inputs: Inputs):
    days = inputs.table("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("d"))
    return days.select("o_orderkey", times.plus_days("d", "yyyyMMdd", 10).alias("later"))


@register("day_range", """
    SELECT o_orderkey, strftime(o_orderdate + to_days(CAST(n AS INTEGER)), '%Y%m%d') AS day
    FROM (SELECT o_orderkey, o_orderdate, unnest(range(0, o_orderkey % 7)) AS n FROM orders)""")
def day_range(inputs: Inputs):
    # One order in seven ends the day before it starts: no days.
    spans = inputs.table("orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").alias("first"),
        F.date_format(F.expr("o_orderdate + make_dt_interval(o_orderkey % 7 - 1)"), "yyyyMMdd").alias("last"),
    )
    return spans.select("o_orderkey", F.explode(times.day_range("first", "last", "yyyyMMdd")).alias("day"))


@register("batch_time_parts", """
    SELECT event_id, strftime(ts, '%Y%m') AS month_, strftime(ts, '%d') AS day_, strftime(ts, '%H') AS hour_,
      strftime(ts, '%Y%m%d') AS day_index, strftime(ts, '%Y%m%d%H') AS hour_index FROM events""")
def batch_time_parts(inputs: Inputs):
    parts = times.batch_time_parts("ts")
    return inputs.table("events").select("event_id", *[part.alias(name) for name, part in parts.items()])


@register("ip_to_long", """
    SELECT event_id, CASE WHEN event_id % 31 = 0 THEN CAST(-1 AS BIGINT)
      ELSE 167772160 + (user_id % 32) * 65536 + (event_id % 256) * 256 + 1 END AS address FROM events""")
def ip_to_long(inputs: Inputs):
    return inputs.ip_event().select("event_id", net.ip_to_long("ip").alias("address"))


@register("url_parts", """
    SELECT page_id, p[1] AS domain, coalesce(p[2], '') AS dir1, coalesce(p[3], '') AS dir2
    FROM (SELECT page_id, string_split(rtrim(substr(url, 8), '/'), '/') AS p FROM pages
          WHERE starts_with(url, 'http://'))""")
def url_parts(inputs: Inputs):
    pages = inputs.table("pages").where(http_get_only(url="url"))
    parts = net.url_parts("url")
    return pages.select(
        "page_id", *[F.coalesce(part, F.lit("")).alias(name) for name, part in parts.items()]
    )


@register("http_get_only", """
    SELECT event_id, event_id % 17 <> 0 AS plain_http, event_id % 19 <> 0 AS is_get FROM events""")
def http_get(inputs: Inputs):
    lines = inputs.table("events").selectExpr("event_id", ACCESS_LINE)
    url = F.regexp_extract("line", '"[A-Z]+ ([^ ]*)', 1)
    return lines.select(
        "event_id", http_get_only(url=url).alias("plain_http"), http_get_only(line="line").alias("is_get")
    )


@register("cosine_similarity", """
    SELECT a.vec_id AS vec_id, round(list_dot_product(a.v, b.v)
      / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 6) AS cosine
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) a
    JOIN (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) b ON b.vec_id = a.vec_id + 1""")
def cosine_similarity(inputs: Inputs):
    left = inputs.vectors().select("id", F.col("features").alias("a"))
    right = inputs.vectors().select((F.col("id") - 1).alias("id"), F.col("features").alias("b"))
    return left.join(right, "id").select(
        F.col("id").alias("vec_id"), F.round(vectors.cosine_similarity("a", "b"), 6).alias("cosine")
    )


@register("archive_key", """
    SELECT event_id, concat(strftime(ts, '%Y/%m/%d/%H'), '_', strftime(ts, '%Y-%m-%d-%H')) AS archive_key
    FROM events""")
def archive_key(inputs: Inputs):
    hours = inputs.table("events").select("event_id", F.date_format("ts", "yyyy/MM/dd/HH").alias("hour"))
    return hours.select("event_id", text.archive_key("hour").alias("archive_key"))


@register("strict_long", """
    SELECT event_id, CASE WHEN event_id % 4 IN (0, 1) THEN event_id ELSE -999 END AS n FROM events""")
def strict_long(inputs: Inputs):
    texts = inputs.table("events").selectExpr(
        "event_id",
        """CASE event_id % 4 WHEN 0 THEN CAST(event_id AS STRING) WHEN 1 THEN concat('+', event_id)
        WHEN 2 THEN concat(' ', event_id, ' ') ELSE concat(event_id, '.0') END AS s""",
    )
    return texts.select("event_id", F.coalesce(text.strict_long("s"), F.lit(-999).cast("bigint")).alias("n"))


@register("split_cells", """
    SELECT doc_id, CAST(unnest(range(0, len(cells))) AS INTEGER) AS col, unnest(cells) AS cell
    FROM (SELECT doc_id, string_split(text, ',') AS cells FROM documents)""")
def split_cells(inputs: Inputs):
    return inputs.table("documents").select("doc_id", F.posexplode(text.split_cells("text")).alias("col", "cell"))


@register("export_path", """
    SELECT {DOMAIN} || '/' || strftime(ts, '%Y/%m/%d/%H') AS path,
      '/' || {DOMAIN} || '/' || strftime(ts, '%Y-%m-%d/%Y-%m-%d_%H') AS target
    FROM events GROUP BY 1, 2""")
def export_path(inputs: Inputs):
    return inputs.file_src().select("path", text.export_path("path").alias("target"))
