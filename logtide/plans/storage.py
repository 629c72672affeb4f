"""Sources and sinks: write derived rows to the shared folder and read them back."""

from pyspark.sql import functions as F

from ..functions.times import batch_time_parts
from ..operators import delivery, filters, lookups, parsers, ratings
from ..sinks import tables as table_sinks
from ..sinks import text as text_sinks
from ..sources import tables
from ..sources.streams import multi_topic_scan
from .inputs import DAY_START, Inputs
from .joins import PREDICTED_SQL, predictions
from .registry import register

MEDIA_LINE_SQL = """CASE WHEN event_id % 11 = 0 THEN 'garbage line' ELSE concat('edge', user_id % 7, ' [',
    strftime(make_timestamp({SEC} * 1000000), '%d/%b/%Y:%H:%M:%S'), ' +0000] ', event_id, ' ', {DOMAIN},
    ' live s', event_id % 50, ' 10.', user_id % 32, '.', event_id % 256, '.1 172.16.0.1 ',
    CASE event_type WHEN 'click' THEN 'PUBLISH' WHEN 'view' THEN 'Play' ELSE event_type END,
    ' rtmp://x "args" ', {CS}, ' - 1') END"""

FIREWALL_LINE_SQL = r"""replace(concat('{"hostname":"h', user_id % 9, '","si":"10.1.0.', user_id % 256,
    '","ori":"', CASE WHEN event_type = 'error' THEN 'OTHER_TAG' ELSE 'KS_FWLOG_TAG' END, ' GET ', event_id,
    ' tail","z":"1"}'), '"', '\"')"""


@register("text_scan", f"SELECT {MEDIA_LINE_SQL} AS value FROM events")
def text_scan(inputs: Inputs):
    folder = inputs.new_folder("text-scan")
    text_sinks.write_text(inputs.media_log(), f"{folder}/day=1")
    return tables.text_scan(inputs.spark, f"{folder}/*").select("value")


@register("multi_topic_scan", f"""
    SELECT 'media' AS topic, {MEDIA_LINE_SQL} AS line FROM events
    UNION ALL SELECT 'firewall', {FIREWALL_LINE_SQL} FROM events""")
def multi_topics(inputs: Inputs):
    return multi_topic_scan({"media": inputs.media_log(), "firewall": inputs.firewall_log()})


@register("index_range_scan", """
    SELECT domain, pno, timestamp, cs FROM (
      SELECT {DOMAIN} AS domain, concat('p', event_id % 5) AS pno,
        1704067200 + {EPOCH} % 21600 - {EPOCH} % 60 AS s, CAST(s AS VARCHAR) AS timestamp, {CS} AS cs FROM events)
    WHERE s // 3600 = 1704067200 // 3600 + 2 AND s BETWEEN 1704067200 + 7500 AND 1704067200 + 9900""")
def index_range_scan(inputs: Inputs):
    root = inputs.new_folder("index-range")
    minutes = inputs.pno_minute()
    hour = batch_time_parts(F.timestamp_seconds(F.col("timestamp").cast("bigint")))["hour_index"]
    table_sinks.dated_index_sink(minutes, root, "pno_cs", hour)
    start, stop = str(DAY_START + 7500), str(DAY_START + 9900)
    return tables.index_range_scan(inputs.spark, root, "pno_cs", "2024010102", start, stop)


@register("numeric_matrix_scan", """
    SELECT l_orderkey AS c0, l_partkey AS c1, l_suppkey AS c2, CAST(l_linenumber AS BIGINT) AS c3, 4 AS cells
    FROM lineitem""")
def numeric_matrix_scan(inputs: Inputs):
    folder = inputs.new_folder("matrix")
    lines = inputs.table("lineitem").select(
        F.concat_ws(" ", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("line")
    )
    text_sinks.write_text(lines, folder)
    rows = tables.numeric_matrix_scan(inputs.spark, folder)
    return rows.select(
        *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(4)], F.size("cells").alias("cells")
    )


@register("dimension_csv_scan", "SELECT domain, userid AS customer, business FROM {CHANNEL}")
def dimension_csv_scan(inputs: Inputs):
    folder = inputs.new_folder("channels")
    inputs.channel_csv().write.option("compression", "gzip").text(folder)
    return tables.dimension_csv_scan(inputs.spark, folder)


@register("dated_index_sink", """
    SELECT 'media_cs' AS index_name, strftime(make_timestamp({SEC} * 1000000), '%Y%m%d') AS index_date,
      {DOMAIN} AS domain, CAST({SEC} // 60 * 60 AS VARCHAR) AS timestamp, CAST(sum({CS}) AS BIGINT) AS cs
    FROM events WHERE event_id % 11 <> 0 GROUP BY ALL""")
def dated_index_sink(inputs: Inputs):
    root = inputs.new_folder("dated-index")
    media = parsers.parse_media_log(inputs.media_log())
    sums = media.groupBy("domain", "timestamp").agg(F.sum("cs").alias("cs"))
    day = batch_time_parts(F.timestamp_seconds(F.col("timestamp").cast("bigint")))["day_index"]
    table_sinks.dated_index_sink(sums, root, "media_cs", day)
    return inputs.spark.read.parquet(root).withColumn("index_date", F.col("index_date").cast("string"))


HOURLY_SQL = """
    SELECT event_id, {CS} AS cs, strftime({MOMENT}, '%Y%m') AS month_, strftime({MOMENT}, '%d') AS day_,
      strftime({MOMENT}, '%H') AS hour_ FROM events"""


def _hourly(inputs: Inputs, folder: str) -> None:
    rows = inputs.hour_events().select("event_id", "cs", "moment")
    table_sinks.hourly_parquet_append(rows, folder, "moment")


@register("hourly_parquet_append", HOURLY_SQL)
def hourly_parquet_append(inputs: Inputs):
    folder = inputs.new_folder("hourly")
    _hourly(inputs, folder)
    schema = "event_id bigint, cs bigint, moment timestamp, month_ string, day_ string, hour_ string"
    return inputs.spark.read.schema(schema).parquet(folder).drop("moment")


@register("register_partition", HOURLY_SQL)
def register_partition(inputs: Inputs):
    folder = inputs.new_folder("hourly-table")
    table = "hourly_" + folder.rsplit("-", 1)[-1]
    _hourly(inputs, folder)
    spark = inputs.spark
    table_sinks.create_hourly_table(spark, table, folder, "event_id BIGINT, cs BIGINT, moment TIMESTAMP")
    hours = spark.read.schema("month_ string, day_ string, hour_ string").parquet(folder).distinct()
    for hour in hours.collect():  # one short row per hour of the fixture's day
        table_sinks.register_partition(spark, table, *hour)
    table_sinks.register_partition(spark, table, *hour)
    return spark.table(table).drop("moment")


@register("hour_keyed_archive", """
    SELECT concat(strftime(moment, '%Y/%m/%d/%H'), '_', strftime(moment, '%Y-%m-%d-%H'), chr(9), value) AS value,
      strftime(moment, '%Y/%m/%d/%H') AS folder
    FROM (SELECT value, sent - INTERVAL 8 HOUR AS moment FROM {MESSAGE} WHERE msg_offset % 37 <> 0)""")
def hour_keyed_archive(inputs: Inputs):
    folder = inputs.new_folder("archive")
    text_sinks.hour_keyed_archive(parsers.hour_key(inputs.message()), folder)
    schema = "value string, y string, m string, d string, h string"
    archived = inputs.spark.read.schema(schema).text(folder)
    return archived.select("value", F.concat_ws("/", "y", "m", "d", "h").alias("folder"))


@register("message_sink", f"SELECT {MEDIA_LINE_SQL} AS value, true AS keyed FROM events")
def message_sink(inputs: Inputs):
    folder = inputs.new_folder("messages")
    text_sinks.message_sink(inputs.media_log(), folder, "media", format="parquet")
    sent = inputs.spark.read.parquet(f"{folder}/media")
    return sent.select("value", (F.col("key") == F.xxhash64("value").cast("string")).alias("keyed"))


@register("csv_line_sink", f"""
    SELECT concat_ws(',', r."user", r.item, CAST(r.rate AS VARCHAR), CAST(p.pred AS VARCHAR)) AS value
    FROM {{RATING}} r JOIN {PREDICTED_SQL} p
      ON r."user" = p."user" AND r.item = p.item""")
def csv_line_sink(inputs: Inputs):
    folder = inputs.new_folder("csv-lines")
    pairs = ratings.rated_predictions(parsers.parse_ratings(inputs.rating_txt()), predictions(inputs))
    columns = ["user", "item", "rate", "pred"]
    text_sinks.csv_line_sink(pairs, folder, columns, ["user", "item", "rate"])
    return tables.text_scan(inputs.spark, folder)


@register("text_write_modes", f"""
    SELECT {MEDIA_LINE_SQL} AS value FROM events UNION ALL SELECT {FIREWALL_LINE_SQL} FROM events""")
def text_write_modes(inputs: Inputs):
    folder = inputs.new_folder("text-modes")
    text_sinks.write_text(inputs.access_log(), folder, append=True)
    text_sinks.write_text(inputs.media_log(), folder)
    text_sinks.write_text(inputs.firewall_log(), folder, append=True)
    return tables.text_scan(inputs.spark, folder)


def _export_lines(inputs: Inputs):
    return inputs.hour_events().selectExpr(
        "domain",
        "date_format(moment, 'yyyy-MM-dd') AS day",
        "date_format(moment, 'HH') AS hour",
        "concat(event_id, ' ', cs) AS value",
    )


@register("file_inventory", """
    SELECT concat('domain=', {DOMAIN}, strftime({MOMENT}, '/day=%Y-%m-%d/hour=%H')) AS folder,
      CAST(sum(strlen(concat(event_id, ' ', {CS})) + 1) AS BIGINT) AS bytes FROM events GROUP BY 1""")
def file_inventory(inputs: Inputs):
    folder = inputs.new_folder("export-files")
    text_sinks.export_by_domain_day(_export_lines(inputs), folder)
    files = tables.file_inventory(inputs.spark, folder)
    data = files.where(F.col("path").contains("/part-"))
    return data.groupBy(F.regexp_replace("path", "/part-[^/]*$", "").alias("folder")).agg(
        F.sum("length").alias("bytes")
    )


@register("export_by_domain_day", """
    SELECT {DOMAIN} AS domain, strftime({MOMENT}, '%Y-%m-%d') AS day, strftime({MOMENT}, '%H') AS hour,
      concat(event_id, ' ', {CS}) AS value FROM events
    WHERE {DOMAIN} IN (SELECT domain FROM {CHANNEL} WHERE userid = '3038')""")
def export_by_domain_day(inputs: Inputs):
    folder = inputs.new_folder("export")
    listed = filters.export_domains(inputs.channel_csv())
    text_sinks.export_by_domain_day(lookups.domain_semi_join(_export_lines(inputs), listed), folder)
    schema = "value string, domain string, day string, hour string"
    return inputs.spark.read.schema(schema).text(folder).select("domain", "day", "hour", "value")


SOURCE_FILES_SQL = """
    (SELECT {DOMAIN} AS domain, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hh,
       {DOMAIN} || '/' || strftime(ts, '%Y/%m/%d/%H') AS path,
       '/' || {DOMAIN} || '/' || strftime(ts, '%Y-%m-%d/%Y-%m-%d_%H') AS target,
       CAST(sum({CS}) AS BIGINT) AS size FROM events
     WHERE {DOMAIN} IN (SELECT domain FROM {CHANNEL} WHERE userid = '3038') GROUP BY ALL)"""


def _plan(inputs: Inputs):
    return delivery.export_plan(inputs.file_src(), filters.export_domains(inputs.channel_csv()))


@register("export_plan", f"SELECT path, size, domain, day, target FROM {SOURCE_FILES_SQL}")
def export_plan(inputs: Inputs):
    return _plan(inputs)


RECONCILED_SQL = f"""
    (SELECT target, size AS source_size, delivered AS delivered_size, size - delivered AS difference,
       CASE WHEN delivered = 0 THEN 'failed' WHEN size <> delivered THEN 'short' ELSE 'ok' END AS status
     FROM (SELECT *, CAST(CASE WHEN hh LIKE '%7' THEN 0 WHEN hh = '03' THEN size - 1 ELSE size END AS BIGINT)
             AS delivered FROM {SOURCE_FILES_SQL}))"""


@register("reconcile_delivery", f"SELECT * FROM {RECONCILED_SQL}")
def reconcile_delivery(inputs: Inputs):
    return delivery.reconcile_delivery(_plan(inputs), inputs.file_dst())


@register("delivery_failures", f"SELECT * FROM {RECONCILED_SQL} WHERE status = 'failed'")
def delivery_failures(inputs: Inputs):
    return delivery.delivery_failures(delivery.reconcile_delivery(_plan(inputs), inputs.file_dst()))
