"""Log lines, manifests and other inputs derived by Spark from the test tables.

Some rows are malformed on purpose, so that parsers have something to drop.
Event times are folded into one half hour (counters: six hours), so that
minute groups hold several rows; message times fill two days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder, spread
from ..sources.streams import table_stream_scan

DAY_START = 1704067200  # 2024-01-01 00:00:00 UTC
WHITE_TOPICS = ["t0", "t1", "t2", "t3"]

_CLF = f"date_format(timestamp_seconds({DAY_START} + unix_timestamp(ts) % 1800), 'dd/MMM/yyyy:HH:mm:ss')"

MEDIA_LINE = f"""CASE WHEN event_id % 11 = 0 THEN 'garbage line' ELSE concat(
    'edge', user_id % 7, ' [', {_CLF}, ' +0000] ', event_id, ' d', user_id % 20, '.example.com live s',
    event_id % 50, ' 10.', user_id % 32, '.', event_id % 256, '.1 172.16.0.1 ',
    CASE event_type WHEN 'click' THEN 'PUBLISH' WHEN 'view' THEN 'Play' ELSE event_type END,
    ' rtmp://x "args" ', CAST(round(value * 100) AS BIGINT), ' - 1') END AS line"""

ACCESS_LINE = f"""concat('10.0.0.', user_id % 256, ' [', {_CLF}, ' +0000] "',
    CASE WHEN event_id % 19 = 0 THEN 'POST' ELSE 'GET' END, ' ',
    CASE WHEN event_id % 17 = 0 THEN 'https' ELSE 'http' END, '://d', user_id % 4, '.example.com/', event_type,
    CASE WHEN event_id % 23 = 0 THEN '/' ELSE concat('/a', event_id % 3, '/f.ts') END,
    ' HTTP/1.1" 200 ', CAST(round(value * 100) AS BIGINT), ' "-"') AS line"""

FIREWALL_LINE = r"""replace(concat('{"hostname":"h', user_id % 9, '","si":"10.1.0.', user_id % 256, '","ori":"',
    CASE WHEN event_type = 'error' THEN 'OTHER_TAG' ELSE 'KS_FWLOG_TAG' END, ' GET ', event_id,
    ' tail","z":"1"}'), '"', concat(chr(92), '"')) AS line"""


class Inputs:
    """The tables of one data folder and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        return table_stream_scan(self.spark, self.folder, name)

    def new_folder(self, label: str) -> str:
        return new_folder(self.spark, label)

    def media_log(self, events: DataFrame | None = None) -> DataFrame:
        return (self.table("events") if events is None else events).selectExpr(MEDIA_LINE)

    def access_log(self, events: DataFrame | None = None) -> DataFrame:
        return (self.table("events") if events is None else events).selectExpr(ACCESS_LINE)

    def firewall_log(self, events: DataFrame | None = None) -> DataFrame:
        return (self.table("events") if events is None else events).selectExpr(FIREWALL_LINE)

    def pno_minute(self) -> DataFrame:
        return self.table("events").selectExpr(
            "concat('d', user_id % 20, '.example.com') AS domain",
            "concat('p', event_id % 5) AS pno",
            f"CAST({DAY_START} + unix_timestamp(ts) % 21600 - unix_timestamp(ts) % 60 AS STRING) AS timestamp",
            "CAST(round(value * 100) AS BIGINT) AS cs",
        )

    def hour_events(self) -> DataFrame:
        """event_id, domain, cs and a time folded into the six hours around a midnight."""
        return self.table("events").selectExpr(
            "event_id",
            "concat('d', user_id % 20, '.example.com') AS domain",
            "CAST(round(value * 100) AS BIGINT) AS cs",
            f"timestamp_seconds({DAY_START} - 10800 + unix_timestamp(ts) % 21600) AS moment",
        )

    def counter_csv(self) -> DataFrame:
        return self.table("events").selectExpr(
            """concat('mongdb,h', user_id % 20, '.example.com,', unix_timestamp(ts), ',', user_id, ',',
            user_id % 9, ',0,0,', event_id % 60, ',', CASE WHEN event_id % 29 = 0 THEN 'NA'
            ELSE CAST(event_id % 100 AS STRING) END, ',mongdb,', user_id % 4, ',', user_id % 31) AS line"""
        )

    def channel_csv(self) -> DataFrame:
        """Column 0 domain, 6 customer code, 10 business type. Domains d18 and d19 are left out."""
        return self.table("customer").selectExpr(
            """concat('d', CASE WHEN c_custkey < 18 THEN c_custkey ELSE c_custkey + 2 END,
            '.example.com,c1,c2,c3,c4,c5,', CASE WHEN c_custkey % 3 = 0 THEN '3038'
            ELSE concat('u', c_custkey) END, ',c7,c8,c9,', 1 + c_custkey % 2) AS line"""
        )

    def channels(self) -> DataFrame:
        cells = F.split("line", ",")
        return self.channel_csv().select(
            F.get(cells, F.lit(0)).alias("domain"), F.get(cells, F.lit(6)).alias("userid")
        )

    def channel_history(self) -> DataFrame:
        """domain, userid and the time from which it holds, within the six hours around a midnight; some have none."""
        return self.table("customer").selectExpr(
            "concat('d', c_custkey % 25, '.example.com') AS domain",
            "CASE WHEN c_custkey % 10 <> 0 THEN concat('u', c_custkey) END AS userid",
            f"timestamp_seconds({DAY_START} - 10800 + c_custkey * 977 % 21600) AS valid_from",
        )

    def channel_states(self) -> list[DataFrame]:
        """The dimension at three readings: domains change their users, some come, some go."""
        kept = ["c_custkey % 7 <> 3", "c_custkey % 7 <> 4", "c_custkey % 11 <> 5"]
        return [
            self.table("customer").where(rows).selectExpr(
                "concat('c', c_custkey, '.example.com') AS domain",
                f"concat('u', CASE WHEN c_custkey % 5 < {changed} THEN c_custkey + 1 ELSE c_custkey END) AS userid")
            for changed, rows in enumerate(kept)
        ]

    def ip_range(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "CAST(167772160 + s_suppkey * 65536 AS BIGINT) AS start_ip",
            "CAST(167772160 + s_suppkey * 65536 + 51199 AS BIGINT) AS end_ip",
            "s_name AS company",
        )

    def ip_event(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            """CASE WHEN event_id % 31 = 0 THEN 'bad.ip'
            ELSE concat('10.', user_id % 32, '.', event_id % 256, '.1') END AS ip""",
        )

    def offset_info(self) -> DataFrame:
        return self.table("orders").groupBy(
            F.expr("o_custkey % 5").alias("t"), F.expr("o_orderkey % 12").alias("p")
        ).agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).selectExpr(
            """concat('request{topic=t', t, ',partition=', p, ',start=', low + 50, ',end=',
            CASE WHEN p = 5 THEN low ELSE high - 50 END, '}') AS line"""
        )

    def message(self, orders: DataFrame | None = None) -> DataFrame:
        return (self.table("orders") if orders is None else orders).selectExpr(
            "concat('t', o_custkey % 5) AS topic",
            "CAST(o_orderkey % 12 AS INT) AS partition_id",
            "o_orderkey AS msg_offset",
            f"""CASE WHEN o_orderkey % 37 = 0 THEN 'no time' ELSE concat('h [',
            date_format(timestamp_seconds({DAY_START} + o_orderkey * 37 % 172800), 'dd/MMM/yyyy:HH:mm:ss'),
            ' +0800] ', o_orderpriority) END AS value""",
        )

    def rating_txt(self) -> DataFrame:
        orders, lines = self.table("orders"), self.table("lineitem")
        return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).selectExpr(
            "concat(o_custkey, '::', l_partkey, '::', CAST(l_quantity AS BIGINT), '::n', l_linenumber) AS line"
        )

    def request_json(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            """CASE WHEN event_id % 13 = 0 THEN '{bad'
            WHEN event_id % 7 = 0 THEN concat('{"domain":"d', user_id % 20, '","stream_name":"s',
              event_id % 50, '"}')
            ELSE concat('{"domain":"d', user_id % 20, '","stream_name":"s', event_id % 50,
              '","node":"10.0.0.', user_id % 256, '","op_time":', event_id, '}') END AS req""",
        )

    def tagged_doc(self) -> DataFrame:
        """``name,text,language``: commas inside the text become blanks, so all of it is the second field."""
        return spread(self.table("documents").select("doc_id", "text", "lang"), "doc_id").selectExpr(
            """concat('doc', doc_id, ',', replace(replace(replace(text, chr(10), ' '), chr(13), ' '), ',', ' '),
            ',', lang) AS line"""
        )

    def point_txt(self) -> DataFrame:
        lines = spread(self.table("lineitem").select("l_orderkey", "l_quantity"), "l_orderkey")
        return lines.selectExpr(
            "concat(CAST(l_quantity AS BIGINT), ' ', CAST(l_orderkey % 50 AS BIGINT)) AS line"
        )

    def _hour_files(self, path: str, size: str) -> DataFrame:
        keyed = self.table("events").selectExpr(
            f"{path} AS path", "date_format(ts, 'HH') AS hour", "CAST(round(value * 100) AS BIGINT) AS bytes"
        )
        return keyed.groupBy("path", "hour").agg(F.sum("bytes").alias("bytes")).selectExpr(
            "path", "hour", f"CAST({size} AS BIGINT) AS size"
        )

    def file_src(self) -> DataFrame:
        """``<domain>/<yyyy>/<MM>/<dd>/<HH>`` and size."""
        return self._hour_files(
            "concat('d', user_id % 20, '.example.com/', date_format(ts, 'yyyy/MM/dd'), '/', date_format(ts, 'HH'))",
            "bytes",
        ).select("path", "size")

    def file_dst(self) -> DataFrame:
        """Delivered files: hours ending in 7 never arrived, hour 03 is one byte short.

        Files of hour 05 were sent twice, the first time cut short.
        """
        day = "date_format(ts, 'yyyy-MM-dd')"
        sent = self._hour_files(
            f"concat('/d', user_id % 20, '.example.com/', {day}, '/', {day}, '_', date_format(ts, 'HH'))",
            "bytes - CASE WHEN hour = '03' THEN 1 ELSE 0 END",
        ).where("hour NOT LIKE '%7'")
        first_try = sent.where("hour = '05'").withColumn("size", F.col("size") - 2)
        return sent.unionByName(first_try).select("path", "size")

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
