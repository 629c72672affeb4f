"""Query registry."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import use_utc
from .inputs import Inputs

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}

# Shorthands of the oracle SQL (DuckDB dialect).
SQL_TERMS = {
    "EPOCH": "CAST(floor(epoch(ts)) AS BIGINT)",
    "SEC": "(1704067200 + CAST(floor(epoch(ts)) AS BIGINT) % 1800)",
    "CS": "CAST(round(value * 100) AS BIGINT)",
    "MOMENT": "make_timestamp((1704067200 - 10800 + CAST(floor(epoch(ts)) AS BIGINT) % 21600) * 1000000)",
    "FLAG": "CASE event_type WHEN 'click' THEN 'publish' WHEN 'view' THEN 'play' ELSE event_type END",
    "DOMAIN": "concat('d', user_id % 20, '.example.com')",
    "CHANNEL": (
        "(SELECT concat('d', CASE WHEN c_custkey < 18 THEN c_custkey ELSE c_custkey + 2 END, "
        "'.example.com') AS domain, CASE WHEN c_custkey % 3 = 0 THEN '3038' ELSE concat('u', c_custkey) END "
        "AS userid, CAST(1 + c_custkey % 2 AS VARCHAR) AS business FROM customer)"
    ),
    "WORDS": (
        "(SELECT concat('doc', doc_id) AS name, unnest(string_split(rtrim(replace(replace(replace(text, "
        "chr(10), ' '), chr(13), ' '), ',', ' '), ' '), ' ')) AS word FROM documents)"
    ),
    "RATING": (
        "(SELECT o_custkey AS \"user\", l_partkey AS item, CAST(l_quantity AS DOUBLE) AS rate "
        "FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"
    ),
    "MESSAGE": (
        "(SELECT concat('t', o_custkey % 5) AS topic, CAST(o_orderkey % 12 AS INTEGER) AS partition_id, "
        "o_orderkey AS msg_offset, make_timestamp((1704067200 + o_orderkey * 37 % 172800) * 1000000) AS sent, "
        "CASE WHEN o_orderkey % 37 = 0 THEN 'no time' "
        "ELSE concat('h [', strftime(sent, '%d/%b/%Y:%H:%M:%S'), ' +0800] ', o_orderpriority) END "
        "AS value FROM orders)"
    ),
    "MANIFEST": (
        "(SELECT concat('t', o_custkey % 5) AS topic, CAST(o_orderkey % 12 AS INTEGER) AS partition_id, "
        "min(o_orderkey) + 50 AS start_offset, CASE WHEN o_orderkey % 12 = 5 THEN min(o_orderkey) "
        "ELSE max(o_orderkey) - 50 END AS end_offset FROM orders GROUP BY o_custkey % 5, o_orderkey % 12)"
    ),
}


def register(name: str, oracle: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` as query ``name``; ``{TERM}`` in the SQL is filled in."""

    def wrap(fn: Callable[[Inputs], DataFrame]):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(use_utc(spark), sf_dir))

        assert name not in _queries, name
        _queries[name] = run
        if oracle is not None:
            sql = oracle
            for term, text in SQL_TERMS.items():
                sql = sql.replace("{" + term + "}", text)
            _oracles[name] = sql
        return fn

    return wrap


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)
