"""Raw lines -> typed rows. Lines that do not fit are dropped, or raise with ``strict``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.net import URL_PARTS, url_path
from ..functions.text import as_column, split_trimmed, strict_int, strict_long, text_after
from ..functions.times import floor_to, log_hour, log_seconds
from .filters import drop_malformed, http_get_only, tag_contains

# Fixed values of the firewall log format.
FIREWALL_TAG = "KS_FWLOG_TAG"
RELAYED_PREFIX = "CDNLOG_cache "

# Keyword search requests: every field is required, further keys are ignored.
KEYWORD_REQUEST = "domain string, stream_name string, node string"


def _parsed(df: DataFrame, *fields: Column | str) -> DataFrame:
    """``df.select(*fields)``, with each field computed once per row.

    A filter on parsed fields would otherwise be pushed below the projection
    and repeat the parsing inside its condition, once per field it tests.
    Filters are not pushed through a generator.
    """
    return df.select(F.inline(F.array(F.struct(*fields))))


def _piece(pieces: Column | str, position: int) -> Column:
    return F.get(as_column(pieces), F.lit(position))


def _keep_complete(
    df: DataFrame, required: Sequence[str], strict: bool, line: str | None = None
) -> DataFrame:
    """Drop rows that lack a required value, or fail the job on the first such row."""
    if not strict:
        return drop_malformed(df, required)
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    shown = F.col(line) if line else F.to_json(F.struct(*required))
    checked = F.when(missing, F.raise_error(F.concat(F.lit("malformed row: "), shown)))
    return df.withColumn(required[0], F.coalesce(checked.cast(df.schema[required[0]].dataType), required[0]))


def parse_media_log(
    lines: DataFrame, line: str = "line", keep: Sequence[str] = (), only: str | None = None
) -> DataFrame:
    """Media access lines -> domain, flag, cs, timestamp (text seconds of the minute).

    After the first ``]`` come blank-separated tokens: the second is the domain
    and the seventh the command, which must have something after it. The byte
    count stands between the last ``" `` and the first `` -`` of the line, so a
    line with an earlier `` -`` is malformed. With ``only``, rows of one flag are
    kept, and lines that do not hold that word are passed over unparsed.
    """
    text = F.col(line)
    if only is not None:
        lines = lines.where(F.lower(text).contains(f" {only} "))
    tail = F.substring_index(text, '" ', -1)
    tail_dash = F.instr(tail, F.lit(" -"))
    first_dash_is_in_tail = (tail_dash > 0) & (
        F.length(text) - F.length(tail) + tail_dash == F.instr(text, F.lit(" -"))
    )
    tokens = lines.select(
        *keep,
        F.split(text_after(text, "]", skip=1), " ").alias("_tokens"),
        F.when(first_dash_is_in_tail, strict_long(F.substring_index(tail, " -", 1))).alias("cs"),
        floor_to(log_seconds(text), 60).cast("string").alias("timestamp"),
    )
    flag = F.when(F.size("_tokens") > 7, F.lower(_piece("_tokens", 6)))
    parsed = _parsed(
        tokens, *keep, _piece("_tokens", 1).alias("domain"), flag.alias("flag"), "cs", "timestamp"
    )
    complete = drop_malformed(parsed, ["domain", "flag", "cs", "timestamp"])
    return complete if only is None else complete.where(F.col("flag") == only)


def parse_access_log(lines: DataFrame, line: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """HTTP access lines -> domain, dir1, dir2, timestamp (bigint minute), cs.

    After the ``]`` come blank-separated tokens: method, URL, protocol, status,
    bytes and at least one more. Only ``http://`` URLs with two path segments
    pass, and only GET lines. A line whose first word has three characters or
    fewer passes with any method.
    """
    short_first_word = F.instr(F.col(line), F.lit(" ")).between(1, 4)
    tokens = lines.where(http_get_only(line=line) | short_first_word).select(
        *keep,
        F.split(text_after(line, "]"), " ").alias("_tokens"),
        floor_to(log_seconds(line), 60).alias("timestamp"),
    )
    with_url = _parsed(
        tokens,
        *keep,
        _piece("_tokens", 2).alias("_url"),
        "timestamp",
        F.when(F.size("_tokens") > 6, strict_long(_piece("_tokens", 5))).alias("cs"),
    )
    fields = _parsed(
        with_url.where(http_get_only(url="_url")).withColumn("_parts", url_path("_url")),
        *keep,
        *[_piece("_parts", at).alias(name) for at, name in enumerate(URL_PARTS)],
        "timestamp",
        "cs",
    )
    return drop_malformed(fields, ["domain", "dir1", "dir2", "timestamp", "cs"])


# Counter line layout, column name -> position, all but the host bigint.
COUNTER_FIELDS = {
    "host": 1, "isp": 10, "region": 11, "timestamp": 2,
    "count": 8, "userid": 3, "zone": 4, "viewid": 7,
}


def parse_counter_csv(lines: DataFrame, line: str = "line") -> DataFrame:
    """Query counter lines -> eight of their twelve fields; seven must be whole numbers."""
    cells = lines.select(F.split(F.col(line), ",").alias("_cells"))
    columns = [
        (_piece("_cells", at) if name == "host" else strict_long(_piece("_cells", at))).alias(name)
        for name, at in COUNTER_FIELDS.items()
    ]
    return drop_malformed(_parsed(cells, *columns), list(COUNTER_FIELDS))


def hour_key(lines: DataFrame, line: str = "value", strict: bool = False) -> DataFrame:
    """Add ``hour`` (``yyyy/MM/dd/HH``) from the bracketed time with zone.

    Lines without a bracketed part are skipped. A bracketed part that is not a
    time is skipped too, or fails the job with ``strict``.
    """
    bracketed = lines.where(F.col(line).rlike(r"^[^\[\]]*\[[^\]]*\]"))
    keyed = _parsed(bracketed, *bracketed.columns, log_hour(line).alias("hour"))
    return _keep_complete(keyed, ["hour"], strict, line)


def reshape_firewall_log(lines: DataFrame, line: str = "line", tag: str = FIREWALL_TAG) -> DataFrame:
    """Escaped JSON envelopes -> ``CDNLOG_cache <host> <text><si> <si>`` as ``line``.

    The text is the ``ori`` value up to the last blank before the first ``","``
    that follows the tag.
    """
    plain = tag_contains(lines, tag, line).select(F.replace(line, F.lit('\\"'), F.lit('"')).alias("_t"))
    upto_value_end = F.regexp_extract("_t", f'(?s)^(.*?{tag}.*?)","', 1)
    parts = _parsed(
        plain,
        F.nullif(F.regexp_extract("_t", '(?s)"hostname":"(.*?)",', 1), F.lit("")).alias("_host"),
        F.nullif(F.regexp_extract("_t", '(?s)"si":"(.*?)",', 1), F.lit("")).alias("_si"),
        F.nullif(F.regexp_extract(upto_value_end, '(?s)"ori":"(.* )', 1), F.lit("")).alias("_ori"),
    )
    complete = drop_malformed(parts, ["_host", "_si", "_ori"])
    return complete.select(
        F.concat(F.lit(RELAYED_PREFIX), "_host", F.lit(" "), "_ori", "_si", F.lit(" "), "_si").alias("line")
    )


def parse_offset_manifest(lines: DataFrame, line: str = "line", strict: bool = False) -> DataFrame:
    """``...{k=topic,k=partition,k=start,k=end}`` -> typed ranges, by position."""
    inner = F.regexp_extract(line, r"\{(.*)\}", 1)
    pairs = lines.select(F.col(line).alias("_line"), F.split(inner, ",").alias("_pairs"))

    def value(at: int) -> Column:
        return _piece(F.split(_piece("_pairs", at), "="), 1)

    ranges = _parsed(
        pairs,
        "_line",
        F.nullif(value(0), F.lit("")).alias("topic"),
        strict_int(value(1)).alias("partition_id"),
        strict_long(value(2)).alias("start_offset"),
        strict_long(value(3)).alias("end_offset"),
    )
    required = ["topic", "partition_id", "start_offset", "end_offset"]
    return _keep_complete(ranges, required, strict, "_line").select(*required)


def parse_ratings(lines: DataFrame, line: str = "line", strict: bool = False) -> DataFrame:
    """``user::item::rate::name`` -> user, item, rate; exactly four fields."""
    fields = lines.select(F.col(line).alias("_line"), split_trimmed(line, "::").alias("_f"))
    four = F.size("_f") == 4
    ratings = _parsed(
        fields,
        "_line",
        F.when(four, strict_int(_piece("_f", 0))).alias("user"),
        F.when(four, strict_int(_piece("_f", 1))).alias("item"),
        F.when(four, _piece("_f", 2).try_cast("double")).alias("rate"),
    )
    required = ["user", "item", "rate"]
    return _keep_complete(ratings, required, strict, "_line").select(*required)


def parse_points(lines: DataFrame, line: str = "line") -> DataFrame:
    """Blank-separated numbers -> ``point`` array<double>; a bad number drops the line."""
    cells = F.transform(split_trimmed(line, " "), lambda cell: F.trim(cell).try_cast("double"))
    points = _parsed(lines, cells.alias("point"))
    return points.where((F.size("point") > 0) & ~F.exists("point", lambda x: x.isNull()))


def parse_labeled_points(lines: DataFrame, line: str = "line") -> DataFrame:
    """First number = label, second = the one feature; further numbers are not read."""
    cells = lines.select(F.split(F.col(line), " ").alias("_c"))
    labeled = _parsed(
        cells,
        _piece("_c", 0).try_cast("double").alias("label"),
        _piece("_c", 1).try_cast("double").alias("feature"),
    )
    return drop_malformed(labeled, ["label", "feature"])


def split_tagged_docs(lines: DataFrame, line: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """``name,text[,...]`` -> name, words (array). Text runs from the first to the second comma.

    Words are cut at single blanks with their case kept; empty words stay,
    except at the end. A line without text is dropped.
    """
    parts = lines.select(*keep, split_trimmed(line, ",").alias("_p"))
    texts = _parsed(parts, *keep, _piece("_p", 0).alias("name"), _piece("_p", 1).alias("_text"))
    named = drop_malformed(texts, ["name", "_text"])
    return _parsed(named, *keep, "name", split_trimmed("_text", " ").alias("words"))


def tokenize_tagged_docs(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row per word of every document: name, pos (from 0), word."""
    return split_tagged_docs(lines, line).select("name", F.posexplode("words").alias("pos", "word"))


def json_extract(
    requests: DataFrame, request: str, schema: str, keep: Sequence[str] = ()
) -> DataFrame:
    """JSON text -> the fields of a DDL schema; rows lacking any of them are dropped."""
    parsed = _parsed(requests, *keep, F.from_json(request, schema).alias("_r"))
    fields = parsed.select(*keep, "_r.*")
    return drop_malformed(fields, [name for name in fields.columns if name not in keep])


def variant_extract(
    requests: DataFrame, request: str, fields: dict[str, tuple[str, str]], keep: Sequence[str] = ()
) -> DataFrame:
    """JSON text -> ``{field: (path, type)}``, parsed once as a variant; rows lacking any field are dropped.

    For nested paths (``$.a.b[0]``), and fields that come with different types. Text that is no JSON, has a key twice, or
    has a value that does not fit its type, lacks the field.
    """
    parsed = _parsed(requests, *keep, F.try_parse_json(request).alias("_v"))
    found = [F.try_variant_get("_v", path, kind).alias(name) for name, (path, kind) in fields.items()]
    # Computed once per row as well: the filter below stays above this generator.
    return drop_malformed(_parsed(parsed, *keep, *found), list(fields))


def parse_json_request(
    requests: DataFrame, request: str = "req", keep: Sequence[str] = ()
) -> DataFrame:
    """Keyword search requests -> domain, stream_name, node."""
    return json_extract(requests, request, KEYWORD_REQUEST, keep)


def to_documents(df: DataFrame, names: dict[str, str], **constants: str) -> DataFrame:
    """Rename columns to document fields (``{column: field}``) and add constant fields."""
    fields = [F.col(column).alias(field) for column, field in names.items()]
    return df.select(*fields, *[F.lit(value).alias(name) for name, value in constants.items()])
