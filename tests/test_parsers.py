import pytest

from logtide.operators import filters, parsers

GOOD_MEDIA = 'edge [02/Jan/2024:03:04:05 +0000] 7 d1.example.com live s1 10.0.0.1 10.0.0.2 PUBLISH rtmp://x "args" 1234 - 1'


def test_media_line(lines, rows):
    got = rows(parsers.parse_media_log(lines(GOOD_MEDIA)), "domain", "flag", "cs", "timestamp")
    assert got == [("d1.example.com", "publish", 1234, "1704164640")]


@pytest.mark.parametrize("bad", [
    "garbage",
    "",
    GOOD_MEDIA.replace("[", "("),
    GOOD_MEDIA.replace(" 1234 ", " 12x4 "),
    GOOD_MEDIA.replace(" 1234 ", "  1234 "),  # a blank before the number
    GOOD_MEDIA.replace("live", "- live"),  # an earlier dash hides the byte count
    GOOD_MEDIA.replace(" - 1", ""),
    GOOD_MEDIA.replace("02/Jan/2024", "02/Xxx/2024"),
    "edge [02/Jan/2024:03:04:05 +0000] 7 d1 live",
])
def test_malformed_media_lines_are_dropped(lines, bad):
    assert parsers.parse_media_log(lines(bad)).count() == 0


def test_media_early_filter_changes_nothing(lines, rows):
    play = GOOD_MEDIA.replace("PUBLISH", "Play")
    tricky = play.replace("live", "publish")  # the word stands elsewhere in the line
    source = lines(GOOD_MEDIA, play, tricky, "garbage publish ")
    early = parsers.parse_media_log(source, only="publish")
    late = filters.publish_only(parsers.parse_media_log(source))
    assert rows(early) == rows(late) and early.count() == 1


def access(method="GET", url="http://d.com/a/b/c.ts", tail='200 55 "-"', ip="10.0.0.1"):
    return f'{ip} [02/Jan/2024:03:04:05 +0000] "{method} {url} HTTP/1.1" {tail}'


def test_access_line(lines, rows):
    got = rows(parsers.parse_access_log(lines(access())), "domain", "dir1", "dir2", "timestamp", "cs")
    assert got == [("d.com", "a", "b", 1704164640, 55)]


def test_access_empty_first_segment_is_kept(lines, rows):
    got = rows(parsers.parse_access_log(lines(access(url="http://d.com//b"))), "domain", "dir1", "dir2")
    assert got == [("d.com", "", "b")]


@pytest.mark.parametrize("bad", [
    access(method="POST"),
    access(url="https://d.com/a/b"),
    access(url="http://d.com/a/"),
    access(url="http://d.com/a"),
    access(tail="200 55"),
    access(tail='200 - "-"'),
    " ",
    "",
])
def test_dropped_access_lines(lines, bad):
    assert parsers.parse_access_log(lines(bad)).count() == 0


def test_short_first_word_passes_with_any_method(lines):
    assert parsers.parse_access_log(lines(access(method="POST", ip="abc"))).count() == 1
    assert parsers.parse_access_log(lines(access(method="POST", ip="abcd"))).count() == 0


def test_counter_line(lines, rows):
    good = "db7,h1.example.com,1704067200,71,88,0,0,54,10,db7,2,3"
    got = rows(parsers.parse_counter_csv(lines(good, good + ",,", good.replace(",10,", ", 10,"), "a,b", good[:-2])))
    one = ("h1.example.com", 2, 3, 1704067200, 10, 71, 88, 54)
    assert got == [one, one]


def test_hour_key_skips_or_raises(spark, rows):
    df = spark.createDataFrame([
        ("a [02/Jan/2024:03:04:05 +0800] x",), ("none",), ("] [02/Jan/2024:03:04:05 +0800]",), ("a [bad] x",),
    ], "value string")
    assert rows(parsers.hour_key(df), "hour") == [("2024/01/01/19",)]
    with pytest.raises(Exception, match="malformed row"):
        parsers.hour_key(df, strict=True).collect()


def test_firewall_line(lines, rows):
    text = r'{\"hostname\":\"h1\",\"si\":\"10.1.0.2\",\"ori\":\"KS_FWLOG_TAG GET 5 tail\",\"z\":\"1\"}'
    got = rows(parsers.reshape_firewall_log(lines(text, text.replace("KS_FWLOG_TAG", "OTHER"), "KS_FWLOG_TAG")))
    assert got == [("CDNLOG_cache h1 KS_FWLOG_TAG GET 5 10.1.0.2 10.1.0.2",)]


def test_manifest(lines, rows):
    source = lines(
        "request{topic=t1,partition=3,start=5,end=9}", "x{a=t2,b=0,c=7,d=7}", "{a=t3,b=x,c=1,d=2}", "nothing"
    )
    parsed = parsers.parse_offset_manifest(source)
    assert rows(parsed) == [("t1", 3, 5, 9), ("t2", 0, 7, 7)]
    assert rows(filters.usable_offset_ranges(parsed, ["t1", "t2"])) == [("t1", 3, 5, 9)]
    with pytest.raises(Exception, match="malformed row"):
        parsers.parse_offset_manifest(source, strict=True).collect()


def test_ratings_need_four_fields(lines, rows):
    source = lines("1::2::3.5::n", "1::2::3", "1::2::3::", "1::2::3::a::b", "x::2::3::n", "1::2::4::n::")
    assert rows(parsers.parse_ratings(source)) == [(1, 2, 3.5), (1, 2, 4.0)]


def test_points(lines, rows):
    source = lines("60 55", "1.5 -2 7", "a 1", "")
    assert [r[0] for r in parsers.parse_points(source).collect()] == [[60.0, 55.0], [1.5, -2.0, 7.0]]
    assert rows(parsers.parse_labeled_points(source)) == [(1.5, -2.0), (60.0, 55.0)]


def test_tagged_docs(lines, rows):
    source = lines("rdd,a B  a ,ignored,more", "empty,,x", "none", "blank,   ,x", "end,")
    got = {r.name: r.words for r in parsers.split_tagged_docs(source).collect()}
    assert got == {"rdd": ["a", "B", "", "a"], "empty": [""], "blank": []}
    assert rows(parsers.tokenize_tagged_docs(lines("n,x y,z"))) == [("n", 0, "x"), ("n", 1, "y")]


def test_json_requests(spark, rows):
    df = spark.createDataFrame([
        (1, '{"domain":"d","stream_name":"s","node":"n","op_time":1}'),
        (2, '{"domain":"d","stream_name":"s"}'),
        (3, "{bad"),
        (4, '{"domain":"d","stream_name":"s","node":5}'),
        (5, None),
    ], "id int, req string")
    assert rows(parsers.parse_json_request(df, keep=["id"])) == [(1, "d", "s", "n"), (4, "d", "s", "5")]
    assert rows(parsers.json_extract(df, "req", "op_time bigint", keep=["id"])) == [(1, 1)]


def test_documents(spark, rows):
    df = spark.createDataFrame([("d", 5)], "domain string, cs bigint")
    docs = parsers.to_documents(df, {"domain": "host", "cs": "bytes"}, write_time="2024")
    assert docs.columns == ["host", "bytes", "write_time"] and rows(docs) == [("d", 5, "2024")]


def test_event_time_guard_edges(spark):
    df = spark.createDataFrame([(31104000 - 1,), (31104000,), (-31104000 + 1,), (-31104000,)], "t bigint")
    kept = [r.t for r in df.where(filters.event_time_guard("t", 0)).collect()]
    assert kept == [31103999, -31103999]


def test_domain_lists(lines, rows):
    source = lines("a,1,2,3,4,5,3038,7,8,9,2", "b,1,2,3,4,5,x,7,8,9,1", "a,1,2,3,4,5,3038,7,8,9,2,more", "short,1")
    assert rows(filters.live_domains(source)) == [("a",)]
    assert rows(filters.export_domains(source)) == [("a",)]


def test_parsing_is_done_once(lines, plan_of):
    plan = plan_of(parsers.parse_access_log(lines("x")))
    assert "Python" not in plan and plan.count("gettimestamp") == 1
    requests = lines("{}").withColumnRenamed("line", "req")
    assert plan_of(parsers.parse_json_request(requests)).count("from_json") == 1
