from pyspark.sql import functions as F

from logtide.functions import net, text, times, vectors


def values(spark, expression, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_strict_long_takes_sign_and_digits_only(spark):
    got = values(spark, text.strict_long("s"), ["12", "+12", "-12", " 12 ", "12a", "", "1.0", "9" * 19, None])
    assert got == [12, 12, -12, None, None, None, None, None, None]


def test_split_trimmed_drops_empty_pieces_at_the_end_only(spark):
    got = values(spark, text.split_trimmed("s", "/"), ["a/b//", "/a", "//", "", "a", "a//b"])
    assert got == [["a", "b"], ["", "a"], [], [""], ["a"], ["a", "", "b"]]


def test_split_cells_keeps_empty_cells(spark):
    assert values(spark, text.split_cells("s"), ["a,,b,,", ""]) == [["a", "", "b", "", ""], [""]]


def test_text_after(spark):
    assert values(spark, text.text_after("s", "]", 1), ["x] a]b", "none", "]"]) == ["a]b", None, ""]


def test_floors_keep_other_text(spark):
    texts = ["0", "59", "60", "3661", "abc", " 60", "-61"]
    assert values(spark, times.minute_floor("s"), texts) == ["0", "0", "60", "3660", "abc", " 60", "-60"]
    assert values(spark, times.hour_floor("s"), texts) == ["0", "0", "0", "3600", "abc", " 60", "0"]


def test_five_minute_mark_moves_exact_marks_forward(spark):
    got = values(spark, times.five_minute_mark(F.col("s").cast("bigint")), ["0", "1", "299", "300", "599"])
    assert got == [300, 300, 300, 600, 600]


def test_day_range_and_shift(spark):
    df = spark.createDataFrame([("20240228", "20240301"), ("20240302", "20240301"), ("x", "20240301")], "a string, b string")
    got = [r[0] for r in df.select(times.day_range("a", "b", "yyyyMMdd")).collect()]
    assert got == [["20240228", "20240229", "20240301"], [], []]
    step = [r[0] for r in df.limit(1).select(times.day_range("a", "b", "yyyyMMdd", 2)).collect()]
    assert step == [["20240228", "20240301"]]
    assert values(spark, times.plus_days("s", "yyyyMMdd", 10), ["20171222", "bad"]) == ["20180101", None]


def test_log_times(spark):
    lines = [
        "h [2/Jan/2024:3:4:5 +0800] x",
        "h [02/Jan/2024:03:04:05] x",
        "h ] [02/Jan/2024:03:04:05 +0800]",
        "no brackets",
        "h [not a time] x",
        "h [31/Feb/2024:00:00:00 +0000]",
    ]
    local = 1704164645
    assert values(spark, times.log_seconds("s"), lines) == [local, local, None, None, None, None]
    assert values(spark, times.log_hour("s"), lines) == ["2024/01/01/19", None, None, None, None, None]


def test_ip_to_long(spark):
    texts = ["10.0.0.1", "1.2", "300.1.1.1", "bad.ip", "", "...", "1.2.3.4.", "1. 2.3.4", "99999999999.1"]
    expected = [167772161, 258, 300 * 2**24 + 65793, -1, -1, 0, 16909060, -1, -1]
    assert values(spark, net.ip_to_long("s"), texts) == expected


def test_url_parts(spark):
    parts = net.url_parts("s")
    row = F.struct(*[c.alias(n) for n, c in parts.items()])
    got = [tuple(r) for r in values(spark, row, ["http://d/a/b?x=1", "http://d/a/", "http://d//b", "http://d"])]
    assert got == [("d", "a", "b?x=1"), ("d", "a", None), ("d", "", "b"), ("d", None, None)]


def test_export_and_archive_names(spark):
    assert values(spark, text.archive_key("s"), ["2024/01/02/03"]) == ["2024/01/02/03_2024-01-02-03"]
    got = values(spark, text.export_path("s"), ["d.com/2024/01/02/03", "d.com/2024/01/02/x/04", "short/2024"])
    assert got == ["/d.com/2024-01-02/2024-01-02_03", "/d.com/2024-01-02/2024-01-02_04", None]


def test_cosine(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(vectors.cosine_similarity("a", "b")).collect()]
    assert abs(got[0] - 0.96) < 1e-12 and got[1] is None


def test_delimiters_at_the_end_are_cut_as_by_the_pattern_and_others_not_searched(spark, plan_of):
    ends = ["", "\n", "\r\n", "\r", "\u0085", " ", " ", "\n\n", " "]
    made = [(head + mark * n + end,) for head in ("", "a", "a::b", ":", "é::") for mark in ("::", ":") for n in range(4) for end in ends] + [(None,)]
    df = spark.createDataFrame(made, "t string")
    both = df.select(text.trim_end("t", "::").alias("got"), F.regexp_replace("t", "(?:::)+$", "").alias("want"))
    assert both.where(~F.col("got").eqNullSafe(F.col("want"))).count() == 0
    assert "EndsWith(" in plan_of(df.select(text.split_trimmed("t", "::")))
