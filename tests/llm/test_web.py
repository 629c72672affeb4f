import html
import math
import re
from collections import Counter

import pytest


from pyspark.sql.functions import lit as spark_lit

from logtide.llm import html_extract, urls

PAGES = "page_id long, url string, html string, host string, path string, text string"


@pytest.fixture
def pages(spark):
    def make(*rows):
        full = [(i, *r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(*r, "h", "p", "t") for r in full], PAGES).repartition(3)

    return make


def test_hosts_paths_and_rules(spark, pages):
    cases = [
        ("http://Example.COM/en/1?q#f", "example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/x", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("https://a.www.example.com/en/x", "a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("ftp://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
        ("http://x.net/fr/1://y.com/", "x.net", "/fr/1://y.com/", "net/fr/", "block"),
        ("http://x.net/FR/", "x.net", "/FR/", None, None),
        ("http://x.com", "x.com", "", None, None),
        ("http://x.com?u=http://y.org/", "x.com", "", None, None),
        ("x.com/en/", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
        ("://net/es/a\nb", "net", "/es/a\nb", "net/es/", "block"),
        ("http://ÄB.com/", "Äb.com", "/", "com/", "allow"),
    ]
    got = {r.page_id: r for r in urls.judge(pages(*[(c[0], None) for c in cases]), queries_rules()).collect()}
    assert len(got) == len(cases)
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), i
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")


def queries_rules():
    from logtide.llm.queries import RULES

    return RULES


def test_names_split_into_words(spark):
    words = spark.createDataFrame([("cheap", 50), ("pills", 40), ("ch", 5), ("eap", 1), ("the", 500), ("re", 300), ("there", 400)], "word string, n long")
    names = spark.createDataFrame([("cheappills",), ("there",), ("zzz",), ("a" * 300,)], "name string")
    got = {r.name: r.words for r in urls.segmented_names(names, words).collect()}
    assert got["cheappills"] == ["cheap", "pills"] and got["there"] == ["there"]
    assert all("".join(w) == n for n, w in got.items())

    def best(name, counts, total):
        def p(w):
            return math.log10(counts[w] / total) if w in counts else 1 - math.log10(total) - len(w)

        options = [[]]
        for i in range(1, len(name)):
            options = [o + [c] for o in options for c in (0, 1)]
        splits = []
        for o in options:
            out, start = [], 0
            for i, c in enumerate(o, 1):
                if c:
                    out.append(name[start:i])
                    start = i
            splits.append(out + [name[start:]])
        return max(sum(map(p, s)) for s in splits)

    counts = {"ab": 5, "abc": 2, "c": 9, "d": 1}
    found = [(s, n, counts["abcd"[s : s + n]]) for s in range(4) for n in range(1, 5 - s) if "abcd"[s : s + n] in counts]
    split = ["abcd"[a : a + n] for a, n in urls.split_name(4, found, 17)]
    value = sum(math.log10(counts[w] / 17) if w in counts else 1 - math.log10(17) - len(w) for w in split)
    assert value == pytest.approx(best("abcd", counts, 17))


def test_verdicts_equal_plain_naive_bayes(spark, data):
    """The whole table against dictionaries."""
    table = spark.read.parquet(f"{data}/pages.parquet")
    got = urls.judge(table, queries_rules()).collect()
    names = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    lexicon = Counter()
    for r in table.collect():
        m = re.search(r"(?is)<title[^>]{0,200}>([^<]*)", r.html or "")
        lexicon.update(w for w in names(m[1] if m else "") if len(w) <= urls.LONGEST_WORD)
    for host, path, ruled in {(r.host, r.path, r.rule is not None and r.verdict) for r in got}:
        lexicon.update(w for w in names(path) if len(w) <= urls.LONGEST_WORD)
    total = sum(lexicon.values())

    def tokens(r):
        out = []
        for name in re.findall(r"[^\W\d_]+", r.host):
            found = [(s, n, lexicon[name[s : s + n]]) for s in range(len(name)) for n in range(1, min(20, len(name) - s) + 1) if name[s : s + n] in lexicon]
            out += [name[a : a + n] for a, n in urls.split_name(len(name), found, total)]
        return out + ["/" + re.sub("[0-9]", "0", w) for w in re.findall(r"[^\W\d_]+|[0-9]+", r.path.lower())]

    counts = {"allow": Counter(), "block": Counter()}
    prior = Counter()
    for r in got:
        if r.rule:
            prior[r.verdict] += 1
            counts[r.verdict].update(tokens(r))
    vocabulary = set(counts["allow"]) | set(counts["block"])
    size = {v: sum(c.values()) + len(vocabulary) for v, c in counts.items()}
    checked = 0
    for r in got:
        if r.rule is None:
            odds = math.log(prior["block"] / prior["allow"]) + sum(
                math.log((counts["block"][t] + 1) / size["block"]) - math.log((counts["allow"][t] + 1) / size["allow"]) for t in tokens(r) if t in vocabulary)
            assert r.log_odds == pytest.approx(odds, abs=1e-6) and r.verdict == ("block" if odds > 0 else "allow")
            checked += 1
    assert checked > 20


def test_nothing_to_judge(pages):
    assert urls.judge(pages(("http://a.org/", None)).limit(0), queries_rules()).count() == 0
    assert [r.verdict for r in urls.judge(pages(("http://a.org/x", "<p>"), ("http://a.org/x", "")), queries_rules()).collect()] == ["allow", "allow"]


def page(article, extra=""):
    return f"<html><head><title>t</title><script>var a='</p><p>no';</script></head><body><nav><ul><li><a href='/'>menu</a></ul></nav>{extra}<article>{article}</article><footer>foot &copy;</footer></body></html>"


CASES = [
    (page("<h1>Head</h1><p>One  two\n three<p>Four <b>bold<br>next</p>"), "Head\nOne two three\nFour bold next"),
    (page("<p>A &lt;b&gt; &amp; &eacute; &#x41;&#66; &am &amp</p>"), "A <b> & é AB &am &"),
    (page("<p>text</p><!-- <p>hidden</p> --><style>p{}</style><aside>side</aside><form>f<input></form><p>more</p>"), "text\nmore"),
    (page("<p>text</p><div class='comments'><p>reader says</p></div><div id=\"sidebar-1\">links</div>"), "text"),
    (page("<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>"), "one\ntwo\nc1\nc2"),
    (page("plain text without blocks"), "plain text without blocks"),
    (page("<p>x</p>", extra="<div class=ad>Buy this now, it is a long advert indeed, and longer.</div>"), "x"),
    ("<div class='wrap'><div class='menu'><a>a</a></div><div class='content'><p>The story is here and goes on.</p><p>End.</p></div><div class='footer'>f</div></div>", "The story is here and goes on.\nEnd."),
    ("", ""), (None, ""), ("<", "<"), ("just text", "just text"), ("<p>unclosed <b>bold", "unclosed bold"), ("<script>only", ""),
]


@pytest.mark.parametrize("source, text", CASES)
def test_text_of_one_page(source, text):
    assert html_extract.text_of(source or "", None) == text


def test_pages_of_a_host_agree_on_a_path(pages):
    body = "<body><div class='post-{0}'><p>{1}</p></div><div class='teaser'><p>{2}</p></div></body>"
    rows = [("http://a.org/1", body.format(i, "story " * 30, "short")) for i in range(5)]
    rows.append(("http://a.org/2", body.format(9, "brief", "a teaser that is longer than the story itself " * 3)))
    rows += [("http://b.org/", "<p>other host</p>"), (None, "<p>no url</p>"), ("http://a.org/", None), ("http://a.org/3", "<div class='x'><p>has no such path</p></div>")]
    got = {r.page_id: r for r in html_extract.extract(pages(*rows)).collect()}
    assert len(got) == len(rows) and got[5].text == "brief"
    assert [got[i].text for i in (6, 7, 8, 9)] == ["other host", "no url", "", "has no such path"]
    assert all(r.n_chars == len(r.text) for r in got.values()) and got[0].url == "http://a.org/1"


def test_extraction_equals_the_articles(spark, data):
    """Every page of the table: the blocks of its article element, read off in a plain way."""
    table = spark.read.parquet(f"{data}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(table).collect()}
    for r in table.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b) if "<br>" in b else re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert got[r.page_id] == "\n".join(w for w in want if w)


LONG = "The story goes on and on. " * 40


@pytest.mark.parametrize("outer, inner", [("div class=content", "div class=body"), ("main", "article"), ("section", "div"), ("article", "section")])
def test_title_and_lead_stay_beside_a_long_body(pages, outer, inner):
    source = f"<body><{outer}><h1>Title</h1><p>lead</p><{inner}>{LONG}</{inner.split()[0]}></{outer.split()[0]}></body>"
    want = f"Title\nlead\n{LONG.strip()}"
    assert html_extract.text_of(source, None) == want
    bare = f"<body><{outer}><{inner}>{LONG}</{inner.split()[0]}></{outer.split()[0]}></body>"
    rows = [("http://a.org/1", bare)] * 3 + [("http://a.org/2", source)]
    assert [r.text for r in html_extract.extract(pages(*rows)).orderBy("page_id").collect()] == [LONG.strip()] * 3 + [want]


@pytest.mark.parametrize("tag", ["main class='site-main has-sidebar'", "article class='post comments-open'", "article class='post related'",
                                 "div class='content no-sidebar'", "div id=content class='with-header'", "div class='widget'"])
def test_names_do_not_drop_the_only_article(tag):
    source = f"<body><nav>menu</nav><{tag}><h1>Title</h1><p>text</p><div class='related'>other</div></{tag.split()[0]}></body>"
    assert html_extract.text_of(source, None) == ("Title\ntext\nother" if "widget" in tag else "Title\ntext")


def test_no_pages(pages):
    assert html_extract.extract(pages(("http://a.org/", "x")).limit(0)).count() == 0


ARTICLE = "<p>First part of the text.</p><p>Second part of the text.</p><p>Third part of the text.</p>"
PARTS = ["First part of the text.", "Second part of the text.", "Third part of the text."]


@pytest.mark.parametrize("source, lines", [
    (f"<body><form id=aspnet><div class=main>{ARTICLE}</div></form></body>", PARTS),
    (f"<body><form><article>{ARTICLE}</article></form><p>(c) us</p></body>", PARTS),
    (f"<body><article>{ARTICLE}<form><p>Your name</p><input></form></article></body>", PARTS),
    (f"<article>{ARTICLE.replace('</p><p>Second', '</p><svg class=i /><p>Second')}</article>", PARTS),
    (f"<article>{ARTICLE.replace('</p><p>Second', '</p><iframe src=x /><p>Second')}</article>", PARTS),
    (f"<article>{ARTICLE.replace('</p><p>Second', '</p><svg><text>drawn</text></svg><p>Second')}</article>", PARTS),
    (f"<article>{ARTICLE.replace('</p><p>Second', '</p><button>more<p>Second')}</article>", [PARTS[0], "more", *PARTS[1:]]),
    (f"<article>{ARTICLE.replace('</p><p>Second', '</p><button>more</button><p>Second')}</article>", PARTS),
    (f"<article><p title=Bob's>{ARTICLE[3:]}</article>", PARTS),
    (f"<article><p title=\"a>b\" alt='it is > \"that\"'>{ARTICLE[3:]}<p>It's 'so' = \"this\"</p></article>", [*PARTS, "It's 'so' = \"this\""]),
    (f"<article>{ARTICLE}<p class='social'>On society.</p><div id='notice'>Take note of this.</div><p class='related-work'>Others did too.</p></article>",
     [*PARTS, "On society.", "Take note of this.", "Others did too."]),
    (f"<article>{ARTICLE}<div class='related'><a href=x>One more</a> <a href=y>Another</a></div></article>", PARTS),
    (f"<article>{ARTICLE}<div class='ad'>Buy now</div><div class='comments'><p>Nice</p></div></article>", PARTS),
    (f"<body><article>{ARTICLE}</article><article class='comment'><p>A reader's own words</p></article></body>", PARTS),
    ("<article class='comment'><p>only a reader</p></article>", ["only a reader"]),
    ("<p>a</p><script>if (a < b) { x = '</p>' }</script><p>b</p><style>p {}", ["a", "b"]),
    ("<p>a < b and c > d</p><p>x <3 y</p>", ["a < b and c > d", "x <3 y"]),
])
def test_main_text_is_kept_and_no_more(source, lines):
    assert html_extract.text_of(source, None) == "\n".join(lines)


def test_many_open_tags_take_no_longer():
    import time

    began = time.time()
    html_extract.text_of("<svg class=x><button><a b='" * 20_000 + "text", None)
    assert time.time() - began < 20


def test_long_titles_and_words_count(spark, pages):
    word = "pneumonoultramicroscopic"
    rows = pages(("http://a.org/", f"<title class=\"{'x' * 500}\">{word} {word}</title>"))
    urls_seen = rows.select(spark_lit("").alias("path"))
    assert {(r.word, r.n) for r in urls.lexicon(rows, urls_seen).collect()} == {(word, 2)}
