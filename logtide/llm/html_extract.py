"""Main text of web pages, by container paths that the pages of a host agree on.

Every page scores its containers (text that is not link text, less what lies in nested
containers of no use); its best container votes, under its path of tags and classes with
digits as one sign, for its host. The votes are summed in Spark; then each page is read
again and its text taken from its host's winning path, or from its own best container
where it has none of that path, or where its own holds those and more main text. An inner
container is chosen over the one around it only for a score at least as high: where the outer
one has more main text, all of it stays, unless links outweigh it or the inner one is an
article or main element, whose text counts half as much again. Boxes named as teasers, outside of articles, are junk.

Elements named as junk are left out, except for main elements, articles that are not named as a reader's, and pages that
have no other text. Inside an article some names are no evidence; what they name is left out if more than half of it is
links. Forms are left out unless more text stands in them than outside: then they wrap the page.

Defined results: a null or empty page has an empty text; pages without a url vote together;
on a tie the smaller path wins; a page of several containers with the winning path gives
all of them in page order; repeated pages vote and are answered each; an empty table gives
no rows. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_through
from .urls import url_columns

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # Quotes hold a value only behind an equals sign that they close; any other quote is a character.
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<[!?][^>]*>",
    re.S | re.I)
RAW = frozenset("noscript script style template textarea".split())  # to their end tag, or to the end of the page
SKIPPED = frozenset("button iframe select svg".split())  # to their end tag, if they have one of their own
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article body div main section td".split())
DROPPED = frozenset("aside dialog footer form head header menu nav title".split())
JUNK_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer footer "
    "header login masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related "
    "reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar warning widget".split())
MODIFIERS = frozenset("has no with without".split())  # a name that begins or ends so says what else is there
STATES = frozenset("closed disabled enabled off on open".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond".split())  # an article so named is a reader's
# Inside an article these names alone are no evidence: what they name goes only if it is mostly links, or a box of related pages.
WEAK_WORDS = frozenset("disclaimer footer header masthead menu modal notice notices related reply replies respond social warning widget".split())
BOX_WORDS = frozenset("teaser teasers".split())  # of containers outside of articles: lead-ins to other pages


@dataclass
class Node:
    tag: str
    path: str
    dropped: bool  # it or what it stands in holds no main text
    linked: bool
    weak: bool = False  # left out if it is mostly links
    first: int = 0  # number of the last block before it
    own: int = 0  # characters of main text, whole subtree
    links: int = 0
    blocks: list[tuple[int, str]] = field(default_factory=list)  # for containers only


def _names(attributes: str) -> tuple[str, set[str]]:
    """The class as part of a path, and the words of class, id and role, without names like has-sidebar or comments-open."""
    classes, words = "", set()
    for key, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        for name in value.split():
            parts = _WORDS.findall(name)
            if len(parts) < 2 or parts[0] not in MODIFIERS and parts[-1] not in STATES:
                words.update(parts)
        if key.lower() == "class":
            classes = "".join("." + re.sub(r"[0-9]+", "0", c) for c in sorted(value.split()))
    return classes, words


def _end_of(page: str, tag: str, at: int, ends: dict[str, int]) -> int:
    """Where the end tag of ``tag`` begins, from ``at`` on; -1 if there is none. Each is looked for once."""
    if ends.get(tag, 0) != -1 and ends.get(tag, 0) < at:
        found = re.compile(f"</{tag}(?![a-z0-9:-])", re.I).search(page, at)
        ends[tag] = found.start() if found else -1
    return ends.get(tag, 0)


def read_page(page: str, by_name: bool = True, forms: bool = False) -> list[Node]:
    """All containers of a page, in page order, each with the blocks of main text in its subtree.

    ``by_name`` drops elements by their names too; a page that has no other text is read without.
    ``forms`` keeps what stands in forms; a page with most of its text there is read so.
    """
    root = Node("", "", False, False)
    stack, found = [root], []
    text: list[str] = []
    order = in_forms = 0
    named = False
    gone: set[int] = set()  # numbers of blocks in weakly named link lists
    ends: dict[str, int] = {}

    def end_block() -> None:
        nonlocal order
        if not text:
            return
        joined = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if joined and not stack[-1].dropped:
            order += 1
            for node in stack:
                if node.tag in CONTAINER or not node.tag:
                    node.blocks.append((order, joined))

    def add(raw: str) -> None:
        nonlocal in_forms
        if not raw:
            return
        n = len(raw.strip())
        if stack[-1].dropped:
            # Only the form itself stands in the way of this text.
            in_forms += n * all(not node.dropped or node.tag == "form" or above.dropped for above, node in zip(stack, stack[1:])) * any(node.tag == "form" for node in stack)
            return
        text.append(raw)
        linked = stack[-1].linked
        for node in stack:
            node.own += n
            node.links += n * linked

    def close(size: int) -> None:
        while len(stack) > size:
            node = stack.pop()
            if node.weak and 2 * node.links > node.own:
                gone.update(range(node.first + 1, order + 1))

    at = 0
    while m := _PIECE.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if (tag in RAW or tag in SKIPPED) and not m[1]:
            end = _end_of(page, tag, at, ends)
            if m[3].endswith("/") and tag in SKIPPED:
                continue
            if tag in RAW:
                at = len(page) if end < 0 else end
            elif end >= 0 and not (tag in ("button", "select") and re.compile(f"<{tag}(?![a-z0-9:-])", re.I).search(page, at, end)):
                at = end
            continue
        if tag in RAW or tag in SKIPPED:
            continue
        if tag in BLOCK:
            end_block()
        if m[1]:
            open_at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if open_at:
                close(open_at)
        elif tag == "br":
            add(" ")
        elif tag not in VOID:
            if tag in BLOCK:
                # An open paragraph, or an item of the same kind, ends where the next block begins.
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p" or stack[i].tag == tag and tag in ("li", "td", "th", "tr", "dd", "dt"):
                        close(i)
                        break
                    if stack[i].tag in BLOCK:
                        break
            classes, words = _names(m[3]) if m[3] else ("", set())
            within_article = any(node.tag == "article" for node in stack)
            weak = within_article and not words & (JUNK_WORDS - WEAK_WORDS) and bool(words & WEAK_WORDS) and not (tag in CONTAINER and "related" in words)
            if tag in ("body", "html", "main"):
                junk = False
            elif tag == "article":
                junk = bool(words & COMMENT_WORDS)
            else:
                junk = bool(words & JUNK_WORDS) and not weak or bool(words & BOX_WORDS) and tag in CONTAINER and not within_article
            junk = junk and by_name
            named = named or junk
            outside = tag in DROPPED and not (tag == "header" and within_article) and not (tag == "form" and forms)
            node = Node(tag, f"{stack[-1].path}/{tag}{classes}", stack[-1].dropped or junk or outside, stack[-1].linked or tag == "a", weak and by_name, order)
            stack.append(node)
            if tag in CONTAINER and not node.dropped:
                found.append(node)
    add(page[at:])
    end_block()
    close(1)
    if not forms and in_forms > root.own:
        return read_page(page, by_name, True)
    if named and not root.blocks:
        return read_page(page, False, forms)
    if gone and gone >= {n for n, _ in root.blocks}:
        gone.clear()
    for node in [root, *found] if gone else []:
        node.blocks = [block for block in node.blocks if block[0] not in gone]
    return found or [root]


def score(node: Node) -> float:
    """Characters of text outside of links, less those in links; an article or main element counts more."""
    return (node.own - 2 * node.links) * (1.5 if node.tag in ("article", "main") else 1.0)


def best_container(nodes: list[Node]) -> Node:
    """The container of the highest score; of equal scores the innermost, that is, the last."""
    best = nodes[0]
    for node in nodes[1:]:
        if score(node) >= score(best):
            best = node
    return best


def page_votes(pages: DataFrame) -> DataFrame:
    """host, path, weight: each page's best container, weighed by the root of its score."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best = [best_container(read_page(page or "")) for page in batch["html"]]
            yield pd.DataFrame({"host": batch["host"], "path": [n.path for n in best], "weight": [max(score(n), 0.0) ** 0.5 for n in best]})

    return pages.mapInPandas(vote, "host string, path string, weight double").filter("weight > 0")


def winning_paths(votes: DataFrame) -> DataFrame:
    """One path per host: the one with the most votes."""
    sums = votes.groupBy("host", "path").agg(F.sum(F.round(F.col("weight") * 1000).cast("long")).alias("weight"))
    return sums.groupBy("host").agg(F.min(F.struct(-F.col("weight"), "path")).getField("path").alias("path"))


def text_of(page: str, path: str | None) -> str:
    """The page's blocks in containers of ``path``, or in its own best container if it has none or that holds them all."""
    nodes = read_page(page)
    best = best_container(nodes)
    chosen = [n for n in nodes if n.path == path and n.blocks]
    if {b for n in chosen for b in n.blocks} <= set(best.blocks):
        chosen = [best]
    return "\n".join(text for _, text in sorted({b for n in chosen for b in n.blocks}))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    hosted = pages.select("page_id", "url", "html", url_columns()[0].alias("host"))
    # Few bytes per host: written first, so that the join is planned by its true size (a broadcast if small, else a sort-merge join).
    paths = write_through(winning_paths(page_votes(hosted.select("host", "html"))), "paths")
    found = hosted.join(paths.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left").drop("_host", "host")
    kinds = dict(pages.dtypes)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["text"] = [text_of(page or "", path) for page, path in zip(batch["html"], batch["path"])]
            yield batch[["page_id", "url", "text"]]

    texts = found.mapInPandas(read, f"page_id {kinds['page_id']}, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
