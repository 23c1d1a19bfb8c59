"""Official list pages: links chosen by a CSS selector, in a Python table function; what fails is a row too.

Selectors: compounds of tag, #id, .class and [attribute], [a=v], [a~=v], [a^=v], [a$=v], [a*=v], joined by white space
(descendant) or > (child), alternatives by commas.  Anything else is a bad selector.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = r"-?[A-Za-z_\u0080-\U0010FFFF][-\w\u0080-\U0010FFFF]*"
_PART = re.compile(rf"""(?P<tag>\*|{_NAME})|\#(?P<id>{_NAME})|\.(?P<cls>{_NAME})|\[\s*(?P<attr>[-\w:]+)\s*(?:(?P<op>[~^$*]?=)\s*(?:"(?P<v1>[^"]*)"|'(?P<v2>[^']*)'|(?P<v3>{_NAME}))\s*)?\]""")
_JOIN = re.compile(r"\s*(>)\s*|\s+")
#: Elements without content or end tag.
_VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})
NOT_FETCHED, BAD_SELECTOR, NO_LINKS = "not_fetched", "bad_selector", "no_links"


class Element(NamedTuple):
    tag: str
    attrs: dict[str, str]


class Compound(NamedTuple):
    """Tests that one element must pass, and how it stands to the compound before it: " " or ">"."""

    join: str
    tests: list[tuple[str, str, str]]

    def fits(self, e: Element) -> bool:
        return all(_passes(e, *test) for test in self.tests)


def _passes(e: Element, name: str, op: str, value: str) -> bool:
    if op == "tag":
        return value in ("*", e.tag)
    if name not in e.attrs:
        return False
    own = e.attrs[name]
    match op:
        case "":
            return True
        case "=":
            return own == value
        case "~=":
            return bool(value) and value in own.split()
        case "^=":
            return bool(value) and own.startswith(value)
        case "$=":
            return bool(value) and own.endswith(value)
        case _:
            return bool(value) and value in own


def parsed(selector: str) -> list[list[Compound]]:
    """The alternatives of a selector, each a chain of compounds; ValueError for what is beyond the grammar above."""
    out, chain, tests, join, at = [], [], [], " ", 0
    text = selector.strip()

    def close():
        if not tests:
            raise ValueError(f"bad selector {selector!r}")
        chain.append(Compound(join, list(tests)))
        tests.clear()

    while at < len(text):
        if text[at] == ",":
            close()
            out.append(list(chain))
            chain.clear()
            join, at = " ", at + 1 + len(text[at + 1 :]) - len(text[at + 1 :].lstrip())
        elif (m := _JOIN.match(text, at)) and m.end() < len(text):
            at = m.end()
            if text[at] != ",":
                close()
                join = m[1] or " "
        elif (m := _PART.match(text, at)) and not (m["tag"] and tests):
            at = m.end()
            if m["tag"]:
                tests.append(("", "tag", m["tag"].lower()))
            elif m["id"]:
                tests.append(("id", "=", m["id"]))
            elif m["cls"]:
                tests.append(("class", "~=", m["cls"]))
            else:
                tests.append((m["attr"].lower(), m["op"] or "", next((v for v in (m["v1"], m["v2"], m["v3"]) if v is not None), "")))
        else:
            raise ValueError(f"bad selector {selector!r}")
    close()
    return [*out, list(chain)]


def chosen(path: list[Element], chain: list[Compound]) -> bool:
    """The last element of the path, root first, is one that the chain selects."""

    def reaches(i: int, at: int) -> bool:
        if not chain[i].fits(path[at]):
            return False
        if i == 0:
            return True
        above = range(at - 1, at - 2, -1) if chain[i].join == ">" else range(at - 1, -1, -1)
        return any(k >= 0 and reaches(i - 1, k) for k in above)

    return reaches(len(chain) - 1, len(path) - 1)


class _Reader(HTMLParser):
    """Collects the chosen elements in document order: [attributes, texts]."""

    def __init__(self, chains: list[list[Compound]]):
        super().__init__(convert_charrefs=True)
        self.chains, self.path, self.found = chains, [], []
        self.open: list[tuple[int, list]] = []  # depth and entry of chosen elements that are not closed
        self.last = ""

    def _flush(self) -> None:
        words = self.last.strip()
        if words and not (self.path and self.path[-1].tag in ("script", "style")):
            for _, entry in self.open:
                entry[1].append(words)
        self.last = ""

    def handle_starttag(self, tag, attrs):
        self._flush()
        self.path.append(Element(tag, {k: v or "" for k, v in reversed(attrs)}))
        if any(chosen(self.path, c) for c in self.chains):
            entry = [self.path[-1].attrs, []]
            self.found.append(entry)
            self.open.append((len(self.path), entry))
        if tag in _VOID:
            self._drop(len(self.path) - 1)

    def handle_endtag(self, tag):
        self._flush()
        at = next((i for i in range(len(self.path) - 1, -1, -1) if self.path[i].tag == tag), None)
        if at is not None:
            self._drop(at)

    def handle_data(self, data):
        self.last += data

    def _drop(self, at: int) -> None:
        del self.path[at:]
        self.open = [(d, e) for d, e in self.open if d <= at]

    def close(self):
        super().close()
        self._flush()


def links(html: str | None, selector: str | None, base: str | None) -> tuple[list[tuple[str, str]], str | None]:
    """((absolute URL, text) of the chosen elements with a link, why the page counts as failed)."""
    if html is None:
        return [], NOT_FETCHED
    try:
        reader = _Reader(parsed(selector or ""))
    except ValueError:
        return [], BAD_SELECTOR
    reader.feed(html)
    reader.close()
    if not reader.found:
        return [], NO_LINKS
    out = []
    for attrs, texts in reader.found:
        if attrs.get("href", "").strip():
            try:
                out.append((urljoin(base or "", attrs["href"]), " ".join(texts)))
            except ValueError:
                continue
    return out, None


class _ListPage:
    """Rows of one list page: its links, or one row that says why there is none."""

    def eval(self, html: str, selector: str, base: str):
        found, failure = links(html, selector, base)
        for pos, (url, title) in enumerate(found):
            yield pos, url, title, None
        if failure:
            yield None, None, None, failure


def table_function(spark: SparkSession):
    """The table function list_page(html, selector, base), also registered for SQL in this session."""
    function = F.udtf(_ListPage, returnType="pos int, url string, title string, failure string")
    spark.udtf.register("list_page", function)
    return function


def collected(pages: DataFrame, id_col: str = "list_id") -> DataFrame:
    """(list_id, domain, pos, url, title, failure): one row per link of each list page, or one row with its failure.

    pages: list_id, domain, list_url, link_selector, status (HTTP, null if unreachable), html.  A page that was not
    fetched with a status from 200 to 299, a bad selector and a page without any chosen element are failures; chosen
    elements without an address are passed over.
    """
    page = table_function(pages.sparkSession)
    got = F.when(F.coalesce(F.col("status").between(200, 299), F.lit(False)), F.col("html"))
    asked = pages.select(F.col(id_col).alias("list_id"), "domain", "list_url", "link_selector", got.alias("html"))
    rows = asked.lateralJoin(page(F.col("html").outer(), F.col("link_selector").outer(), F.col("list_url").outer()))
    return rows.select(F.col("list_id").alias(id_col), "domain", "pos", "url", "title", "failure")


def failed_domains(rows: DataFrame) -> DataFrame:
    """(domain) of the list pages that failed, each once."""
    return rows.where("failure is not null").select("domain").distinct()


def candidates(rows: DataFrame) -> DataFrame:
    """Links as candidates, with the list as their source; pages that failed give none."""
    return rows.where("failure is null").select("title", "url", F.concat(F.lit("official:"), "domain").alias("discovery_source"))
