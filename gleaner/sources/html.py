"""Page rows from HTML: title, text, publication date evidence, links.  Parsing is Arrow-batched standard library code."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SKIP = frozenset({"script", "style", "nav", "noscript"})
_VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})
_DATE_META = ("article:published_time", "datepublished", "publishdate", "pubdate", "date")
_DATE = re.compile(r"^\s*(?:19|20)\d{2}[-/.年]\d{1,2}[-/.月]\d{1,2}")
_HEADER_DATE = re.compile(r"(?:发布时间|发布日期|published)\s*[:：]?\s*((?:19|20)\d{2}[-/.年]\d{1,2}[-/.月]\d{1,2}日?(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?)", re.I)


class Page(HTMLParser):
    """Title, text without scripts and navigation, links with their classes, date metadata, JSON-LD blocks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.texts, self.links, self.meta, self.json = "", [], [], {}, []
        self._open: list[str] = []
        self._link: list | None = None
        self._ld: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            name = (a.get("property") or a.get("name") or a.get("itemprop") or "").lower()
            self.meta.setdefault(name, a.get("content", ""))
        elif tag == "time" and a.get("datetime"):
            self.meta.setdefault("time", a["datetime"])
        elif tag == "a" and a.get("href"):
            self._link = [a["href"], [], list(self._open)]
        if tag == "script" and a.get("type", "").lower() == "application/ld+json":
            self._ld = []
        if tag not in _VOID:
            self._open.append(tag)

    def handle_endtag(self, tag):
        if tag == "a" and self._link:
            self.links.append((self._link[0], " ".join("".join(self._link[1]).split())))
            self._link = None
        if tag == "script" and self._ld is not None:
            self.json.append("".join(self._ld))
            self._ld = None
        if tag in self._open:
            while self._open.pop() != tag:
                pass

    def handle_data(self, data):
        if self._ld is not None:
            self._ld.append(data)
        if self._link is not None:
            self._link[1].append(data)
        if self._open and self._open[-1] == "title":
            self.title += data
        elif not _SKIP & set(self._open) and data.strip():
            self.texts.append(data.strip())


def parse(html: str | None) -> Page:
    page = Page()
    page.feed(html or "")
    page.close()
    return page


def json_date(value) -> str | None:
    """The first datePublished anywhere in a JSON value, breadth after depth."""
    if isinstance(value, dict):
        if isinstance(value.get("datePublished"), str):
            return value["datePublished"]
        value = list(value.values())
    if isinstance(value, list):
        return next((d for v in value if (d := json_date(v))), None)
    return None


def date_evidence(page: Page) -> tuple[str | None, str | None]:
    """(date text, where it was found): metadata, then JSON-LD, then the visible header."""
    for name in (*_DATE_META, "time"):
        if _DATE.match(page.meta.get(name, "")):
            return page.meta[name].strip(), f"meta:{name}"
    for block in page.json:
        try:
            found = json_date(json.loads(block))
        except ValueError:
            continue
        if found and _DATE.match(found):
            return found.strip(), "json-ld"
    for line in page.texts[:40]:
        if m := _HEADER_DATE.search(line):
            return m.group(1), "header"
    return None, None


def page_rows(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, title, text_sha256, n_chars, published, evidence) of every page."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = []
            for html in b.column("html").to_pylist():
                p = parse(html)
                when, where = date_evidence(p)
                rows.append((" ".join(p.title.split()), "\n".join(p.texts), when, where))
            title, text, when, where = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(x, pa.string()) for x in (title, text, when, where))], ["id", "title", "text", "published", "evidence"])

    pages = df.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).mapInArrow(run, f"id {kind}, title string, text string, published string, evidence string")
    return pages.select(F.col("id").alias(id_col), "title", F.sha2("text", 256).alias("text_sha256"), F.char_length("text").cast("long").alias("n_chars"), "published", "evidence")


def page_links(df: DataFrame, id_col: str, base_col: str, html_col: str) -> DataFrame:
    """(id, pos, url, title) of every http(s) link, made absolute; pages without links give no rows (a failed list)."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = []
            for key, base, html in zip(b.column("id").to_pylist(), b.column("base").to_pylist(), b.column("html").to_pylist(), strict=True):
                for pos, (href, title) in enumerate(parse(html).links):
                    try:
                        url = urljoin(base or "", href.strip())
                        ok = urlsplit(url).scheme in ("http", "https")
                    except ValueError:
                        continue
                    if ok:
                        out.append((key, pos, url, title))
            keys, pos, url, title = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field("id").type), pa.array(pos, pa.int32()), pa.array(url, pa.string()), pa.array(title, pa.string())], ["id", "pos", "url", "title"])

    return df.select(F.col(id_col).alias("id"), F.col(base_col).alias("base"), F.col(html_col).alias("html")).mapInArrow(run, f"id {kind}, pos int, url string, title string").withColumnRenamed("id", id_col)
