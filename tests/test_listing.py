"""List pages: selectors, decoy links, failures."""

import pytest

from gleaner.sources import listing

PAGE = """<html><body><div class="top"><a href="/decoy">首页</a></div>
<ul class="news-list wide" id="main"><li><a href="/n/1" class="t">公告 <b>一</b>
 甲</a></li><li><p><a href=" ../n/2?x=1">公告二</a></p></li><li><a name="k">无址</a></li><li><a href="">空</a></li></ul>
<ul class="news-list-old"><li><a href="/decoy2">旧</a></li></ul><div class="news-list"><img src="a"><a href="https://o.cn/3">三<script>x()</script></a></div></body></html>"""


@pytest.mark.parametrize(
    ("selector", "want"),
    [
        ("ul.news-list a[href]", ["公告 一 甲", "公告二"]),
        ("div.news-list a[href]", ["三"]),
        ("ul.news-list > li > a[href]", ["公告 一 甲"]),
        ("#main a.t, div.news-list>a", ["公告 一 甲", "三"]),
        ("a[href^='https:'] , a[href$=\"decoy\"]", ["首页", "三"]),
        ("UL.wide LI a[href*=n]", ["公告 一 甲", "公告二"]),
        ("*[class~=wide] p a", ["公告二"]),
        ("ul a[name=k]", []),
    ],
)
def test_selectors(selector, want):
    found, failure = listing.links(PAGE, selector, "https://a.cn/list/index.html")
    assert [t for _, t in found] == want and failure is None


@pytest.mark.parametrize("selector", ["", "a[", "a:first-child", "a >", "> a", "a,,b", "a,", "ul li..x", "a b#", None, "a + b", "aul*"])
def test_bad_selectors(selector):
    assert listing.links(PAGE, selector, "https://a.cn/") == ([], listing.BAD_SELECTOR)


def test_addresses_and_failures():
    found, _ = listing.links(PAGE, "ul.news-list a[href]", "https://a.cn/list/index.html")
    assert [u for u, _ in found] == ["https://a.cn/n/1", "https://a.cn/n/2?x=1"]
    assert listing.links(PAGE, "table a", "https://a.cn/")[1] == listing.NO_LINKS == listing.links("", "a", "b")[1]
    assert listing.links(None, "a", "b")[1] == listing.NOT_FETCHED


def test_collected_lists(spark):
    rows = [(1, "a.cn", "https://a.cn/l/", "ul.news-list a[href]", 200, PAGE), (2, "a.cn", "https://a.cn/2", "a[", 200, PAGE), (3, "b.cn", "https://b.cn/", "a", 503, PAGE), (4, "c.cn", "https://c.cn/", "table a", 200, PAGE), (5, "d.cn", "https://d.cn/", "a", None, None)]
    pages = spark.createDataFrame(rows, "list_id long, domain string, list_url string, link_selector string, status int, html string")
    out = listing.collected(pages)
    assert sorted((r.list_id, r.pos, r.url) for r in out.where("failure is null").collect()) == [(1, 0, "https://a.cn/n/1"), (1, 1, "https://a.cn/n/2?x=1")]
    assert {r.list_id: r.failure for r in out.where("failure is not null").collect()} == {2: "bad_selector", 3: "not_fetched", 4: "no_links", 5: "not_fetched"}
    assert sorted(r.domain for r in listing.failed_domains(out).collect()) == ["a.cn", "b.cn", "c.cn", "d.cn"]
    assert {tuple(r) for r in listing.candidates(out).collect()} == {("公告 一 甲", "https://a.cn/n/1", "official:a.cn"), ("公告二", "https://a.cn/n/2?x=1", "official:a.cn")}
    assert listing.collected(pages.limit(0)).collect() == []
