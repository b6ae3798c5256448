"""Hand-written pages, one per branch, with the result worked out by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from pressframe.operators import content, head, navigation
from pressframe.plans import articles, discovery
from pressframe.sources.dom import flatten_dom
from pressframe.sources.pages import write_stage


def og(text):
    return f'<meta property="og:title" content="{text}">'


def ld(text):
    return f'<script type="application/ld+json">{text}</script>'


LONG, SHORT = "w " * 125, "w " * 75
PAGES = {
    "longest": og("short") + ld('{"headline": "a longer one"}') + "<article><h1>mid one</h1></article>",
    "too_long": og("x" * 250) + "<h1>page</h1>",
    "limit": og("x" * 199),
    "tie": "<article><h1>cccc</h1></article>" + ld('{"headline": "bbbb"}') + og("aaaa"),
    "ld_list": ld('[{"headline": "x"}]') + "<h1>page</h1>",
    "ld_bad": ld('{"headline": ') + "<h1>page</h1>",
    "ld_tail": ld('{"headline": "x"} tail') + "<h1>page</h1>",
    "ld_tail2": ld('{"headline": "x"}, {"headline": "y"}') + "<h1>page</h1>",
    "ld_tail3": ld('{"headline": "x"}}') + "<h1>page</h1>",
    "ld_twice": ld('{"headline": "x", "headline": "last"}'),
    "ld_null": ld('{"headline": null}') + "<h1>page</h1>",
    "ld_number": ld('{"headline": 7}'),
    "ld_second": ld("") + ld('{"headline": "x"}') + "<h1>page</h1>",
    "h1_outside": "<h1>out</h1><article><p>x</p></article>",
    "meta_second": '<meta property="article:published_time" content="soon"><meta property="article:published_time">'
                   '<meta property="og:published_time" content="2020-05-06">',
    "ld_date": ld('{"datePublished": "May 6, 2020 10:00"}') + "<p>2019-01-01</p>",
    "ld_bad_date": ld('{"datePublished": "never"}') + "<p>2019-01-01</p>",
    "ld_number_date": ld('{"datePublished": 2020}') + "<p>2019-01-01</p>",
    "published": "<p>on 3/4/21</p><p>Published 2024-01-05</p>",
    "class_tie": '<div class="News Date"><p>5/6/2020</p></div><p>Posted 2021-01-02</p>',
    "same_pattern": "<p>Posted 1/2/2021</p><p>Posted 3/2/2021</p>",
    "future": "<p>2099-01-01</p>", "nonsense": "<p>13/13/2024 and Mayor 12, 2020</p>",
    "in_script": "<script>var d='2020-01-01'</script><!-- 2020-01-02 --><p>x</p>",
    "split_word": "<div><i>Pub</i>lished <b>2020-01-01</b></div><div><b>2019-01-01</b></div><p><i>re</i>leased 2018-01-01</p>",
    "body": "<article><p>P</p><h2>H</h2><ul><li>L<ul><li>M</li></ul></li></ul><span>loose</span>div text<p> </p></article>",
    "cut": "<article><p>a</p><p>About Acme</p><p>b</p><table><tr><td>x</td></tr></table></article>",
    "cut_plain": "<article><p>About Acme, Inc.</p><p>b</p></article>",
    "cut_bold": "<article><p><b>About Acme, Inc.</b></p><p>b</p></article>",
    "cut_style": '<article><p style="font-weight: bold">About Acme, Inc.</p><p>b</p></article>',
    "cut_class": '<article><p class="bold">About Acme, Inc.</p><p>b</p></article>',
    "cut_class_off": '<article><p class="lead">About Acme, Inc.</p><p>b</p></article>',
    "not_header": "<article><p><b>Contact us about forward-looking statements</b></p><p>b</p></article>",
    "layout": "<table><tr><td><article><p>a</p><table><tr><td>in</td></tr></table></article></td></tr></table>",
    "second_div": f'<div class="post-content"><p>{SHORT}</p></div><div class="Post x-content"><p>{LONG}</p></div>',
    "rank": f'<div class="news-content"><p>{LONG}</p></div><div class="story-content"><p>{LONG}</p></div>',
    "largest": f"<aside><section><p>{LONG}{LONG}</p></section></aside><div><p>{SHORT}</p></div>",
    "cells": "<article><table><tr><th>A</th><td>1</td><td> </td></tr></table><table><tr><td></td></tr></table></article>",
    "meta": '<a rel="nofollow author">Al</a><span class="x Byline"> <b>Bo</b> C</span><meta name="keywords" content="a, b,,c">'
            '<meta property="article:section" content="S">',
    "byline": '<span class="x Byline"> <b>Bo</b> C</span><span class="author">D</span>',
    "no_value": '<meta name="author"><a rel="author">Al</a><meta name="keywords">',
    "prune": "<body><div><p>x</p></div><article><div><p>keep</p></div><div>go</div><h3> </h3></article><nav><i>n</i></nav><form>f</form></body>",
    "no_label": "<body><div>go?</div></body>",
    "empty": "",
}


@pytest.fixture(scope="module")
def golden(spark, pages_of):
    names = list(PAGES)
    pages = pages_of(*PAGES.values())
    nodes = write_stage(flatten_dom(pages), "golden")
    as_of = F.lit(datetime.datetime(2026, 6, 15))
    parts = articles.article_parts(nodes, as_of)
    record = articles.article_records(pages, nodes, parts, as_of=as_of)
    found = articles.labels(parts)
    out = {names[r.page_id]: r.asDict() for r in record.collect()}
    for r in out.values():
        r["content"], r["roles"] = [], []
    texts = nodes.select("page_id", "pos", "text")
    for r in found.join(texts, ["page_id", "pos"]).orderBy("pos").collect():
        out[names[r.page_id]]["roles"].append(r.label_type)
        if r.label_type == "content":
            out[names[r.page_id]]["content"].append(r.text)
    checks = {names[r.page_id]: r.labels_kept for r in articles.check_prune(nodes, found).collect()}
    for name, r in out.items():
        r["kept"] = checks.get(name)
    return out


def test_titles(golden):
    want = {"longest": "a longer one", "too_long": None, "limit": "x" * 199, "tie": "aaaa", "ld_list": "page", "ld_bad": "page",
            "ld_tail": "page", "ld_tail2": "page", "ld_tail3": "page", "ld_twice": "last", "ld_null": None, "ld_number": "7",
            "ld_second": "page", "h1_outside": "out"}
    assert {k: golden[k]["title"] for k in want} == want


def test_dates(golden):
    day = lambda d: f"{d} 00:00:00"
    want = {"meta_second": day("2020-05-06"), "ld_date": "2020-05-06 10:00:00", "ld_bad_date": day("2019-01-01"), "ld_number_date": day("2019-01-01"),
            "published": day("2024-01-05"), "class_tie": day("2021-01-02"), "same_pattern": day("2021-01-02"), "future": None,
            "nonsense": None, "in_script": None, "split_word": day("2018-01-01"), "longest": None}
    assert {k: golden[k]["published_text"] for k in want} == want
    assert golden["ld_date"]["published_ts"] == datetime.datetime(2020, 5, 6, 10)


def test_content(golden):
    want = {"body": ["P", "H", "L", "M"], "cut": ["a"], "cut_plain": ["About Acme, Inc.", "b"], "cut_bold": [], "cut_style": [],
            "cut_class": [], "not_header": ["b"], "layout": [], "second_div": [LONG], "rank": [LONG], "largest": [SHORT], "no_label": []}
    assert {k: golden[k]["content"] for k in want} == want
    assert [k for k, r in golden.items() if r["ref_would_fail"]] == ["cut_class", "cut_class_off"]


def test_tables(golden):
    assert golden["cells"]["roles"] == ["table", "table_header", "table_cell"]
    assert (golden["cut"]["n_tables"], golden["layout"]["n_tables"], golden["cells"]["n_tables"]) == (0, 1, 1)


def test_metadata(golden):
    get = lambda k: (golden[k]["author"], golden[k]["keywords"], golden[k]["category"])
    assert get("meta") == ("Al", ["a", "b", "", "c"], "S")
    assert get("byline") == ("BoC", None, None)
    assert get("no_value") == (None, [""], None)


def test_pruning(golden):
    assert golden["prune"]["clean_html"] == ("<body><article><div><p>keep</p></div></article><nav><i>n</i></nav><form>f</form></body>")
    assert golden["no_label"]["clean_html"] == PAGES["no_label"]
    assert all(r["kept"] in (True, None) for r in golden.values())


def test_marked_html(spark, pages_of):
    nodes = write_stage(flatten_dom(pages_of('<body><article><p title=\'a"b\'>x<i>y</i></p><div>no</div></article></body>')), "marked")
    html = articles.clean_html(nodes, articles.labels(articles.article_parts(nodes)), mark=True).first().clean_html
    assert html == ('<body data-node="0"><article data-node="1"><p title=\'a"b\' data-node="2"><span data-seq="1" data-node="3" data-label="content">x</span>'
                    '<i data-node="4"><span data-seq="2" data-node="5" data-label="content">y</span></i></p></article></body>')


def test_lost_labels_are_named(spark, pages_of):
    from pressframe.operators import prune
    nodes = flatten_dom(pages_of("<body><p>x</p><p>y</p></body>"))
    found = nodes.where("kind = 'T'").select("page_id", "pos", F.lit("content").alias("label_type"))
    before = write_stage(prune.label_nodes(nodes, found), "labelled")
    assert prune.lost_labels(before, prune.prune(before)).count() == 0
    gap = prune.lost_labels(before, before.where("text = 'x' or kind = 'E'"))
    assert [tuple(r) for r in gap.collect()] == [(0, 5, "content", "lost")]
    assert [r.labels_kept for r in prune.verify_prune(before, before.where("coalesce(text, '') <> 'y'")).collect()] == [False]


def listing(links, extra=""):
    items = "".join(f'<li{s}><a href="{h}">{t}</a></li>' for h, t, s in links)
    return f'<nav><a href="/about">About</a></nav><ul>{items}</ul><footer><a href="/privacy">P</a></footer>{extra}'


def plain(n, base="/news/acme-wins-", style=""):
    return [(f"{base}{i}", f"Item {i}", style) for i in range(n)]


def test_listing_pages(spark, pages_of):
    doubled = plain(6) + plain(6)
    two = listing(plain(6)) + "<ol><li>" + "</li><li>".join(f'<a href="/x/acme-wins-{i}">i</a>' for i in range(6)) + "</li></ol>"
    twin = listing(plain(6)) + "<ol><li>" + "</li><li>".join(f'<a href="/news/acme-wins-{i}">i</a>' for i in range(6)) + "</li></ol>"
    hidden = listing(plain(2) + plain(4, "/n/acme-opens-", ' style="display: none"'))
    few, odd = listing(plain(4)), listing([(f"?id={i}", "x", "") for i in range(6)])
    got = discovery.discover_groups(pages_of(listing(doubled), two, twin, hidden, few, odd, "<p>none</p>"))
    from pressframe.operators.links import hidden_share, is_client_side
    found = {r.page_id: r for r in got.select("*", hidden_share().alias("share"), is_client_side().alias("client")).collect()}
    assert sorted(found) == [0, 2, 3]
    assert found[0].urls == [f"/news/acme-wins-{i}" for i in range(6)] and found[0].ancestry == "[document] > ul > li"
    assert found[2].twin_group and found[2].ancestry == "[document] > ul > li"
    assert found[3].client and round(found[3].share, 2) == 0.67 and not found[0].client


def test_results_do_not_depend_on_layout(spark, pages_of):
    pages = pages_of(*[listing(plain(5 + i)) for i in range(8)])
    one = sorted(map(tuple, discovery.discover_links(pages.coalesce(1)).collect()))
    many = sorted(map(tuple, discovery.discover_links(pages.orderBy(F.rand(1)).repartition(7)).collect()))
    alone = sorted(tuple(r) for i in range(8) for r in discovery.discover_links(pages.where(f"page_id = {i}")).collect())
    assert one == many == alone and len(one) == sum(5 + i for i in range(8))


def options(*texts):
    return "<select>" + "".join(f"<option>{t}</option>" for t in texts) + "</select>"


def test_year_selectors(spark, pages_of):
    nodes = flatten_dom(pages_of(
        options("English", "French") + options("All Years", "2024", "2023", "2022", "2021"),
        options(*[str(2020 + i) for i in range(7)], "a", "b", "c"), options("2024"), options(" 2024 ", "2023")))
    opts = navigation.year_options(nodes)
    found = {r.page_id: (r.has_all, r.options) for r in navigation.year_selectors(opts).collect()}
    assert found == {0: (True, ["All Years", "2024", "2023", "2022", "2021"]), 3: (False, ["2024", "2023"])}
    plan = navigation.nav_plan(pages_of("", "", "", ""), navigation.year_selectors(opts),
                               spark.createDataFrame([], "page_id long, links array<struct<pos:int,href:string,hidden:boolean>>"))
    assert {r.page_id: (r.mode, r.years) for r in plan.collect()} == {
        0: ("all", None), 1: ("plain", None), 2: ("plain", None), 3: ("years", ["2024", "2023"])}


def test_paging_controls(spark, pages_of):
    nodes = flatten_dom(pages_of("<span>Load More</span><button class=more>x</button>", "<button class=more>x</button>",
                                 '<li class="pager-next page"><a href="?page=2">n</a></li>',
                                 '<ul><li><b class="x"><span class="arrow-right"></span></b></li><li><a href="/p?page=3" rel=next>n</a></li></ul>'))
    more = {r.page_id: (r.rule, r.pos) for r in navigation.load_more_controls(nodes).collect()}
    assert more == {0: (7, 1), 1: (11, 1)}
    follow = {r.page_id: (r.rule, r.href) for r in navigation.next_controls(nodes).collect()}
    assert follow == {2: (1, "?page=2"), 3: (8, "/p?page=3")}


def test_nested_tables_keep_their_own_cells(spark, pages_of):
    html = ("<table><tr><td>a<table><tr><td>in</td></tr></table>b</td><th>c</th></tr><tr><td>d<td>e</table>")
    got = content.table_cells(flatten_dom(pages_of(html))).orderBy("table_pos", "row_no", "col_no").collect()
    assert [(r.row_no, r.col_no, r.is_header, r.text) for r in got] == [
        (1, 1, False, "ab"), (1, 2, True, "c"), (2, 1, False, "d"), (2, 2, False, "e"), (1, 1, False, "in")]
