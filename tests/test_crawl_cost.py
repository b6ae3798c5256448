"""What following a large crawl must not do again for every link, row or page."""

import gc

from pyspark.sql import functions as F

from pressframe.functions import urls
from pressframe.functions.text import WS
from pressframe.operators import links, navigation
from pressframe.plans import discovery
from pressframe.sources import dom
from pressframe.sources.dom import flatten_dom

LISTING = "<ul>" + "".join(f'<li class="item"><a href="/2023/p0/a-wins-{j}">D</a></li>' for j in range(5)) + "</ul>"
PAGER = '<ul><li class="page next"><a href="?page=2">n</a></li></ul>'


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_questions_about_controls_do_not_read_plain_links(spark, pages_of):
    pages = pages_of(LISTING, LISTING + "<button>Load More</button>", LISTING + PAGER, '<p class="more">x</p>', None)
    nodes = discovery.listing_nodes(pages)
    found = {(r.page_id, r.asked): r["count"] for r in nodes.groupBy("page_id", "asked").count().collect()}
    assert found == {(0, dom.LINK): 5, (1, dom.LINK): 5, (1, dom.CONTROL): 2, (2, dom.PAGER): 5 + 5 + 2, (3, dom.CONTROL): 1, (4, None): 1}
    folders = {file.split("/")[-2] for file in nodes.inputFiles()}
    assert folders == {"asked=0", "asked=1", "asked=2", "asked=__HIVE_DEFAULT_PARTITION__"}
    for ask, kept in ((navigation.load_more_controls, f"asked in ({dom.CONTROL}, {dom.PAGER})"), (navigation.next_controls, f"asked = {dom.PAGER}")):
        some = nodes.where(kept)
        assert "PartitionFilters: [" in plan(some) and "PartitionFilters: []" not in plan(some)
        assert len(ask(some).collect()) > 0 and sorted(map(repr, ask(some).collect())) == sorted(map(repr, ask(nodes).collect()))


def test_words_of_a_link_are_found_once(spark, pages_of):
    text = plan(links.link_groups(links.anchors(flatten_dom(pages_of(LISTING)))))
    assert "exists(" in text and "exists(array_remove(" not in text and "exists(split(" not in text


def test_elements_of_a_list_share_their_path():
    nodes = dom._PageReader().read(LISTING)
    paths = [dom._paths(n) for n in nodes if n.tag == "a"]
    assert len(paths) == 5 and all(p is paths[0] for p in paths)
    assert paths[0] == ("[document] > ul > li", "[document] > ul > li.item")


def test_reading_leaves_the_search_for_cycles_as_it_was(spark, pages_of):
    def thresholds(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [gc.get_threshold()[0]] * batch.num_rows})

    before = pages_of(LISTING).coalesce(1).mapInArrow(thresholds, "n long").collect()
    assert flatten_dom(pages_of(LISTING)).count() > 5
    assert pages_of(LISTING).coalesce(1).mapInArrow(thresholds, "n long").collect() == before


def test_short_ways_agree_with_the_patterns(spark):
    odd = ["Press - room", "a  b", "a--b", "a -b", "a b", "", None, " a", "a ", "a\tb", "a　b", "about us", "é b", "-", "Ab C"]
    frame = spark.createDataFrame(list(enumerate(odd)), "i int, x string").orderBy("i")
    x = F.col("x")
    assert frame.select(urls.text_words(x)).collect() == frame.select(F.split(F.regexp_replace(F.lower(x), f"[{WS}-]+", "-"), "-", -1)).collect()
    hrefs = ["/a/b.html", "b.html", "/b.html?x=/y", "a/b", "/", "", None, "a", "https://h.com/a.b/c/", "https://h.com", "//b.pdf/", "/a/b.c.d#/e.f"]
    frame = spark.createDataFrame(list(enumerate(hrefs)), "i int, x string").orderBy("i")
    assert [r[0] for r in frame.select(urls.slug(x)).collect()] == ["a", None, "", "b", "", "", None, "a", "c", "", "", "a"]


def test_a_year_need_not_be_a_number(spark):
    frame = spark.createDataFrame([("2023",), (" 2022 ",), ("Older",), ("2023a",), ("",), (None,)], "year string")
    found = [tuple(r[0]) for r in frame.select(discovery.year_order()).collect()]
    assert found == [(0, -2023, "2023"), (0, -2022, " 2022 "), (1, 0, "Older"), (1, 0, "2023a"), (1, 0, ""), (2, 0, "")]


def test_keys_of_pages_tell_odd_crawls_apart(spark):
    """Nulls, empty texts and digits that could belong to the part before or after; the same page landed twice is one."""
    rows = [(site, "https://c.example.com/news/", page, year, LISTING) for site, page, year in (
        ("1", 1, "2023"), ("11", 1, "2023"), ("1", 11, "2023"), ("1", 1, None), ("1", 1, ""), (None, 1, "2023"), ("1", None, "2023"), ("-", 1, "1:2"), ("-1", 1, ":2"), ("1", 1, "2023"))]
    crawl = spark.createDataFrame(rows, "site_id string, base_url string, page_no int, year string, html string")
    found = discovery.discover_crawl(crawl).groupBy("site_id", "page_no", "year").count().collect()
    assert len(found) == 9 and {r["count"] for r in found} == {5}
