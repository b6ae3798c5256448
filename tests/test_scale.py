"""What must not grow with the tables: what the driver holds, and what of a page leaves its reading."""

import pytest

from pyspark.sql import functions as F

from checks.queries import QUERIES
from pressframe.functions import boilerplate as bp, dates
from pressframe.functions.text import any_of
from pressframe.operators import content
from pressframe.plans import articles, discovery
from pressframe.sources.dom import flatten_dom
from pressframe.sources.pages import write_stage

SF = "/root/testdata/sf0.001"
LISTING = "<ul>" + "".join(f'<li><a href="/2023/p0/a-wins-{j}">D</a></li>' for j in range(5)) + "</ul>"


@pytest.mark.parametrize("name", ["date_candidates", "prune_losses", "table_grid"])
def test_nothing_is_sent_to_all_tasks_by_the_size_of_a_file(spark, name):
    assert "Broadcast" not in QUERIES[name](spark, SF)._jdf.queryExecution().sparkPlan().toString()


def test_a_listing_without_a_pager_gives_links_only(spark, pages_of):
    assert discovery.listing_nodes(pages_of(LISTING)).count() == 5
    with_pager = LISTING + '<ul><li class="page next"><a href="?page=2">n</a></li></ul><button>Load More</button>'
    assert discovery.listing_nodes(pages_of(with_pager)).count() == 5 + 5 + 2 + 2


def test_a_crawl_goes_by_short_keys_and_reads_repeats_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(discovery, "flatten_dom", lambda pages, **how: seen.append(pages) or flatten_dom(pages, **how))
    rows = [(1, "https://c.example.com/news/", 0, "2023", LISTING)] * 2
    crawl = spark.createDataFrame(rows, "site_id long, base_url string, page_no int, year string, html string")
    assert discovery.discover_crawl(crawl, dedup=True).count() == 5
    assert seen[0].count() == 1 and seen[0].schema["page_id"].dataType.simpleString() == "binary"


def test_tasks_go_up_with_the_rows_of_a_stage_table(spark):
    """One task writes the table; those that read it take a bounded number of rows each."""
    table = write_stage(spark.range(0, 1_200_000, 1, 1).selectExpr("id div 50 as page_id", "1 as pos"), "rows")
    rows = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(rows) == 1_200_000 and max(rows) <= 400_000


def test_pages_are_put_together_in_their_order(spark, pages_of):
    """No table of all pages of a task is built and sorted afterwards."""
    nodes = write_stage(flatten_dom(pages_of("<body><p>x</p></body>")), "order")
    found = nodes.where("kind = 'T'").select("page_id", "pos", F.lit("content").alias("label_type"))
    plan = articles.clean_html(nodes, found)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "ObjectHashAggregate" not in plan


def test_each_line_is_judged_once(spark, pages_of):
    plan = content.content_rows(flatten_dom(pages_of("<p>x</p>")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("(?iu)(?:copyright)") == 1


def test_odd_letters_in_boilerplate(spark):
    lines = ["ſhare thıs", "SHARE THİS", "K terms of uſe", "harbor", "lookıng", "ABOUT", "sharé this", "follow", None]
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, x string").orderBy("i")
    want = frame.select(any_of(F.col("x"), bp.BASIC), F.lower("x").rlike(f"(?iu){bp.HEADER_WORDS}")).collect()
    assert frame.select(bp.is_basic(F.col("x")), bp.may_be_header(F.col("x"))).collect() == want
    assert [r[0] for r in want] == [True, True, True, False, False, False, False, False, None]


def test_parts_of_a_date_are_looked_for_once():
    days = dates.text_dates(F.col("x"), F.current_timestamp())
    assert sum(str(day).count("regexp_extract") for day in days) == 9
