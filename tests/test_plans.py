"""The shape of the physical plans: what is shuffled, what is scanned, what is never done."""

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from pressframe.operators import content, head
from pressframe.plans import articles, discovery
from pressframe.sources.dom import flatten_dom
from pressframe.sources.pages import write_stage

SF = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_discovery_has_one_exchange_after_reading(spark, pages_of):
    text = plan(discovery.discover_groups(pages_of("<a href=/x>x</a>")))
    above = text[:text.index("MapInArrow")]
    assert re.findall(r"Exchange hashpartitioning\(([^,]*), ", above) == re.findall(r"Exchange hashpartitioning\((page_id#\d+L), ", above)
    assert above.count("Exchange") == 1


def test_content_has_one_exchange_and_ships_no_text(spark, pages_of):
    rows = content.content_rows(flatten_dom(pages_of("<p>x</p>")))
    text = plan(rows)
    assert text.count("Exchange") == 1
    leaf = rows._jdf.queryExecution().sparkPlan()
    while "Window" in leaf.nodeName() or leaf.nodeName() in ("Project", "Filter"):
        last, leaf = leaf, leaf.children().head()
        if leaf.nodeName() in ("Project", "Filter") and "Window" in last.nodeName():
            shipped = leaf.output().mkString(",")
    assert "basic#" in shipped and not re.search(r"\b(text|owner|attrs)#", shipped)


def test_head_facts_aggregate_before_the_exchange(spark, pages_of):
    text = plan(head.head_facts(flatten_dom(pages_of("<p>x</p>"))))
    assert text.count("Exchange") == 1 and "partial_min" in text[text.index("Exchange"):]


def test_pruning_and_rendering_share_one_exchange_per_side(spark, pages_of, no_broadcast):
    nodes = write_stage(flatten_dom(pages_of("<body><p>x</p></body>")), "plan")
    found = nodes.where("kind = 'T'").select("page_id", "pos", F.lit("content").alias("label_type"))
    assert plan(articles.clean_html(nodes, found)).count("Exchange") == 2


def test_tag_filters_reach_the_stored_table(spark, pages_of):
    nodes = write_stage(flatten_dom(pages_of("<h1>x</h1>")), "pushed")
    text = plan(nodes.where("tag = 'h1'").select("page_id", "pos"))
    assert "EqualTo(tag,h1)" in text and "ReadSchema: struct<page_id:bigint,pos:int,tag:string>" in text


@pytest.mark.parametrize("name", ["news_link_discovery", "article_date", "clean_html", "next_controls", "crawl_links", "fetch_frontier"])
def test_no_nested_loops(spark, name, no_broadcast):
    text = plan(QUERIES[name](spark, SF))
    assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["head_date", "head_date_forms", "article_date"])
def test_dates_are_read_without_python(spark, name):
    assert "EvalPython" not in plan(QUERIES[name](spark, SF))
