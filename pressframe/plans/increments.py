"""Seeds to article records, increment by increment.

Each increment is a set of newly landed pages.  What is known from before are two tables of committed runs: the
frontier (every article link once, with the run that found it first) and the records (every article once).  An increment
reads both, adds one run to each, and so goes on where the last one stopped; one that failed is repeated under its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressframe.plans import articles, discovery
from pressframe.sources.dom import flatten_dom
from pressframe.sources.pages import seed_pages, write_stage
from pressframe.sources.runs import is_committed, read_runs, write_run

FRONTIER = "url string, site_id long"
RECORDS = "page_id long, url string"


def _earlier(spark: SparkSession, path: str, run: str, schema: str) -> DataFrame:
    """Committed runs but the one that is being written."""
    return read_runs(spark, path, schema).where(F.col("run") != run)


def unknown(found: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``found(url, ...)`` whose URL is not in ``known(url)``.

    An increment is small beside what is known.  So the known side is only looked through for the increment's URLs, which
    Spark sends to where it lies while they are few, and not sorted anew; what it has is taken off the increment.
    """
    there = known.select("url").join(found.select("url").distinct(), "url", "left_semi").distinct()
    return found.join(there, "url", "left_anti")


def extend_frontier(state: str, run: str, links: DataFrame) -> DataFrame:
    """Add the article links ``(url, site_id)`` that no earlier run has found, each once; returns the run's rows."""
    spark, path = links.sparkSession, f"{state}/frontier"
    new = links.where("url is not null").groupBy("url").agg(F.min("site_id").alias("site_id"))
    write_run(unknown(new, _earlier(spark, path, run, FRONTIER)), path, run)
    return read_runs(spark, path).where(F.col("run") == run)


def add_records(state: str, run: str, pages: DataFrame, as_of: Column | None = None, html: bool = True) -> DataFrame:
    """Records of the landed pages that are in the frontier and have none yet; of pages with one URL the smallest ``page_id``."""
    spark, path = pages.sparkSession, f"{state}/records"
    wanted = read_runs(spark, f"{state}/frontier", FRONTIER).select("url")
    first = pages.groupBy("url").agg(F.min("page_id").alias("page_id"))
    todo = unknown(first, _earlier(spark, path, run, RECORDS)).join(wanted, "url", "left_semi")
    # An outer look at short rows first, so only the pages that are read at all move with their HTML.
    articles_now = write_stage(pages.join(todo.select("page_id", "url"), ["page_id", "url"], "left_semi"), "increment")
    record = articles.article_records(articles_now, write_stage(flatten_dom(articles_now), "articles"), html=html, as_of=as_of)
    write_run(record, path, run)
    return read_runs(spark, path).where(F.col("run") == run)


def run_increment(state: str, run: str, seeds: DataFrame, pages: DataFrame, as_of: Column | None = None, html: bool = True) -> DataFrame:
    """One increment of ``pages(page_id, url, html)``: listing pages of ``seeds(site_id, base_url)`` extend the frontier, article pages of
    all that is in it become records.  Returns the run's records.  An increment committed in both tables is not done again.
    """
    spark = pages.sparkSession
    if not all(is_committed(spark, f"{state}/{table}", run) for table in ("frontier", "records")):
        listings = seed_pages(seeds, pages.select("page_id", "url", "html")).where("page_id is not null")
        found = discovery.discover_links(listings.select("page_id", F.col("base_url").alias("url"), "html"))
        links = found.join(listings.select("page_id", "site_id").distinct(), "page_id").select("url", "site_id")
        extend_frontier(state, run, links)
        add_records(state, run, pages, as_of, html)
    return read_runs(spark, f"{state}/records").where(F.col("run") == run)


def open_links(spark: SparkSession, state: str) -> DataFrame:
    """``url, site_id, run`` of links in the frontier without a record: what is to be fetched next."""
    return unknown(read_runs(spark, f"{state}/frontier", FRONTIER), read_runs(spark, f"{state}/records", RECORDS))
