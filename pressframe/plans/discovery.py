"""Listing pages to article links (first stage)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressframe.operators import links
from pressframe.operators.navigation import crawl_cut, load_more_controls, next_controls
from pressframe.sources.dom import CONTROL, PAGER, flatten_dom, link_rows, listing_rows
from pressframe.sources.pages import write_stage
from pressframe.sources.runs import write_run


def page_links(pages: DataFrame) -> DataFrame:
    """Anchors of all pages; the reading stage builds rows for links and hiding elements only."""
    return links.anchors(flatten_dom(pages, keep=link_rows))


def listing_nodes(pages: DataFrame) -> DataFrame:
    """One walk over listing pages for all that is asked of them, written once: links, hiding elements, controls and options.

    ``discover_groups``, ``load_more_controls``, ``next_controls`` and ``year_options`` branch over it.  Rows lie in files of their own by what
    they are kept for (see ``listing_rows``), as only the first of these needs them all.
    """
    return write_stage(flatten_dom(pages, keep_of_page=listing_rows, mark=True), "listings", apart="asked")


def discover_groups(pages: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """The news list of each page, or no row; from ``nodes`` where the pages have been read already."""
    return links.news_groups(links.link_groups(page_links(pages) if nodes is None else links.anchors(nodes)))


def discover_links(pages: DataFrame, base_url: str = "url", mode: str = "prefix") -> DataFrame:
    """``(page_id, url_no, href, url)`` for every page with a news list."""
    base = pages.select("page_id", F.col(base_url).alias("base_url"))
    return links.news_links(discover_groups(pages), base, mode)


def year_order() -> Column:
    """Numbered years newest first, then other names in order, then pages without a year."""
    # A text without a digit is no number; a cast would find that out by an exception.
    number = F.when(F.col("year").cast("string").rlike("[0-9]"), F.expr("try_cast(year as int)"))
    return F.struct(F.when(number.isNotNull(), 0).when(F.col("year").isNotNull(), 1).otherwise(2).alias("kind"),
                    F.coalesce(-number, F.lit(0)).alias("place"), F.coalesce("year", F.lit("")).alias("name"))


def followed(lists: DataFrame) -> DataFrame:
    """Pages a browser would have reached: those before a hole in ``page_no`` and up to the first without control.

    ``lists(site_id, year_no, page_no, has_control, ...)``; a year of a site is one short list of pages.
    """
    pages = lists.groupBy("site_id", "year_no", "page_no").agg(F.max("has_control").alias("has_control"))
    before = Window.partitionBy("site_id", "year_no").orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
    open_so_far = F.coalesce(F.min(F.col("has_control").cast("int")).over(before), F.lit(1)) == 1
    reached = pages.where("page_no >= 0").withColumn("reached", open_so_far & (F.count("*").over(before) == F.col("page_no")))
    return lists.join(reached.where("reached").select("site_id", "year_no", "page_no"), ["site_id", "year_no", "page_no"], "left_semi")


def discover_crawl(crawl: DataFrame, max_pages: int | None = None, dedup: bool = False, follow: bool = False,
                   options: DataFrame | None = None) -> DataFrame:
    """Links of a whole crawl ``(site_id, base_url, page_no, year, html)``, all pages united.

    All landed pages count unless ``max_pages`` is given (then those with ``page_no`` up to it) or ``follow``
    is set (then those a browser would have reached, see :func:`followed`).  Years run in the order of
    ``options(site_id, option_text, pos)``, the options of the site's selector, else by a ``year_no`` column, else
    newest first.  A page is known by site, year, number and its content, so nothing merges by accident; the
    same page landed twice counts once, another version of it counts too.
    """
    rows = crawl if max_pages is None else crawl.where(F.col("page_no") <= max_pages)
    if "year_no" in rows.columns:
        rows = rows.withColumn("year_no", F.struct(F.lit(0).alias("kind"), F.col("year_no").cast("int").alias("place"), F.coalesce("year", F.lit("")).alias("name")))
    else:
        rows = rows.withColumn("year_no", year_order())
    # Each part comes with its length, so different parts give different keys; nulls have none.
    parts = [F.col(c).cast("string") for c in ("site_id", "year_no.kind", "year_no.place", "year_no.name", "year", "page_no")]
    key = F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in [*parts, F.xxhash64("html").cast("string")]])
    # All windows sort by the page, so it goes by a digest of 16 bytes instead of a long text that starts like any other.
    pages = rows.withColumn("page_id", F.unhex(F.md5(key.cast("binary"))))
    # Where repeats are looked for, a page that landed twice is read once.
    once = pages
    if dedup:
        same = Window.partitionBy("page_id").orderBy("page_id")
        once = pages.select("page_id", "html", *[c for c in pages.columns if c == "charset"]).withColumn("nth", F.row_number().over(same)).where("nth = 1").drop("nth")
    nodes = listing_nodes(once) if follow else None
    found = discover_groups(once, nodes).select("page_id", "urls", links.is_client_side().alias("client_side"))
    # Pages rarely land twice, so nothing is won by looking for repeats on both sides of the exchange.
    short = pages.select("page_id", "site_id", "base_url", "year", "year_no", "page_no").repartition("page_id").dropDuplicates(["page_id"])
    lists = short.join(found, "page_id", "left")
    if follow:
        # Rows of pages that could not be read are marked by nothing, and hold no control.
        seen = (load_more_controls(nodes.where(F.col("asked").isin(CONTROL, PAGER))).select("page_id")
                .union(next_controls(nodes.where(F.col("asked") == PAGER)).select("page_id")).distinct())
        lists = lists.join(seen.withColumn("has_control", F.lit(True)), "page_id", "left").withColumn("has_control", F.coalesce("has_control", F.lit(False)))
    if options is not None:
        place = options.groupBy("site_id", F.col("option_text").alias("year")).agg(F.min("pos").alias("pos"))
        listed = F.struct(F.lit(-1).alias("kind"), F.col("pos").cast("int").alias("place"), F.coalesce("year", F.lit("")).alias("name"))
        lists = lists.join(place, ["site_id", "year"], "left").withColumn("year_no", F.when(F.col("pos").isNotNull(), listed).otherwise(F.col("year_no"))).drop("pos")
    # Read twice below (cut and rows), so the lists are written once instead of found twice.
    lists = write_stage(lists.withColumn("client_side", F.coalesce("client_side", F.lit(False))), "lists")
    kept = crawl_cut(followed(lists) if follow else lists, max_pages)
    out = (kept.where("urls is not null")
           .select("site_id", "year", "year_no", "page_no", "base_url", F.posexplode("urls").alias("url_no", "href"))
           .withColumn("url", links.urls.absolute_url(F.col("href"), F.col("base_url"))))
    if dedup:
        out = (out.groupBy("site_id", "url").agg(F.min(F.struct("year_no", "page_no", "url_no", "year", "href")).alias("f"))
               .select("site_id", "f.year", "f.page_no", "f.url_no", "f.href", "url"))
    return out.select("site_id", "year", "page_no", "url_no", "href", "url")


def link_errors(pages: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pages without any usable link, as data."""
    # Distinct pages first: one short row per page reaches the join.
    usable = links.valid_links(nodes.where("kind = 'E' and tag = 'a'")
                               .select("page_id", F.try_element_at("attrs", F.lit("href")).alias("href")))
    return (pages.select("page_id", "url").join(usable.select("page_id").distinct(), "page_id", "left_anti")
            .select("page_id", "url", F.lit("links").alias("stage"), F.lit("no usable link").alias("error")))


def write_links(found: DataFrame, path: str, buckets: int = 64, slices: int = 16, run: str | None = None) -> None:
    """Keep article links for the second stage, in folders by a hash of the page.

    Each folder is written by up to ``slices`` tasks, so its size does not rest on one of them; both
    numbers follow the size of the crawl.  With ``run`` the links become a committed run of the table (see ``read_runs``), which
    can be repeated and leaves other runs alone; without, they replace what ``path`` held before.
    """
    slice_no = F.pmod(F.xxhash64("page_id", "url_no"), F.lit(slices))
    placed = (found.withColumn("bucket", F.pmod(F.xxhash64("page_id"), F.lit(buckets)))
              .repartition(F.col("bucket"), slice_no).sortWithinPartitions("page_id", "url_no"))
    if run is None:
        placed.write.mode("overwrite").partitionBy("bucket").parquet(path)
    else:
        write_run(placed, path, run, partition_by=("bucket",))


def fetched(found: DataFrame, pages: DataFrame) -> DataFrame:
    """Article links with their landed page, where there is one."""
    target = pages.select(F.col("url").alias("page_url"), F.col("page_id").alias("article_id"))
    # The inner join can split a URL landed very often on either side; links without a page are added after.
    matched = found.join(target, found.url == target.page_url).drop("page_url")
    landed = target.select(F.col("page_url").alias("url")).distinct()
    return matched.unionByName(found.join(landed, "url", "left_anti"), allowMissingColumns=True)


def fetch_frontier(found: DataFrame, pages: DataFrame) -> DataFrame:
    """Distinct article links that have not been fetched yet."""
    return found.select("url").distinct().join(pages.select("url").distinct(), "url", "left_anti")
