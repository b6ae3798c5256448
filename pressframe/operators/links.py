"""Link discovery: from anchors to the one group of links that is the news list of a page.

After one exchange by ``page_id`` everything here runs in place: dedup, group statistics and
the ranking windows all ask for a clustering that ``page_id`` satisfies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from pressframe.functions import urls
from pressframe.functions.text import attr
from pressframe.operators.tree import hides_itself, with_hidden

URL_FLAGS = ["has_protocol", "has_subdomain", "has_port", "has_query", "has_fragment",
             "has_file_extension", "is_relative_url", "multi_level_path"]
CLIENT_SIDE_SHARE = 0.6


def _page() -> WindowSpec:
    return Window.partitionBy("page_id")


def anchors(nodes: DataFrame) -> DataFrame:
    """All links of a page with both ancestor paths, text and hidden flag."""
    hides, href = hides_itself(), F.when(F.col("tag") == "a", attr("href"))
    narrow = (nodes.where((F.col("kind") == "E") & (hides | href.isNotNull()))
              .select("page_id", "pos", "end_pos", "depth", "kind", "text", "anc_flex", "anc_strict", href.alias("href"), hides.alias("hides")))
    return with_hidden(narrow.repartition("page_id"), F.col("href").isNotNull(), hides=F.col("hides")).select(
        "page_id", "pos", "anc_flex", "anc_strict", "href", "text", "hidden")


def valid_links(links: DataFrame) -> DataFrame:
    return links.where(urls.is_news_link(F.col("href")))


def distinct_links(links: DataFrame) -> DataFrame:
    """First link per distinct href within a tag path."""
    same = Window.partitionBy("page_id", "anc_flex", "href").orderBy("pos")
    return links.withColumn("nth", F.row_number().over(same)).where("nth = 1").drop("nth")


def link_groups(links: DataFrame) -> DataFrame:
    """One row per (page, tag path) with the statistics of its distinct valid links.

    ``links`` keeps the group's members as one array: a part of one page, so never larger than
    the HTML cell it came from.
    """
    href, lengths = F.col("href"), F.col("slug_lengths")
    unique = distinct_links(valid_links(links))
    shared = F.count("*").over(Window.partitionBy("page_id", "href")) > 1
    hidden = F.col("hidden") if "hidden" in links.columns else F.lit(None).cast("boolean")
    flags = urls.url_flags(href)
    # Words are found before they are looked up: a look-up of each word in the expression that finds them would find them anew.
    facts = unique.select(
        "page_id", "pos", "anc_flex", "anc_strict", "href", "text", hidden.alias("hidden"), shared.alias("shared"),
        urls.slug_length(href).alias("slug_len"), urls.slug_words(href).alias("slug_words"),
        urls.is_section(urls.url_path(href)).alias("section"), urls.text_words(F.col("text")).alias("text_words"),
        *[flags[name].alias(name) for name in URL_FLAGS])
    facts = facts.select(
        "page_id", "pos", "anc_flex", "anc_strict", "href", "hidden", "shared", "slug_len", *URL_FLAGS,
        urls.words_have_verb(F.col("slug_words")).alias("verb"),
        (F.col("section") | urls.is_section_text(F.col("text"), F.col("text_words"))).alias("typical"))
    counts = [F.count_if(F.col(name)).alias(f"{name}_count") for name in URL_FLAGS]
    groups = facts.groupBy("page_id", F.col("anc_flex").alias("ancestry")).agg(
        F.min("pos").alias("first_pos"),
        F.size(F.collect_set("anc_strict")).cast("long").alias("num_unique_strict_ancestry"),
        F.sort_array(F.collect_list(F.struct("pos", "href", "hidden"))).alias("links"),
        F.count("*").alias("url_count"),
        F.bool_or("shared").alias("non_excl_url"),
        F.count_if(F.col("typical")).alias("num_typical_url"),
        F.avg("slug_len").alias("last_path_mean_length"),
        F.sort_array(F.collect_list("slug_len")).alias("slug_lengths"),
        F.count_if(F.col("verb")).alias("urls_with_verbs"),
        *counts)
    n = F.col("url_count")
    same_set = Window.partitionBy("page_id", "url_set")
    return (groups
            .withColumn("group_id", F.row_number().over(_page().orderBy("first_pos")) - 1)
            .withColumn("urls", F.col("links.href"))
            .withColumn("url_set", F.sort_array("urls"))
            .withColumn("twin_group", F.count("*").over(same_set) > 1)
            # The link filter lets no social link through, so these two need no second test.
            .withColumn("is_social_media_num", F.lit(0).cast("long"))
            .withColumn("is_social_media_pct", F.lit(0.0))
            .withColumn("last_path_median_length", F.element_at(lengths, (n / 2).cast("int") + 1))
            .withColumn("verb_percentage", F.col("urls_with_verbs") / n * 100)
            .withColumns({f"{name}_pct": F.col(f"{name}_count") / n for name in URL_FLAGS})
            .drop("slug_lengths", "first_pos"))


def drop_equal_groups(groups: DataFrame) -> DataFrame:
    """Of groups of a page with the same URL set keep the first."""
    same = Window.partitionBy("page_id", "url_set").orderBy("group_id")
    return groups.withColumn("nth", F.row_number().over(same)).where("nth = 1").drop("nth")


def candidates(groups: DataFrame) -> DataFrame:
    return groups.where("num_typical_url = 0 and url_count > 4 and is_social_media_num = 0 "
                        "and multi_level_path_pct = 1")


def prefer_verbs(groups: DataFrame, share: float = 20.0) -> DataFrame:
    """Keep groups with many verbs, but only where there is a choice and one of them passes."""
    passes = F.col("verb_percentage") > share
    choice = (F.count("*").over(_page()) > 1) & F.bool_or(passes).over(_page())
    return groups.withColumn("keep", ~choice | passes).where("keep").drop("keep")


def keep_largest(groups: DataFrame, measure: str) -> DataFrame:
    """Groups with the largest value on their page; ties stay."""
    return (groups.withColumn("top", F.max(measure).over(_page()))
            .where(F.col(measure) == F.col("top")).drop("top"))


def only_one(groups: DataFrame) -> DataFrame:
    return groups.withColumn("left", F.count("*").over(_page())).where("left = 1").drop("left")


def news_groups(groups: DataFrame) -> DataFrame:
    """The news list of each page: at most one group."""
    ranked = prefer_verbs(candidates(drop_equal_groups(groups)))
    ranked = keep_largest(keep_largest(ranked, "last_path_median_length"), "url_count")
    return only_one(ranked)


def hidden_share() -> Column:
    return F.size(F.filter("links", lambda a: a["hidden"])) / F.size("links")


def is_client_side() -> Column:
    """Most links of the winning list are hidden: the page switches them by script."""
    return hidden_share() > CLIENT_SIDE_SHARE


def news_links(winners: DataFrame, base: DataFrame, mode: str = "prefix") -> DataFrame:
    """One row per article link, absolute by ``base(page_id, base_url)``."""
    return (winners.join(base.select("page_id", "base_url"), "page_id")
            .select("page_id", "base_url", F.posexplode("urls").alias("url_no", "href"))
            .select("page_id", "url_no", "href",
                    urls.absolute_url(F.col("href"), F.col("base_url"), mode).alias("url")))
