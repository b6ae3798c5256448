"""Facts that need only a few elements of a page, gathered by one aggregate.

All "first element with ..." questions of title, dates and metadata are filtered minima of one
``groupBy("page_id")``.  Partial aggregation runs where the page was read, so the exchange
carries about one short row per page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressframe.functions.dates import published_instant, published_text
from pressframe.functions.text import attr, strip

TITLE_LIMIT = 200
PUBLISHED_PROPERTIES = ["article:published_time", "og:published_time"]
_JSON_LD = "application/ld+json"


def _first(condition: Column, *columns: Column) -> Column:
    return F.min(F.when(condition, F.struct("pos", *columns)))


def head_facts(nodes: DataFrame) -> DataFrame:
    tag, content, css_class = F.col("tag"), attr("content").alias("value"), F.lower(attr("class"))
    meta = tag == "meta"
    ld_script = (F.col("kind") == "E") & (tag == "script") & (attr("type") == _JSON_LD)
    ld_string = (F.col("kind") == "S") & (F.col("owner.type") == _JSON_LD) & (F.col("owner.tag") == "script")
    author_link = (tag == "a") & F.array_contains(F.split(attr("rel"), r"\s+"), "author")
    author_span = (tag == "span") & (css_class.contains("author") | css_class.contains("byline"))
    dated = meta & attr("property").isin(PUBLISHED_PROPERTIES)
    wanted = tag.isin("meta", "article", "h1") | ld_script | ld_string | author_link | author_span
    text = F.col("text").alias("value")
    facts = nodes.where(wanted & F.col("kind").isin("E", "S")).groupBy("page_id").agg(
        _first(meta & (attr("property") == "og:title"), content).alias("og_title"),
        _first(ld_script).alias("ld"),
        F.min(F.when(ld_string, F.struct("parent", "text"))).alias("ld_string"),
        _first(tag == "article", F.col("end_pos")).alias("article"),
        F.array_sort(F.collect_list(F.when(tag == "h1", F.struct("pos", text)))).alias("headings"),
        F.array_sort(F.collect_list(F.when(dated, F.struct("pos", content)))).alias("dated"),
        _first(meta & (attr("name") == "author"), content).alias("author_1"),
        _first(meta & (attr("property") == "article:author"), content).alias("author_2"),
        _first(author_link, text).alias("author_3"),
        _first(author_span, text).alias("author_4"),
        _first(meta & (attr("name") == "keywords"), content).alias("keywords_meta"),
        _first(meta & (attr("property") == "article:section"), content).alias("category_meta"),
    )
    own = F.when(F.col("ld_string.parent") == F.col("ld.pos"), F.col("ld_string.text"))
    return facts.withColumn("json_ld", read_json_ld(own)).drop("ld_string")


def read_json_ld(text: Column) -> Column:
    """``struct(headline, has_headline, date_published)`` of a JSON object, null for anything else.

    Spark's reader stops after the first complete value.  Wrapping the text once as a list item
    and once as a member shows up whatever trails it: no tail fits both wrappers.
    """
    options = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}
    item = F.from_json(F.concat(F.lit("["), text, F.lit("]")),
                       "array<struct<headline:string,datePublished:string>>", options)
    member = F.from_json(F.concat(F.lit('{"k":'), text, F.lit("}")),
                         "k struct<headline:string,datePublished:variant>, bad string",
                         {**options, "columnNameOfCorruptRecord": "bad"})
    sound = (strip(text).startswith("{") & (F.size(item) == 1) & member["bad"].isNull() & member["k"].isNotNull())
    keys = F.json_object_keys(text)
    date = member["k"]["datePublished"]  # only a text can be a date here, not a number
    return F.when(sound, F.struct(
        member["k"]["headline"].alias("headline"),
        F.coalesce(F.array_contains(keys, "headline"), F.lit(False)).alias("has_headline"),
        F.when(F.schema_of_variant(date) == "STRING", F.try_variant_get(date, "$", "string")).alias("date_published")))


def title_candidates(facts: DataFrame) -> DataFrame:
    """``(page_id, prio, pos, text)``; the page's own h1 is tried only when there is nothing else."""
    in_article = F.filter("headings", lambda h: (h["pos"] > F.col("article.pos"))
                          & (h["pos"] <= F.col("article.end_pos")))

    def candidate(prio: int, present: Column, pos: Column, text: Column) -> Column:
        row = F.struct(F.lit(prio).alias("prio"), pos.alias("pos"), text.alias("text"))
        return F.when(present, F.array(row)).otherwise(F.array())

    def heading(prio: int, rows: Column) -> Column:
        return candidate(prio, F.size(rows) > 0, F.try_element_at(rows, F.lit(1))["pos"],
                         F.try_element_at(rows, F.lit(1))["value"])

    og, ld = F.col("og_title"), F.col("json_ld")
    usual = F.concat(candidate(1, og.isNotNull(), og["pos"], og["value"]),
                     candidate(2, F.coalesce(ld["has_headline"], F.lit(False)), F.col("ld.pos"), ld["headline"]),
                     heading(3, in_article))
    rows = F.when(F.size(usual) > 0, usual).otherwise(heading(4, F.col("headings")))
    return facts.select("page_id", F.inline(rows))


def titles(found: DataFrame) -> DataFrame:
    """Longest non-empty candidate below the limit; the earlier method wins a tie."""
    length = F.length("text")
    return (found.where(length.between(1, TITLE_LIMIT - 1)).groupBy("page_id")
            .agg(F.min(F.struct((-length).alias("rank"), "prio", "pos", "text")).alias("best"))
            .select("page_id", "best.prio", "best.pos", F.col("best.text").alias("title")))


def head_dates(facts: DataFrame, as_of: Column) -> DataFrame:
    """``(page_id, pos, published_text, published_ts, method)`` from meta tags, else from JSON-LD."""
    metas = F.transform("dated", lambda d: F.struct(
        F.lit("meta").alias("method"), F.lit(1).alias("prio"), d["pos"].alias("pos"), d["value"].alias("value")))
    ld = F.struct(F.lit("json_ld").alias("method"), F.lit(2).alias("prio"), F.col("ld.pos").alias("pos"),
                  F.col("json_ld.date_published").alias("value"))
    rows = F.concat(metas, F.when(F.col("json_ld.date_published").isNotNull(), F.array(ld)).otherwise(F.array()))
    read = facts.select("page_id", F.inline(rows)).where("value is not null")
    read = read.withColumn("published_text", published_text(F.col("value"), as_of))
    # Unread values are left to the aggregate: a filter here would read the dates a second time.
    best = F.min(F.when(F.col("published_text").isNotNull(), F.struct("prio", "pos", "published_text", "method")))
    return (read.groupBy("page_id").agg(best.alias("best")).where("best is not null")
            .select("page_id", "best.pos", "best.published_text",
                    published_instant(F.col("best.published_text")).alias("published_ts"), "best.method"))


def metadata(facts: DataFrame) -> DataFrame:
    """Author (first of four methods), keywords as a list and category, with their element positions."""
    author = F.coalesce(*[F.col(f"author_{i}") for i in range(1, 5)])
    method = F.coalesce(*[F.when(F.col(f"author_{i}").isNotNull(), F.lit(i)) for i in range(1, 5)])
    words = F.transform(F.split(F.coalesce(F.col("keywords_meta.value"), F.lit("")), ","), strip)
    keywords = F.when(F.col("keywords_meta").isNotNull(), words)
    return facts.select(
        "page_id", author["pos"].alias("author_pos"), author["value"].alias("author"), method.alias("author_method"),
        F.col("keywords_meta.pos").alias("keywords_pos"), keywords.alias("keywords"),
        F.to_json(keywords).alias("keywords_json"),
        F.col("category_meta.pos").alias("category_pos"), F.col("category_meta.value").alias("category"))
