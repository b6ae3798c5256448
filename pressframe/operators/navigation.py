"""How a listing is paged: year selector, load-more control, next link, and crawl cut-off."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressframe.functions.text import attr, strip
from pressframe.functions.urls import absolute_url
from pressframe.operators.links import is_client_side
from pressframe.operators.tree import holds, inside

YEAR_SHARE = 0.7

# Load-more rules in order of priority, as (what is tested, tag, value).
# "text" is the element's first own string, "*" any tag.
LOAD_MORE_RULES = [
    ("text", "li", "More News"), ("text", "li", "Load More"), ("text", "button", "Load More"),
    ("text", "button", "Show More"), ("text", "a", "Show More"), ("text", "a", "Load More"),
    ("text", "span", "Load More"), ("text", "div", "Load More"),
    ("class", "div", "load-more"), ("class", "div", "loadMore"), ("class", "button", "more"),
    ("class", "button", "load-more"), ("class", "a", "load-more"), ("class", "a", "loadMore"),
    ("id", "button", "load-more"), ("id", "button", "loadMore"), ("id", "div", "load-more"),
    ("text", "button", "View More"), ("text", "a", "View More"), ("text", "button", "See More"),
    ("text", "a", "See More"), ("icon", "button", "more"), ("more", "button", "More"),
    ("label", "*", "Load more"), ("label", "*", "Show more"),
]


def _has(name: str, value: str) -> Column:
    return F.coalesce(attr(name).contains(value), F.lit(False))


def load_more_controls(nodes: DataFrame) -> DataFrame:
    """``(page_id, rule, pos)``: the first rule that fits, and its first element.

    Text rules look at strings (first own string of their parent), the others at elements; a
    node yields all rules it meets and one filtered minimum picks the winner.  Only nodes that meet one, and
    buttons with the icons that may lie in them, leave the scan.
    """
    element, tag = F.col("kind") == "E", F.col("tag")
    first_own = (F.col("kind") == "T") & (F.col("own_no") == 0)
    at = F.when(F.col("kind") == "T", F.col("parent")).otherwise(F.col("pos"))
    direct, holding, by_icon = F, F.lit(False), []
    for rule, (what, name, value) in enumerate(LOAD_MORE_RULES, 1):
        if what == "text":
            test = first_own & (F.col("owner.tag") == name) & F.col("text").contains(value)
        elif what == "more":
            test = first_own & (F.col("owner.tag") == name) & F.col("text").contains(value) & ~F.col("text").contains("Learn")
        elif what == "icon":
            test = first_own & (F.col("owner.tag") == name) & F.col("text").contains("More")
            holding = holding | (element & (tag == name))
            by_icon.append(F.when(F.col("icon_tag") == name, F.struct(F.lit(rule).alias("rule"), F.col("pos"))))
        elif what == "label":
            test = element & (attr("aria-label") == value)
        else:
            test = element & (tag == name) & _has(what, value)
        direct = direct.when(test, F.lit(rule))  # the rules stand in their order, so the first that fits is the least
    none = F.lit(None).cast("struct<rule:int,pos:int>")
    icon = F.coalesce(element & (tag == "i") & _has("class", "more"), F.lit(False))
    rows = (nodes.select("page_id", "pos", "end_pos", F.when(direct.isNotNull(), F.struct(direct.alias("rule"), at.alias("pos"))).alias("direct"), icon.alias("icon"), F.when(holding, tag).alias("icon_tag"))
            .where("direct is not null or icon or icon_tag is not null").withColumn("has_icon", holds(F.col("icon"))))
    return (rows.select("page_id", F.least(none, "direct", *[F.when(F.col("has_icon"), hit) for hit in by_icon]).alias("hit"))
            .where("hit is not null").groupBy("page_id").agg(F.min("hit").alias("hit"))
            .select("page_id", "hit.rule", "hit.pos"))


def next_controls(nodes: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """``(page_id, rule, pos, clickable_pos, href[, next_url])``: the next-page control.

    Each rule names an element; it must be a link or hold a button or a link, else the next
    rule is tried.  With ``base(page_id, base_url)`` the target is resolved as a browser does.
    """
    element, tag = F.col("kind") == "E", F.col("tag")
    words = F.col("kind") == "T"
    names = ["li", "a", "span", "i", "button"]
    points = _has("class", "next") | _has("class", "right")
    css = F.coalesce(attr("class"), F.lit(""))
    # Attributes are judged before the windows, so flags travel instead of them.
    flags = {
        "points": points,
        "li_next": (tag == "li") & F.translate(css, "PAGE", "page").contains("page") & F.translate(css, "NEXT", "next").contains("next"),
        "menu_right": (tag == "span") & _has("class", "glyphicon-menu-right"),
        "arrow": (tag == "span") & (_has("class", "arrow-right") | _has("class", "next-arrow")),
        "chevron": (tag == "i") & (_has("class", "fa-chevron-right") | _has("class", "fa-arrow-right")),
        "sr_only": (tag == "span") & _has("class", "sr-only"),
        "spoken_next": (tag == "span") & (attr("aria-label") == "Next"),
        "paged": (tag == "a") & _has("href", "page="),
        "rel_next": _has("rel", "next") | _has("aria-label", "Next"),
    }
    small = (nodes.where((element & (tag.isin(names) | points))
                         | (words & (F.col("owner.tag") == "span") & F.col("text").contains("Next")))
             .select("page_id", "pos", "end_pos", "parent", "kind", "tag", "own_no",
                     *[F.coalesce(element & flag, F.lit(False)).alias(name) for name, flag in flags.items()]))
    # A page without an element that a rule could name goes no further.
    of_page = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    named_at_all = reduce(Column.__or__, [F.col(name) for name in flags if name not in ("points", "rel_next")])
    small = small.withColumn("named", F.max(named_at_all).over(of_page)).where("named").drop("named")
    rows = (small.withColumn("in_li", inside(element & (tag == "li")))
            .withColumn("in_li_a", inside(element & (tag == "a") & F.col("in_li")))
            .withColumn("points_below", holds(F.col("points"))))
    own, up = F.col("pos"), F.col("parent")
    rules = [  # (rule, test, element the rule names)
        (1, F.col("li_next"), own),
        (2, F.col("menu_right") & F.col("in_li_a"), up),
        (3, F.col("arrow") & F.col("in_li"), up),
        (4, F.col("chevron") & F.col("in_li"), up),
        (5, F.col("sr_only") & F.col("in_li") & F.col("next_word"), up),  # one more level up below
        (6, F.col("spoken_next") & F.col("in_li"), up),
        (7, F.col("paged") & F.col("in_li") & F.col("points_below"), own),
        (8, F.col("paged") & F.col("in_li") & F.col("rel_next"), own),
    ]
    # First own string of a span (own_no 0), seen from the span by an equi-join.
    spoken = (rows.where("kind = 'T' and own_no = 0")
              .select("page_id", F.col("parent").alias("pos"), F.lit(True).alias("said")))
    rows = (rows.where(element).join(spoken, ["page_id", "pos"], "left")
            .withColumn("next_word", F.coalesce("said", F.lit(False))))
    hits = F.array_compact(F.array(*[
        F.when(test, F.struct(F.lit(rule).alias("rule"), at.alias("pos")))
        for rule, test, at in rules]))
    found = rows.select("page_id", F.inline(hits))
    above = nodes.where(element).select("page_id", "pos", "end_pos", "parent", "tag", attr("href").alias("href"))
    steps = (found.where("rule = 5").join(above.select("page_id", "pos", "parent"), ["page_id", "pos"])
             .select("page_id", "rule", F.col("parent").alias("pos")))
    firsts = (found.where("rule <> 5").unionByName(steps).groupBy("page_id", "rule").agg(F.min("pos").alias("pos")))
    named = firsts.join(above, ["page_id", "pos"]).select("page_id", "rule", "pos", "end_pos", "tag", "href")
    # At most eight hits per page, so the residual below looks at few pairs.
    inner = (above.where(tag.isin("a", "button"))
             .select("page_id", F.col("pos").alias("in_pos"), F.col("tag").alias("in_tag"), F.col("href").alias("in_href")))
    held = (named.where("tag <> 'a'").join(inner, "page_id").where("in_pos > pos and in_pos <= end_pos")
            .groupBy("page_id", "rule", "pos")
            .agg(F.min(F.struct((F.col("in_tag") == "a").alias("link"), "in_pos", "in_href")).alias("in"))
            .select("page_id", "rule", "pos", F.col("in.in_pos").alias("clickable_pos"),
                    F.when(F.col("in.link"), F.col("in.in_href")).alias("href")))
    direct = named.where("tag = 'a'").select("page_id", "rule", "pos", F.col("pos").alias("clickable_pos"), "href")
    best = (direct.unionByName(held).groupBy("page_id")
            .agg(F.min(F.struct("rule", "pos", "clickable_pos", "href")).alias("hit")).select("page_id", "hit.*"))
    if base is None:
        return best
    return (best.join(base.select("page_id", "base_url"), "page_id")
            .withColumn("next_url", absolute_url(F.col("href"), F.col("base_url"), "rfc3986")).drop("base_url"))


def year_options(nodes: DataFrame) -> DataFrame:
    """Options with their select: ``(page_id, select_pos, pos, option_text, option_value)``.

    A text belongs to the last option opened before it, if that is still open, however deep it lies in there; an
    option without an end tag ends where the next one starts.
    """
    element, words = F.col("kind") == "E", F.col("kind") == "T"
    rows = nodes.where((element & F.col("tag").isin("select", "option")) | words).select(
        "page_id", "pos", "end_pos", "kind", "tag", "text", attr("value").alias("option_value"))
    before = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)

    def last_opened(tag: str) -> Column:
        return F.last(F.when(F.col("tag") == tag, F.struct("pos", "end_pos")), ignorenulls=True).over(before)

    placed = rows.withColumns({"opened": last_opened("select"), "within": last_opened("option")}).where("pos <= opened.end_pos and coalesce(tag, '') <> 'select'")
    option = F.when(F.col("tag") == "option", F.col("pos")).when(F.col("pos") <= F.col("within.end_pos"), F.col("within.pos"))
    placed = placed.withColumn("option", option).where("option > opened.pos")
    return (placed.groupBy("page_id", F.col("opened.pos").alias("select_pos"), F.col("option").alias("pos"))
            .agg(F.array_sort(F.collect_list(F.when(F.col("kind") == "T", F.struct("pos", "text")))).alias("pieces"),
                 F.max("option_value").alias("option_value"))
            .select("page_id", "select_pos", "pos", strip(F.array_join(F.col("pieces.text"), "")).alias("option_text"),
                    F.coalesce("option_value", strip(F.array_join(F.col("pieces.text"), ""))).alias("option_value")))


def is_year(text: Column) -> Column:
    return text.rlike(r"^\d{4}\z")


def is_all(text: Column) -> Column:
    return F.lower(text).contains("all")


def year_selectors(options: DataFrame) -> DataFrame:
    """First select of a page whose options are mostly years, with its option list."""
    per_select = options.groupBy("page_id", "select_pos").agg(
        F.count("*").alias("option_count"), F.count_if(is_year(F.col("option_text"))).alias("year_count"),
        F.bool_or(is_all(F.col("option_text"))).alias("has_all"),
        F.array_sort(F.collect_list(F.struct("pos", "option_text"))).alias("listed"))
    fits = (F.col("option_count") >= 2) & (F.col("year_count") > F.col("option_count") * F.lit(YEAR_SHARE).cast("double"))
    return (per_select.where(fits).groupBy("page_id")
            .agg(F.min(F.struct("select_pos", "option_count", "year_count", "has_all", "listed")).alias("s"))
            .select("page_id", "s.select_pos", "s.option_count", "s.year_count", "s.has_all",
                    F.col("s.listed.option_text").alias("options")))


def select_option(options: DataFrame, selectors: DataFrame, year: str | None = None) -> DataFrame:
    """Option to request: the first with "all" in it, or the one of a given year."""
    test = is_all(F.col("option_text")) if year is None else F.col("option_text") == str(year)
    return (options.join(selectors.select("page_id", "select_pos"), ["page_id", "select_pos"]).where(test)
            .groupBy("page_id").agg(F.min(F.struct("pos", "option_text", "option_value")).alias("o"))
            .select("page_id", "o.option_text", "o.option_value"))


def nav_plan(pages: DataFrame, selectors: DataFrame, winners: DataFrame) -> DataFrame:
    """``(page_id, mode, years, client_side)``: how to go on from a listing page.

    ``all`` asks for the all-years option, ``years`` for each numeric year, ``plain`` for nothing;
    ``client_side`` marks lists whose later pages are already in the page.
    """
    lists = winners.select("page_id", is_client_side().alias("client_side"))
    years = F.filter("options", is_year)
    return (pages.select("page_id").join(selectors, "page_id", "left").join(lists, "page_id", "left")
            .select("page_id",
                    F.when(F.col("has_all"), "all").when(F.col("has_all").isNotNull(), "years").otherwise("plain").alias("mode"),
                    F.when(~F.col("has_all"), years).alias("years"),
                    F.coalesce("client_side", F.lit(False)).alias("client_side")))


def crawl_cut(lists: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Pages of a crawl whose links count, from ``(site_id, year_no, page_no, client_side, ...)``.

    ``max_pages``, if given, is the last ``page_no`` that counts.  A client-side list on the first page of a year
    ends that year after this page and drops all later years.  The cut is one minimum per site
    joined back, so a site of any size stays spread out.
    """
    kept = lists if max_pages is None else lists.where(F.col("page_no") <= max_pages)
    cuts = (kept.where("client_side and page_no = 0").groupBy("site_id")
            .agg(F.min("year_no").alias("cut_year")))
    return (kept.join(cuts, "site_id", "left")
            .where("cut_year is null or year_no < cut_year or (year_no = cut_year and page_no = 0)").drop("cut_year"))
