"""All registered queries: name -> (Spark callable, DuckDB statement or None)."""

from __future__ import annotations

from checks import build, sql, templates as t
from pyspark.sql import functions as F

from pressframe.functions import boilerplate as bp, urls
from pressframe.functions.text import attr
from pressframe.operators import content, dates, head, links, navigation, prune, tree
from pressframe.plans import articles, discovery, increments
from pressframe.sources import pages as src, runs
from pressframe.sources.dom import flatten_dom

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function
    return register


def long(*columns: str):
    return [F.col(c).cast("bigint").alias(c) for c in columns]


# --- URL rules -----------------------------------------------------------------------------

PAGE_URLS = "SELECT page_id, url AS u FROM pages"
ALL_URLS = f"SELECT page_id, url AS u FROM pages UNION ALL SELECT page_id, href AS u FROM ({t.ANCHORS})"


def all_urls(spark, sf):
    given = build.given_pages(spark, sf).select("page_id", F.col("url").alias("u"))
    return given.unionByName(build.rows(spark, sf, t.ANCHORS).select("page_id", F.col("href").alias("u")))


@query("url_structure", f"SELECT page_id, u, {', '.join(f'{e} AS {n}' for n, e in sql.flags('u').items())} FROM ({ALL_URLS})")
def url_structure(spark, sf):
    return all_urls(spark, sf).select("page_id", "u", *[c.alias(n) for n, c in urls.url_flags(F.col("u")).items()])


@query("url_path", f"SELECT page_id, u, {sql.path('u')} AS path FROM ({ALL_URLS})")
def url_path(spark, sf):
    return all_urls(spark, sf).select("page_id", "u", urls.url_path(F.col("u")).alias("path"))


@query("url_slug_length", f"SELECT page_id, u, {sql.slug('u')} AS slug, CAST(coalesce(length({sql.slug('u')}), 0) AS BIGINT) AS slug_length FROM ({ALL_URLS})")
def url_slug_length(spark, sf):
    u = F.col("u")
    return all_urls(spark, sf).select("page_id", "u", urls.slug(u).alias("slug"), urls.slug_length(u).cast("bigint").alias("slug_length"))


@query("url_verb_slug", f"WITH {sql.FORMS} SELECT page_id, u, {sql.verb('u')} AS has_verb FROM ({ALL_URLS})")
def url_verb_slug(spark, sf):
    return all_urls(spark, sf).select("page_id", "u", urls.has_verb(F.col("u")).alias("has_verb"))


@query("url_social", f"SELECT page_id, u, CAST({sql.social('u')} AS BIGINT) AS is_social FROM ({ALL_URLS})")
def url_social(spark, sf):
    return all_urls(spark, sf).select("page_id", "u", urls.is_social(F.col("u")).cast("bigint").alias("is_social"))


@query("url_typical", f"""SELECT page_id, pos, href, {sql.typical('href', 'text')} AS typical, {sql.typical_path('href')} AS typical_path
FROM ({t.ANCHORS})""")
def url_typical(spark, sf):
    href = F.col("href")
    return build.rows(spark, sf, t.ANCHORS).select(
        "page_id", "pos", "href", urls.is_typical(href, F.col("text")).alias("typical"),
        urls.is_typical(href, mode="path").alias("typical_path"))


@query("url_absolute", f"""WITH {sql.GIVEN_LINKS} SELECT page_id, href, {sql.absolute('href', 'url')} AS prefixed,
regexp_extract(url, '^(https?://[^/?#]*)', 1) || href AS resolved FROM links""")
def url_absolute(spark, sf):
    pages = build.given_pages(spark, sf)
    found = discovery.page_links(pages).join(pages.select("page_id", "url"), "page_id")
    href, url = F.col("href"), F.col("url")
    return found.select("page_id", "href", urls.absolute_url(href, url).alias("prefixed"),
                        urls.absolute_url(href, url, "rfc3986").alias("resolved"))


@query("verb_forms", f"""WITH {sql.FORMS}, words AS (SELECT page_id, unnest(list_filter(regexp_split_to_array(lower({sql.slug('href')}),
'[-_\\s.]'), lambda x: x <> '')) AS form FROM ({t.ANCHORS}))
SELECT verb, form, count(*) AS uses FROM words JOIN forms USING (form) GROUP BY verb, form""")
def verb_forms(spark, sf):
    words = build.rows(spark, sf, t.ANCHORS).select(F.explode(urls.slug_words(F.col("href"))).alias("form"))
    # Counted by form first, so the join with the verb table sees distinct forms only.
    uses = words.groupBy("form").agg(F.count("*").alias("uses"))
    return uses.join(urls.verb_table(spark), "form").groupBy("verb", "form").agg(F.sum("uses").alias("uses"))


@query("host_url_profile", f"""SELECT regexp_extract(u, '^https?://([^/?#]*)', 1) AS host, count(*) AS url_count,
avg(coalesce(length({sql.slug('u')}), 0)) AS mean_length, {', '.join(f'count(*) FILTER ({e}) AS {n}_count' for n, e in sql.flags('u').items())}
FROM ({PAGE_URLS}) GROUP BY 1""")
def host_url_profile(spark, sf):
    u = F.col("u")
    rows = build.given_pages(spark, sf).select(F.col("url").alias("u"))
    flags = urls.url_flags(u)
    return rows.groupBy(F.regexp_extract("u", r"^https?://([^/?#]*)", 1).alias("host")).agg(
        F.count("*").alias("url_count"), F.avg(urls.slug_length(u)).alias("mean_length"),
        *[F.count_if(c).alias(f"{n}_count") for n, c in flags.items()])


# --- Reading HTML ----------------------------------------------------------------------------

@query("dom_tag_counts", """WITH body AS (SELECT page_id, regexp_replace(html, '<!--.*?-->|(<script>).*?</script>|(<style>).*?</style>', '\\1\\2', 'gs') AS b FROM pages),
tags AS (SELECT page_id, unnest(regexp_extract_all(b, '<([a-z][a-z0-9]*)', 1)) AS tag FROM body)
SELECT page_id, tag, count(*) AS n FROM tags GROUP BY page_id, tag""")
def dom_tag_counts(spark, sf):
    nodes = flatten_dom(build.given_pages(spark, sf))
    return nodes.where("kind = 'E'").groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@query("link_anchors", f"WITH {sql.GIVEN_LINKS} SELECT page_id, n, anc_flex, anc_strict, href, text FROM (SELECT *, pos AS n FROM links)")
def link_anchors(spark, sf):
    from pyspark.sql import Window
    found = discovery.page_links(build.given_pages(spark, sf))
    n = F.row_number().over(Window.partitionBy("page_id").orderBy("pos")).cast("bigint").alias("n")
    return found.select("page_id", n, "anc_flex", "anc_strict", "href", "text")


@query("valid_links", f"SELECT page_id, pos, href FROM ({t.ANCHORS}) WHERE {sql.valid('href')}")
def valid_links(spark, sf):
    return links.valid_links(build.rows(spark, sf, t.ANCHORS)).select("page_id", "pos", "href")


# Closed form of the tree template: html 1, body 2, div 3, n spans, a, "go ", b, "now", tail.
TREE_ROWS = f"""src AS ({t.TREES}),
el AS (SELECT page_id, n, 1 AS pos, 8 + n AS end_pos, 0 AS parent, 1 AS depth, 'E' AS kind, 'html' AS tag FROM src
UNION ALL SELECT page_id, n, 2, 8 + n, 1, 2, 'E', 'body' FROM src UNION ALL SELECT page_id, n, 3, 7 + n, 2, 3, 'E', 'div' FROM src
UNION ALL SELECT page_id, n, 3 + i, 7 + n, 2 + i, 3 + i, 'E', 'span' FROM (SELECT page_id, n, unnest(range(1, n + 1)) AS i FROM src)
UNION ALL SELECT page_id, n, 4 + n, 7 + n, 3 + n, 4 + n, 'E', 'a' FROM src UNION ALL SELECT page_id, n, 5 + n, 5 + n, 4 + n, 5 + n, 'T', NULL FROM src
UNION ALL SELECT page_id, n, 6 + n, 7 + n, 4 + n, 5 + n, 'E', 'b' FROM src UNION ALL SELECT page_id, n, 7 + n, 7 + n, 6 + n, 6 + n, 'T', NULL FROM src
UNION ALL SELECT page_id, n, 8 + n, 8 + n, 2, 3, 'T', NULL FROM src)"""


@query("dom_nodes", f"""WITH {TREE_ROWS} SELECT page_id, CAST(pos AS BIGINT) AS pos, CAST(end_pos AS BIGINT) AS end_pos, CAST(parent AS BIGINT) AS parent,
CAST(depth AS BIGINT) AS depth, kind, tag, CAST(pos - 1 AS BIGINT) AS node_idx,
CASE WHEN kind = 'T' THEN row_number() OVER (PARTITION BY page_id, kind ORDER BY pos) END AS seq FROM el""")
def dom_nodes(spark, sf):
    return flatten_dom(build.tree_pages(spark, sf)).select(
        "page_id", *long("pos", "end_pos", "parent", "depth"), "kind", "tag", *long("node_idx", "seq"))


@query("ancestor_flags", f"""WITH {TREE_ROWS} SELECT page_id, CAST(pos AS BIGINT) AS pos, tag,
CASE WHEN tag IN ('a', 'b') THEN n > 0 WHEN tag = 'span' THEN pos > 4 ELSE false END AS in_span,
CASE WHEN tag IN ('html', 'body', 'div') THEN n > 0 WHEN tag = 'span' THEN pos < 3 + n ELSE false END AS has_span FROM el WHERE kind = 'E'""")
def ancestor_flags(spark, sf):
    nodes = flatten_dom(build.tree_pages(spark, sf)).where("kind = 'E'").select("page_id", "pos", "end_pos", "tag")
    span = F.col("tag") == "span"
    return (nodes.withColumn("in_span", tree.inside(span)).withColumn("has_span", tree.holds(span))
            .select("page_id", *long("pos"), "tag", "in_span", "has_span"))


@query("subtree_text_length", f"""WITH {TREE_ROWS} SELECT page_id, CAST(pos AS BIGINT) AS pos, tag, CAST(CASE WHEN tag IN ('html', 'body') THEN 5 + length('tail ' || p_name)
WHEN tag = 'b' THEN 3 ELSE 5 END AS BIGINT) AS text_len FROM el JOIN (SELECT page_id, p_name FROM src) USING (page_id) WHERE kind = 'E'""")
def subtree_text_length(spark, sf):
    return flatten_dom(build.tree_pages(spark, sf)).where("kind = 'E'").select("page_id", *long("pos"), "tag", *long("text_len"))


@query("subtree_text", f"""WITH {TREE_ROWS} SELECT page_id, CAST(pos AS BIGINT) AS pos, tag, 'gonow' || CASE WHEN tag = 'body' THEN 'tail ' || p_name ELSE '' END AS stripped,
'go now' || CASE WHEN tag = 'body' THEN 'tail ' || p_name ELSE '' END AS raw FROM el JOIN (SELECT page_id, p_name FROM src) USING (page_id) WHERE tag IN ('a', 'body')""")
def subtree_text(spark, sf):
    nodes = src.write_stage(flatten_dom(build.tree_pages(spark, sf)), "trees")
    targets = nodes.where("tag in ('a', 'body')").select("page_id", F.col("pos").alias("t_pos"), F.col("end_pos").alias("t_end"), "tag")
    stripped = tree.subtree_text(nodes, targets).withColumnRenamed("subtree", "stripped")
    raw = tree.subtree_text(nodes, targets, raw=True).withColumnRenamed("subtree", "raw")
    return (targets.join(stripped, ["page_id", "t_pos"]).join(raw, ["page_id", "t_pos"])
            .select("page_id", F.col("t_pos").cast("bigint").alias("pos"), "tag", "stripped", "raw"))


@query("hidden_links", f"SELECT page_id, outer_hides AND n + 1 <= 3 AS hidden FROM ({t.TREES})")
def hidden_links(spark, sf):
    return discovery.page_links(build.tree_pages(spark, sf)).select("page_id", "hidden")


# --- Link groups -----------------------------------------------------------------------------

A = f"WITH a AS ({t.ANCHORS}), {sql.groups('a')} "
FEATURES = (["url_count", "num_unique_strict_ancestry", "num_typical_url", "last_path_mean_length", "last_path_median_length",
             "urls_with_verbs", "verb_percentage"] + [f"{n}_count" for n in sql.FLAG_NAMES] + [f"{n}_pct" for n in sql.FLAG_NAMES])


def template_groups(spark, sf):
    return links.link_groups(build.rows(spark, sf, t.ANCHORS).repartition("page_id"))


def features(frame):
    names = [F.col(c).cast("bigint").alias(c) if c == "last_path_median_length" else F.col(c) for c in FEATURES]
    return frame.select("page_id", *long("group_id"), "ancestry", *names, *long("is_social_media_num"), "is_social_media_pct",
                        F.array_join("urls", " ").alias("urls"))


FEATURE_SQL = (f"SELECT page_id, group_id, ancestry, {', '.join(FEATURES)}, CAST(0 AS BIGINT) AS is_social_media_num, "
               "CAST(0 AS DOUBLE) AS is_social_media_pct, array_to_string(urls, ' ') AS urls")


@query("link_group_features", A + FEATURE_SQL + " FROM groups")
def link_group_features(spark, sf):
    return features(template_groups(spark, sf))


@query("link_group_twins", A + "SELECT page_id, group_id, ancestry, twin_group, non_excl_url FROM groups")
def link_group_twins(spark, sf):
    return template_groups(spark, sf).select("page_id", *long("group_id"), "ancestry", "twin_group", "non_excl_url")


@query("link_group_dedup", A + "SELECT page_id, group_id, ancestry FROM dedup")
def link_group_dedup(spark, sf):
    return links.drop_equal_groups(template_groups(spark, sf)).select("page_id", *long("group_id"), "ancestry")


@query("link_group_candidates", A + "SELECT page_id, group_id, ancestry FROM cand")
def link_group_candidates(spark, sf):
    return links.candidates(links.drop_equal_groups(template_groups(spark, sf))).select("page_id", *long("group_id"), "ancestry")


@query("link_group_verb_filter", A + "SELECT page_id, group_id, ancestry FROM verbal")
def link_group_verb_filter(spark, sf):
    found = links.prefer_verbs(links.candidates(links.drop_equal_groups(template_groups(spark, sf))))
    return found.select("page_id", *long("group_id"), "ancestry")


@query("link_group_winner", A + FEATURE_SQL + " FROM winner")
def link_group_winner(spark, sf):
    return features(links.news_groups(template_groups(spark, sf)))


@query("news_links_from_html", A + f"""SELECT page_id, CAST(i - 1 AS BIGINT) AS url_no, href, {sql.absolute('href', "'https://ir' || CAST(page_id AS STRING) || '.example.com/list/'")} AS url
FROM (SELECT page_id, unnest(urls) AS href, generate_subscripts(urls, 1) AS i FROM winner)""")
def news_links_from_html(spark, sf):
    found = discovery.discover_links(build.listing_pages(spark, sf))
    return found.select("page_id", *long("url_no"), "href", "url")


@query("news_link_discovery", f"""WITH {sql.GIVEN_LINKS}, {sql.groups('links')}
SELECT page_id, CAST(i - 1 AS BIGINT) AS url_no, href, {sql.absolute('href', 'url')} AS url
FROM (SELECT page_id, unnest(urls) AS href, generate_subscripts(urls, 1) AS i FROM winner) JOIN pages USING (page_id)""")
def news_link_discovery(spark, sf):
    found = discovery.discover_links(build.given_pages(spark, sf))
    return found.select("page_id", *long("url_no"), "href", "url")


@query("client_side_lists", A + """, h AS (SELECT w.page_id, avg(CAST(f.hides AS INT)) AS hidden_share FROM winner w JOIN firsts f
ON w.page_id = f.page_id AND w.ancestry = f.anc_flex GROUP BY w.page_id)
SELECT page_id, hidden_share, hidden_share > 0.6 AS client_side FROM h""")
def client_side_lists(spark, sf):
    found = discovery.discover_groups(build.listing_pages(spark, sf))
    return found.select("page_id", links.hidden_share().alias("hidden_share"), links.is_client_side().alias("client_side"))


@query("all_news_urls", A + """SELECT url, count(*) AS n FROM (SELECT unnest(urls) AS url FROM winner) GROUP BY url""")
def all_news_urls(spark, sf):
    found = links.news_groups(template_groups(spark, sf))
    return found.select(F.explode("urls").alias("url")).groupBy("url").agg(F.count("*").alias("n"))


# --- Boilerplate and dates in text -------------------------------------------------------------

@query("boilerplate_lines", f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER ({sql.basic('x')}) AS n_boilerplate, count(*) FILTER ({sql.header('x', 'false')}) AS n_header
FROM l GROUP BY doc_id""")
def boilerplate_lines(spark, sf):
    none = F.lit("")
    lines = build.rows(spark, sf, "SELECT doc_id, explode(split(text, '\n')) AS x FROM documents")
    basic, header = bp.boilerplate(F.col("x"), none, none, none)
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(basic).alias("n_boilerplate"),
                                       F.count_if(header).alias("n_header"))


def judged_lines(spark, sf):
    lines = tree.text_nodes(flatten_dom(build.text_pages(spark, sf)))
    basic, header = bp.boilerplate(F.col("text"), F.col("parent_tag"), F.col("parent_class"), F.col("parent_style"))
    return lines.withColumn("is_boilerplate", basic).withColumn("is_header", header)


@query("boilerplate_headers", f"WITH {sql.LINES} SELECT page_id, seq, text, parent_tag, is_boilerplate, is_header FROM judged")
def boilerplate_headers(spark, sf):
    return judged_lines(spark, sf).select("page_id", *long("seq"), "text", "parent_tag", "is_boilerplate", "is_header")


@query("section_cutoff", f"""WITH {sql.LINES} SELECT page_id, seq, text FROM
(SELECT *, min(CASE WHEN is_header THEN seq END) OVER (PARTITION BY page_id) AS stop FROM judged) WHERE (stop IS NULL OR seq < stop) AND NOT is_boilerplate""")
def section_cutoff(spark, sf):
    from pyspark.sql import Window
    stop = F.min(F.when(F.col("is_header"), F.col("seq"))).over(Window.partitionBy("page_id"))
    kept = judged_lines(spark, sf).withColumn("stop", stop).where("(stop is null or seq < stop) and not is_boilerplate")
    return kept.select("page_id", *long("seq"), "text")


SCORED = f"""WITH {sql.LINES}, {sql.dates('lines')}, scored AS (SELECT f.page_id, f.seq, f.pattern_no, f.day,
  CASE WHEN l.parent_class = 'news-date' THEN 5 ELSE 0 END + CASE WHEN contains(f.text, 'Published') THEN 5 ELSE 0 END AS score
  FROM found f JOIN lines l USING (page_id, seq))"""


@query("date_candidates", SCORED + " SELECT page_id, seq, CAST(pattern_no AS BIGINT) AS pattern_no, day, CAST(score AS BIGINT) AS score FROM scored")
def date_candidates(spark, sf):
    nodes = src.write_stage(flatten_dom(build.text_pages(spark, sf)), "lines")
    found = dates.text_date_candidates(nodes).join(nodes.select("page_id", "pos", "seq"), ["page_id", "pos"])
    return found.select("page_id", *long("seq", "pattern_no"), "day", *long("score"))


@query("text_date", SCORED + """ SELECT page_id, strftime(day, '%Y-%m-%d') || ' 00:00:00' AS published_text FROM
(SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pattern_no, seq) AS rn FROM scored) WHERE rn = 1""")
def text_date(spark, sf):
    nodes = src.write_stage(flatten_dom(build.text_pages(spark, sf)), "lines")
    return dates.best_text_dates(dates.text_date_candidates(nodes)).select("page_id", "published_text")


# Dates in paragraphs that are never closed, so each holds all that follow: the word comes last, before, cut in pieces, or not at all.
NESTED_DATES = """SELECT p_partkey AS page_id, CAST(p_size % 9 + 1 AS BIGINT) AS n, CAST(p_partkey % 5 AS BIGINT) AS k, concat(
CASE p_partkey % 5 WHEN 1 THEN '<p>posted' WHEN 4 THEN '<div><i>re</i>' ELSE '' END, repeat('<p>On 2020-03-04 ', CAST(p_size % 9 + 1 AS INT)),
CASE p_partkey % 5 WHEN 0 THEN '<p>Released' WHEN 2 THEN '<b>P</b>u<i>b</i>l<b>ish</b>ed' WHEN 3 THEN '<p>p<br>r<hr>e<i> </i>ss' WHEN 4 THEN '<p>rel</div>ease' ELSE '' END) AS html FROM part"""


@query("nested_dates", f"""SELECT page_id, n AS n_dates, CASE WHEN k IN (0, 2) THEN 5 * n ELSE 0 END AS points FROM ({NESTED_DATES.replace("CAST(p_size % 9 + 1 AS INT)", "CAST(p_size % 9 + 1 AS BIGINT)")})""")
def nested_dates(spark, sf):
    nodes = src.write_stage(flatten_dom(build.spread(build.rows(spark, sf, NESTED_DATES))), "nested")
    found = dates.text_date_candidates(nodes)
    return found.groupBy("page_id").agg(F.count("*").alias("n_dates"), F.sum("score").cast("bigint").alias("points"))


# --- Articles ----------------------------------------------------------------------------------

W = f"WITH {sql.ARTICLE} "


def article_nodes(spark, sf):
    return src.write_stage(flatten_dom(build.article_pages(spark, sf)), "articles")


def article_facts(spark, sf):
    return head.head_facts(flatten_dom(build.article_pages(spark, sf)))


@query("title_candidates", W + """SELECT page_id, CAST(prio AS BIGINT) AS prio, text FROM cands UNION ALL
SELECT page_id, 1, og FROM titled WHERE og IS NOT NULL AND NOT og_ok""")
def title_candidates(spark, sf):
    return head.title_candidates(article_facts(spark, sf)).select("page_id", *long("prio"), "text")


@query("article_title", W + "SELECT page_id, CAST(prio AS BIGINT) AS prio, title FROM best")
def article_title(spark, sf):
    found = head.titles(head.title_candidates(article_facts(spark, sf)))
    return found.select("page_id", *long("prio"), "title")


@query("head_date", W + "SELECT page_id, published_text, method FROM dated WHERE method IN ('meta', 'json_ld')")
def head_date(spark, sf):
    found = head.head_dates(article_facts(spark, sf), F.current_timestamp())
    return found.select("page_id", "published_text", "method")


# Head dates in many forms, a page for each order; two forms are no date: of these one has another in JSON-LD.
DATE_FORMS = """SELECT k AS page_id, k % 12 AS form, y, m, d, h, n, second_date, CASE k % 12
  WHEN 0 THEN concat(y4, m2, d2) WHEN 1 THEN concat(y4, m2, d2, 'T', h2, n2, '07') WHEN 2 THEN concat(h2, ':', n2, ' ', name, ' ', d1, ' ', y4, ' EST')
  WHEN 3 THEN concat('Friday, ', name, ' ', d1, 'th, ', y4, ' at 3:', n2, ' p.m. ET') WHEN 4 THEN concat(d1, '.', m1, '.', y4)
  WHEN 5 THEN concat(d1, '/', m1, '/', substring(y4, 3, 2), ' ', h2, ':', n2, ' GMT+3') WHEN 6 THEN concat(name, ' ', y4)
  WHEN 7 THEN concat('on or about ', name, ' ', d1) WHEN 8 THEN concat(y4, name, d1) WHEN 9 THEN concat(d1, ' ', name, ' ', y4, ' ', h2, 'h', n2)
  WHEN 10 THEN concat(y4, '-', name, '-', d2, ' 12:', n2, ' AM UTC') ELSE concat('Sun ', name, ' ', d2, ' ', h2, ':', n2, ':09 -0530 ', y4) END AS shown
FROM (SELECT *, concat(y4, '/', m1, '/', d1) AS second_date FROM (SELECT *, CAST(y AS STRING) AS y4, CAST(m AS STRING) AS m1, CAST(d AS STRING) AS d1,
  lpad(CAST(m AS STRING), 2, '0') AS m2, lpad(CAST(d AS STRING), 2, '0') AS d2, lpad(CAST(h AS STRING), 2, '0') AS h2, lpad(CAST(n AS STRING), 2, '0') AS n2,
  substring('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * m - 2 AS INT), 3) AS name
  FROM (SELECT o_orderkey AS k, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, o_orderkey % 24 AS h, o_orderkey % 60 AS n FROM orders) a) b) c"""


@query("head_date_forms", f"""SELECT page_id, method, day || ' ' || clock AS published_text FROM (SELECT page_id, CASE WHEN form = 7 THEN 'json_ld' ELSE 'meta' END AS method,
CASE WHEN form IN (4, 5) AND d <= 12 THEN printf('%04d-%02d-%02d', y, d, m)
  WHEN form = 6 THEN printf('%04d-%02d-%02d', y, m, least(day(current_date), day(last_day(make_date(y, m, 1))))) ELSE printf('%04d-%02d-%02d', y, m, d) END AS day,
CASE form WHEN 1 THEN printf('%02d:%02d:07', h, n) WHEN 2 THEN printf('%02d:%02d:00', h, n) WHEN 3 THEN printf('15:%02d:00', n) WHEN 5 THEN printf('%02d:%02d:00-03:00', h, n)
  WHEN 9 THEN printf('%02d:%02d:00', h, n) WHEN 10 THEN printf('00:%02d:00+00:00', n) WHEN 11 THEN printf('%02d:%02d:09-05:30', h, n) ELSE '00:00:00' END AS clock
FROM ({DATE_FORMS}) WHERE form <> 8)""")
def head_date_forms(spark, sf):
    html = """concat('<head><meta property="article:published_time" content="', shown, '">', CASE WHEN form = 7 THEN
        concat('<script type="application/ld+json">{"datePublished": "', second_date, '"}</script>') ELSE '' END, '</head>') AS html"""
    pages = build.spread(build.rows(spark, sf, DATE_FORMS).selectExpr("page_id", html))
    found = head.head_dates(head.head_facts(flatten_dom(pages)), F.current_timestamp())
    return found.select("page_id", "published_text", "method")


@query("article_date", W + "SELECT page_id, published_text, method FROM dated WHERE method IS NOT NULL")
def article_date(spark, sf):
    nodes = article_nodes(spark, sf)
    facts = src.write_stage(head.head_facts(nodes), "facts")
    first = head.head_dates(facts, F.current_timestamp())
    return dates.article_dates(nodes, first).select("page_id", "published_text", "method")


@query("article_metadata", W + """SELECT page_id, author, CAST(nullif(author_method, 0) AS BIGINT) AS author_method, keywords_json, category FROM meta
WHERE EXISTS (SELECT 1 FROM parts p WHERE p.page_id = meta.page_id)""")
def article_metadata(spark, sf):
    found = head.metadata(article_facts(spark, sf))
    pages = build.rows(spark, sf, "SELECT c_custkey AS page_id FROM customer")
    return pages.join(found, "page_id", "left").select("page_id", "author", *long("author_method"), "keywords_json", "category")


@query("content_root", W + """SELECT page_id, CASE WHEN k % 5 <> 4 THEN 'article' WHEN k % 10 = 4 THEN 'div' ELSE 'section' END AS tag,
CAST(CASE WHEN k % 5 <> 4 THEN 1 WHEN k % 10 = 4 THEN 2 ELSE 3 END AS BIGINT) AS root_method FROM parts""")
def content_root(spark, sf):
    nodes = article_nodes(spark, sf)
    roots = content.content_roots(nodes)
    return (roots.join(nodes.select("page_id", F.col("pos").alias("root_pos"), "tag"), ["page_id", "root_pos"])
            .select("page_id", "tag", *long("root_method")))


@query("content_labels", W + "SELECT page_id, 'content' AS label_type, n_content AS n FROM counted UNION ALL SELECT page_id, 'table', n_tables FROM counted WHERE n_tables > 0")
def content_labels(spark, sf):
    rows = content.content_rows(flatten_dom(build.article_pages(spark, sf)))
    return (content.content_labels(rows).where("label_type in ('content', 'table')").groupBy("page_id", "label_type")
            .agg(F.count("*").alias("n")))


@query("content_text", W + """, shown AS (SELECT page_id, opening_html, header_html, is_cut, k FROM parts)
SELECT page_id, regexp_extract(opening_html, '>(.*)<', 1) AS text FROM shown UNION ALL SELECT page_id, unnest(['Point one', 'Point two ', 'bold']) FROM shown
UNION ALL SELECT page_id, 'After text' FROM shown WHERE NOT is_cut UNION ALL SELECT page_id, 'About Acme, Inc.' FROM shown WHERE k % 7 = 3
UNION ALL SELECT page_id, repeat('z ', 150) FROM shown WHERE k % 10 = 4
UNION ALL SELECT page_id, x FROM (SELECT page_id, unnest(list_filter(regexp_split_to_array(dates_html, '<[^>]*>'), lambda v: v <> '')) AS x FROM parts)""")
def content_text(spark, sf):
    nodes = article_nodes(spark, sf)
    kept = content.content_rows(nodes).where("role = 'content' and not skipped").select("page_id", "pos")
    return nodes.join(kept, ["page_id", "pos"], "left_semi").select("page_id", "text")


@query("article_tables", W + """, cells AS (SELECT page_id, name, is_cut, k FROM parts)
SELECT page_id, CAST(1 AS BIGINT) AS table_no, CAST(r AS BIGINT) AS row_no, CAST(c AS BIGINT) AS col_no, is_header, text FROM (
SELECT page_id, 1 AS r, 1 AS c, true AS is_header, 'Name' AS text FROM cells WHERE k % 6 = 1 UNION ALL SELECT page_id, 1, 2, true, '' FROM cells WHERE k % 6 = 1
UNION ALL SELECT page_id, 2, 1, false, name FROM cells WHERE k % 6 = 1 UNION ALL SELECT page_id, 2, 2, false, '' FROM cells WHERE k % 6 = 1
UNION ALL SELECT page_id, 1, 1, false, '' FROM cells WHERE k % 6 = 2)
UNION ALL SELECT page_id, CASE WHEN k % 6 IN (1, 2) THEN 2 ELSE 1 END, 1, 1, false, 'late' FROM cells""")
def article_tables(spark, sf):
    from pyspark.sql import Window
    cells = content.table_cells(flatten_dom(build.article_pages(spark, sf)))
    table_no = F.dense_rank().over(Window.partitionBy("page_id").orderBy("table_pos")).cast("bigint").alias("table_no")
    return cells.select("page_id", table_no, *long("row_no", "col_no"), "is_header", "text")


@query("cell_labels", W + """SELECT page_id, 'table_header' AS label_type, CAST(1 AS BIGINT) AS n FROM parts WHERE k % 6 = 1 UNION ALL
SELECT page_id, 'table_cell', CAST(k % 6 = 1 AS BIGINT) + CAST(NOT is_cut AS BIGINT) FROM parts WHERE k % 6 = 1 OR NOT is_cut""")
def cell_labels(spark, sf):
    rows = content.content_rows(flatten_dom(build.article_pages(spark, sf)))
    return (content.content_labels(rows).where("label_type in ('table_header', 'table_cell')").groupBy("page_id", "label_type")
            .agg(F.count("*").alias("n")))


# A table with spans over rows and columns, spans that are no numbers, a span to the end, a nested table and a row left empty by spans.
SPANNED = """SELECT p_partkey AS page_id, p_name, concat('<table><tr><td rowspan="2">', p_name, '</td><th colspan="2">b</th></tr>',
'<tr><td>c</td><td>d<table><tr><td colspan="0">in</td><td rowspan=" 3x">side</td></tr><tr><td>low</td></tr></table></td></tr>',
'<tr><td colspan="x">e</td><td rowspan="0">f</td><td>g</td></tr><tr></tr><tr><td>h</td><td>i</td></tr></table>') AS html FROM part"""
GRID = [(1, 1, 1, 2, 1, "p_name"), (1, 1, 2, 1, 2, "'b'"), (1, 2, 2, 1, 1, "'c'"), (1, 2, 3, 1, 1, "'d'"), (1, 3, 1, 1, 1, "'e'"), (1, 3, 2, 0, 1, "'f'"), (1, 3, 3, 1, 1, "'g'"),
        (1, 4, 1, 1, 1, "'h'"), (1, 4, 3, 1, 1, "'i'"), (2, 1, 1, 1, 1, "'in'"), (2, 1, 2, 3, 1, "'side'"), (2, 2, 1, 1, 1, "'low'")]


@query("table_grid", "SELECT page_id, CAST(c[1] AS BIGINT) AS table_no, CAST(c[2] AS BIGINT) AS grid_row, CAST(c[3] AS BIGINT) AS grid_col, CAST(c[4] AS BIGINT) AS row_span, "
       "CAST(c[5] AS BIGINT) AS col_span, text = 'b' AS is_header, text FROM (" + " UNION ALL ".join(
           f"SELECT p_partkey AS page_id, [{', '.join(map(str, cell))}] AS c, {text} AS text FROM part" for *cell, text in GRID) + ")")
def table_grid(spark, sf):
    from pyspark.sql import Window
    cells = content.table_grid(src.write_stage(flatten_dom(build.spread(build.rows(spark, sf, SPANNED))), "spans"))
    table_no = F.dense_rank().over(Window.partitionBy("page_id").orderBy("table_pos")).cast("bigint").alias("table_no")
    return cells.select("page_id", table_no, *long("grid_row", "grid_col", "row_span", "col_span"), "is_header", "text")


@query("clean_html", W + f"SELECT page_id, {build.article_html(kept=True, prio='coalesce(prio, 0)')} AS clean_html FROM parts LEFT JOIN best USING (page_id)")
def clean_html(spark, sf):
    nodes = article_nodes(spark, sf)
    return articles.clean_html(nodes, articles.labels(articles.article_parts(nodes)))


@query("render_roundtrip", W + f"SELECT page_id, {build.article_html()} AS html FROM parts")
def render_roundtrip(spark, sf):
    return prune.render_html(flatten_dom(build.article_pages(spark, sf))).withColumnRenamed("clean_html", "html")


@query("prune_verify", W + "SELECT page_id, true AS labels_kept FROM parts")
def prune_verify(spark, sf):
    nodes = article_nodes(spark, sf)
    return articles.check_prune(nodes, articles.labels(articles.article_parts(nodes)))


@query("article_records", W + """SELECT page_id, url, title, published_text, author, keywords_json AS keywords, meta.category AS category, n_content, n_tables,
k % 7 = 2 AS ref_would_fail, CAST(NULL AS STRING) AS error FROM parts LEFT JOIN best USING (page_id) JOIN dated USING (page_id) JOIN meta USING (page_id) JOIN counted USING (page_id)""")
def article_records(spark, sf):
    pages = build.article_pages(spark, sf)
    record = articles.article_records(pages, src.write_stage(flatten_dom(pages), "articles"), html=False)
    return record.withColumn("keywords", F.to_json("keywords")).select("page_id", "url", "title", "published_text", "author", "keywords", "category", "n_content", "n_tables",
                         "ref_would_fail", "error")


@query("page_titles", """SELECT page_id, title FROM (SELECT page_id, trim(replace(replace(replace(
regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS title FROM pages) WHERE length(title) BETWEEN 1 AND 199""")
def page_titles(spark, sf):
    facts = head.head_facts(flatten_dom(build.given_pages(spark, sf)))
    return head.titles(head.title_candidates(facts)).select("page_id", "title")


# --- Navigation -----------------------------------------------------------------------------------

MORE = "[" + ", ".join(str(r) for _, r in t.LOAD_MORE) + "]"
NEXT_RULES = "[" + ", ".join(str(n[1]) for n in t.NEXT) + "]"
NEXT_HREFS = "[" + ", ".join(f"'{n[2]}'" if n[2] else "NULL" for n in t.NEXT) + "]"


@query("load_more_controls", f"SELECT page_id, rule FROM (SELECT page_id, CAST({MORE}[more_case + 1] AS BIGINT) AS rule FROM ({t.CONTROLS})) WHERE rule > 0")
def load_more_controls(spark, sf):
    return navigation.load_more_controls(flatten_dom(build.control_pages(spark, sf))).select("page_id", *long("rule"))


@query("next_controls", f"""SELECT page_id, rule, href, CASE WHEN starts_with(href, '?') THEN split_part(url, '?', 1) || href ELSE 'https://news.example.com' || href END AS next_url
FROM (SELECT page_id, url, CAST({NEXT_RULES}[next_case + 1] AS BIGINT) AS rule, {NEXT_HREFS}[next_case + 1] AS href FROM ({t.CONTROLS})) WHERE rule > 0""")
def next_controls(spark, sf):
    pages = build.control_pages(spark, sf)
    nodes = discovery.listing_nodes(pages)
    found = navigation.next_controls(nodes, pages.select("page_id", F.col("url").alias("base_url")))
    return found.select("page_id", *long("rule"), "href", "next_url")


YEAR_SQL = f"""WITH y AS (SELECT *, n_years + n_other + CAST(has_all AS BIGINT) AS total FROM ({t.YEARS})),
ok AS (SELECT * FROM y WHERE total >= 2 AND n_years > total * CAST(0.7 AS DOUBLE))"""


@query("year_selector", YEAR_SQL + """ SELECT page_id, total AS option_count, n_years AS year_count, has_all,
CASE WHEN has_all THEN 'All Years|' ELSE '' END || array_to_string(list_concat(list_transform(range(1, n_years + 1), lambda i: CAST(2026 - i AS STRING)),
list_transform(range(1, n_other + 1), lambda i: 'Topic ' || CAST(i AS STRING))), '|') AS options FROM ok""")
def year_selector(spark, sf):
    found = navigation.year_selectors(navigation.year_options(flatten_dom(build.year_pages(spark, sf))))
    return found.select("page_id", "option_count", "year_count", "has_all", F.array_join("options", "|").alias("options"))


@query("year_choice", YEAR_SQL + """ SELECT page_id, CASE WHEN has_all THEN 'All Years' END AS all_option, CASE WHEN has_all THEN '*' END AS all_value,
CASE WHEN n_years >= 3 THEN 'y3' END AS value_2023 FROM ok WHERE has_all OR n_years >= 3""")
def year_choice(spark, sf):
    options = navigation.year_options(src.write_stage(flatten_dom(build.year_pages(spark, sf)), "years"))
    selectors = navigation.year_selectors(options)
    of_all = navigation.select_option(options, selectors).toDF("page_id", "all_option", "all_value")
    of_year = navigation.select_option(options, selectors, 2023).select("page_id", F.col("option_value").alias("value_2023"))
    return of_all.join(of_year, "page_id", "full")


@query("nav_plan", YEAR_SQL + """ SELECT page_id, CASE WHEN ok.page_id IS NULL THEN 'plain' WHEN ok.has_all THEN 'all' ELSE 'years' END AS mode,
CASE WHEN NOT ok.has_all THEN array_to_string(list_transform(range(1, ok.n_years + 1), lambda i: CAST(2026 - i AS STRING)), '|') END AS years,
false AS client_side FROM y LEFT JOIN ok USING (page_id)""")
def nav_plan(spark, sf):
    pages = build.year_pages(spark, sf)
    nodes = discovery.listing_nodes(pages)
    selectors = navigation.year_selectors(navigation.year_options(nodes))
    plan = navigation.nav_plan(pages, selectors, discovery.discover_groups(pages, nodes))
    return plan.select("page_id", "mode", F.array_join("years", "|").alias("years"), "client_side")


# Options with elements inside, closed or not, one of them split in two, one around a comment, and text of the select itself.
NESTED_OPTIONS = """SELECT p_partkey AS page_id, p_partkey % 3 AS k, concat('<select>no year<option><span>2024</span></option>', CASE p_partkey % 3
WHEN 0 THEN '<option value="all"><b>All</b> <i>Years</i>' WHEN 1 THEN 'between' ELSE '<option>20<!-- x --><em>19</em></option>2018' END,
'<option><font>20<u>23</u></font><option> 2022 <small></small></select><p>2021</p>') AS html FROM part"""


@query("nested_options", f"""SELECT page_id, CASE k WHEN 0 THEN '2024|All Years|2023|2022' WHEN 1 THEN '2024|2023|2022' ELSE '2024|2019|2023|2022' END AS options,
k = 0 AS has_all FROM ({NESTED_OPTIONS})""")
def nested_options(spark, sf):
    nodes = discovery.listing_nodes(build.spread(build.rows(spark, sf, NESTED_OPTIONS)))
    found = navigation.year_selectors(navigation.year_options(nodes))
    return found.select("page_id", F.array_join("options", "|").alias("options"), "has_all")


# Listings with their news list open, hidden in part, and hidden for the most part, below a year selector or none.
LISTED = """SELECT p_partkey AS page_id, p_size % 6 AS n, p_partkey % 2 = 0 AS has_years, concat('https://l', p_partkey, '.example.com/') AS url, concat(
IF(p_partkey % 2 = 0, '<select><option>2024<option>2023</select>', ''), '<ul>', array_join(transform(sequence(0, 4), j -> concat('<li',
IF(j < p_size % 6, ' class="hidden"', ''), '><a href="/2024/p0/acme-wins-deal-', j, '">Deal ', j, '</a></li>')), ''), '</ul>') AS html FROM part"""


@query("nav_plan_lists", """SELECT p_partkey AS page_id, CASE WHEN p_partkey % 2 = 0 THEN 'years' ELSE 'plain' END AS mode, CASE WHEN p_partkey % 2 = 0 THEN '2024|2023' END AS years,
p_size % 6 > 3 AS client_side FROM part""")
def nav_plan_lists(spark, sf):
    pages = build.spread(build.rows(spark, sf, LISTED))
    nodes = discovery.listing_nodes(pages)
    plan = navigation.nav_plan(pages, navigation.year_selectors(navigation.year_options(nodes)), discovery.discover_groups(pages, nodes))
    return plan.select("page_id", "mode", F.array_join("years", "|").alias("years"), "client_side")


@query("crawl_links", f"""WITH c AS ({t.CRAWL}), kept AS (SELECT * FROM c WHERE NOT is_empty AND NOT (site_id % 4 = 1 AND (year = '2021' OR (year = '2022' AND page_no = 1)))),
l AS (SELECT *, unnest(range(0, 5)) AS j FROM kept)
SELECT site_id, year, CAST(page_no AS BIGINT) AS page_no, j AS url_no, rtrim(base_url, '/') || '/' || year || '/p' || CAST(page_no AS STRING) || '/acme-wins-deal-' || CAST(j AS STRING) AS url FROM l""")
def crawl_links(spark, sf):
    found = discovery.discover_crawl(build.crawl_pages(spark, sf), max_pages=1)
    return found.select("site_id", "year", *long("page_no", "url_no"), "url")


ODD = f"""WITH c AS ({t.ODD_CRAWL}), l AS (SELECT *, unnest(range(0, 5)) AS j FROM c), u AS (SELECT *,
rtrim(base_url, '/') || '/' || coalesce(year, 'none') || '/p' || CAST(page_no AS STRING) || '/acme-wins-deal-' || CAST(slot AS STRING) || '-' || CAST(j AS STRING) AS url FROM l)
SELECT site_id, year, CAST(page_no AS BIGINT) AS page_no, j AS url_no, url FROM u"""


def odd_crawl(spark, sf, **how):
    found = discovery.discover_crawl(build.odd_crawl_pages(spark, sf), **how)
    return found.select("site_id", "year", *long("page_no", "url_no"), "url")


@query("crawl_links_all", ODD)
def crawl_links_all(spark, sf):
    return odd_crawl(spark, sf)


@query("crawl_links_capped", f"{ODD} WHERE page_no <= 0")
def crawl_links_capped(spark, sf):
    return odd_crawl(spark, sf, max_pages=0)


@query("crawl_links_followed", f"""{ODD} u WHERE page_no = 0 OR slot IN (1, 2, 3) AND EXISTS (
SELECT 1 FROM c WHERE c.site_id = u.site_id AND c.slot = 0 AND c.has_control) AND (slot <> 3 OR EXISTS (
SELECT 1 FROM c WHERE c.site_id = u.site_id AND c.slot IN (1, 2)))""")
def crawl_links_followed(spark, sf):
    return odd_crawl(spark, sf, follow=True)


@query("crawl_links_distinct", f"SELECT site_id, url, min(page_no) AS page_no FROM ({ODD}) GROUP BY site_id, url")
def crawl_links_distinct(spark, sf):
    twice = build.odd_crawl_pages(spark, sf)
    return discovery.discover_crawl(twice.union(twice), dedup=True).select("site_id", "url", *long("page_no"))


BROKEN = ("'<p>' || p_name || '</p>'", "'<p>&#55357;&#56832; ' || p_name || '</p>'", "'<p>&#xD800;' || p_name || '</p>'",
          "'<p>&#' || repeat('9', 5000) || ';' || p_name || '</p>'", "NULL", "'<![CDATA[x' || p_name", "'<a href=\"&#xDFFF;\">' || p_name || '</a>'")
BROKEN_PAGES = "SELECT p_partkey AS page_id, p_name, CASE p_partkey % 7 " + " ".join(f"WHEN {i} THEN {h}" for i, h in enumerate(BROKEN)) + " END AS html FROM part"


@query("broken_pages", f"""WITH p AS (SELECT page_id, page_id % 7 AS k, p_name FROM ({BROKEN_PAGES}))
SELECT page_id, 'R' AS kind, 'page has no html' AS text FROM p WHERE k = 4 UNION ALL
SELECT page_id, 'T', CASE k WHEN 1 THEN chr(65533) || chr(65533) || ' ' WHEN 2 THEN chr(65533) WHEN 3 THEN chr(65533) ELSE '' END || p_name FROM p WHERE k IN (0, 1, 2, 3, 6)""")
def broken_pages(spark, sf):
    pages = build.spread(build.rows(spark, sf, BROKEN_PAGES))
    return flatten_dom(pages).where("kind in ('R', 'T') and page_id % 7 <> 5").select("page_id", "kind", "text")


@query("broken_pages_unfinished", f"""SELECT page_id, 'T' AS kind, html AS text FROM ({BROKEN_PAGES}) WHERE page_id % 7 = 5""")
def broken_pages_unfinished(spark, sf):
    """The shape ``broken_pages`` leaves out: CDATA without an end is no CDATA, and stays text as it stands."""
    pages = build.spread(build.rows(spark, sf, BROKEN_PAGES))
    return flatten_dom(pages).where("page_id % 7 = 5").select("page_id", "kind", "text")


# Pages as bytes: repaired UTF-8, marked and declared character sets, none declared, and a declaration that cannot be true.
BYTES = ("concat(encode(concat('<meta charset=utf-8><p>', p_name, ' caf'), 'UTF-8'), X'C328', encode('</p>', 'UTF-8'))",
         "concat(X'FFFE', encode(concat('<p>é漢 ', p_name, '</p>'), 'UTF-16LE'))",
         "concat(encode(concat('<meta charset=\"ISO-8859-1\"><p>', p_name), 'UTF-8'), X'20E92080', encode('</p>', 'UTF-8'))",
         "concat(encode(concat('<p>', p_name), 'UTF-8'), X'20E92093', encode('</p>', 'UTF-8'))",
         "encode(concat('<!-- <meta charset=latin1> --><meta charset=\"x-unknown\"><p>é ', p_name, '</p>'), 'UTF-8')",
         "encode(concat('<meta http-equiv=\"Content-Type\" content=\"text/html; charset=utf-16\"><p>é ', p_name, '</p>'), 'UTF-8')",
         "concat(encode('<?xml version=\"1.0\" encoding=\"koi8-r\"?><p>', 'UTF-8'), X'C1C2', encode(concat(p_name, '</p>'), 'UTF-8'))", "NULL")
BYTE_TEXT = ("p_name || ' caf' || chr(65533) || '('", "'é漢 ' || p_name", "p_name || ' é €'", "p_name || ' é “'", "'é ' || p_name", "'é ' || p_name", "'аб' || p_name")
# The same bytes in a text column are UTF-8, whatever the page says.
AS_TEXT = ("p_name || ' caf' || chr(65533) || '('", "NULL", "p_name || ' ' || chr(65533) || ' ' || chr(65533)", "p_name || ' ' || chr(65533) || ' ' || chr(65533)",
           "'é ' || p_name", "'é ' || p_name", "chr(65533) || chr(65533) || p_name")


def _of_kind(values) -> str:
    return "CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


@query("broken_bytes", f"""WITH t AS (SELECT p_partkey AS page_id, p_partkey % 8 AS k, 'bytes' AS read_as, {_of_kind(BYTE_TEXT)} AS text FROM part
UNION ALL SELECT p_partkey, p_partkey % 8, 'text', {_of_kind(AS_TEXT)} FROM part WHERE p_partkey % 8 <> 1)
SELECT page_id, read_as, CASE WHEN k = 7 THEN 'R' ELSE 'T' END AS kind, CASE WHEN k = 7 THEN 'page has no html' ELSE text END AS text FROM t""")
def broken_bytes(spark, sf):
    pages = build.spread(build.rows(spark, sf, f"SELECT p_partkey AS page_id, {_of_kind(BYTES)} AS html FROM part"))
    as_text = pages.where("page_id % 8 <> 1").select("page_id", F.col("html").cast("string").alias("html"))
    found = [flatten_dom(p).where("kind in ('R', 'T')").select("page_id", F.lit(name).alias("read_as"), "kind", "text")
             for name, p in (("bytes", pages), ("text", as_text))]
    return found[0].unionByName(found[1])


SPECIAL = ("'<?xml version=\"1.0\"?><!-- ' || p_name || ' --><p>' || p_name || '</p><template>a &lt;b&gt; ' || p_name || '</template>"
           "<ruby>x<rt>a &lt;b&gt; c</rt></ruby><![if !IE]><style>a > b {{}}</style>'").replace("{{}}", "{}")
SPECIAL_PAGES = f"SELECT p_partkey AS page_id, {SPECIAL} AS html FROM part"


@query("render_special", f"SELECT page_id, html FROM ({SPECIAL_PAGES})")
def render_special(spark, sf):
    return prune.render_html(flatten_dom(build.spread(build.rows(spark, sf, SPECIAL_PAGES)))).withColumnRenamed("clean_html", "html")


MARKED_PAGES = "SELECT p_partkey AS page_id, '<body><h1>' || p_name || '</h1><p>out</p><table><tr><th>h</th><td>' || p_name || '</td></tr></table></body>' AS html FROM part"


@query("clean_html_marked", """SELECT p_partkey AS page_id, '<body data-node="0"><h1 data-node="1" data-label="author title" data-author=\"A &amp; ' || CHR(39) || p_name || CHR(39) || '\" data-title="T">' ||
'<span data-seq="1" data-node="2">' || p_name || '</span></h1><table data-node="5" data-label="table"><tr data-node="6"><th data-node="7" data-label="header" data-header="h"><span data-seq="3" data-node="8">h</span></th>' ||
'<td data-node="9" data-label="cell"><span data-seq="4" data-node="10">' || p_name || '</span></td></tr></table></body>' AS clean_html FROM part""")
def clean_html_marked(spark, sf):
    pages = build.spread(build.rows(spark, sf, MARKED_PAGES))
    nodes = src.write_stage(flatten_dom(pages), "marked")
    name = F.col("text")
    kinds = {"h1": F.array(F.struct(F.lit("author").alias("label_type"), F.concat(F.lit("A & '"), name, F.lit("'")).alias("label_value")), F.struct(F.lit("title").alias("label_type"), F.lit("T").alias("label_value"))),
             "table": F.array(F.struct(F.lit("table").alias("label_type"), F.lit(None).cast("string").alias("label_value"))),
             "th": F.array(F.struct(F.lit("header").alias("label_type"), F.lit("h").alias("label_value"))),
             "td": F.array(F.struct(F.lit("cell").alias("label_type"), F.lit(None).cast("string").alias("label_value")))}
    found = None
    for tag, which in kinds.items():
        part = nodes.where((F.col("kind") == "E") & (F.col("tag") == tag)).select("page_id", "pos", F.inline(which))
        found = part if found is None else found.unionByName(part)
    return articles.clean_html(nodes, found, mark=True)


@query("prune_losses", """SELECT p_partkey AS page_id, CASE p_partkey % 3 WHEN 0 THEN 'kept' WHEN 1 THEN 'lost' ELSE 'new' END AS side,
p_partkey % 3 = 0 AS labels_kept FROM part""")
def prune_losses(spark, sf):
    """Labels removed from or added to a page after labelling must be noticed."""
    pages = build.spread(build.rows(spark, sf, MARKED_PAGES))
    nodes = src.write_stage(flatten_dom(pages), "losses")
    labels = nodes.where("tag in ('h1', 'th')").select("page_id", "pos", "tag", F.lit("title").alias("label_type"))
    before = prune.label_nodes(nodes, labels.where("page_id % 3 <> 2 or tag = 'h1'").drop("tag"))
    after = prune.label_nodes(nodes, labels.where("page_id % 3 <> 1 or tag = 'h1'").drop("tag"))
    sides = prune.lost_labels(before, after).select("page_id", "side")
    return (prune.verify_prune(before, after).join(sides, "page_id", "left")
            .select("page_id", F.coalesce("side", F.lit("kept")).alias("side"), "labels_kept"))


@query("prune_digests", """SELECT p_partkey AS page_id, p_partkey % 4 < 2 AS labels_kept FROM part""")
def prune_digests(spark, sf):
    """Pages whose labels all stand on nodes that stay, and pages with a label on no node or one outside the numbering."""
    nodes = src.write_stage(flatten_dom(build.spread(build.rows(spark, sf, MARKED_PAGES))), "digests")
    stray = F.expr("CASE page_id % 4 WHEN 2 THEN 99 WHEN 3 THEN -1 ELSE pos END").alias("pos")
    found = nodes.where("tag in ('h1', 'th') and page_id % 4 > 0").select("page_id", stray, F.col("tag").alias("label_type"))
    return articles.check_prune(nodes, found)


# --- Ends -------------------------------------------------------------------------------------------

FOUND = "SELECT page_id, 'https://ir.example.com/story/' || CAST(o_custkey * 2 AS STRING) AS url FROM (SELECT o_orderkey AS page_id, o_custkey FROM orders)"


@query("fetch_frontier", f"SELECT DISTINCT url FROM ({FOUND}) WHERE url NOT IN (SELECT url FROM ({t.ARTICLES}))")
def fetch_frontier(spark, sf):
    return discovery.fetch_frontier(build.rows(spark, sf, FOUND), build.rows(spark, sf, t.ARTICLES).select("url", "page_id"))


@query("fetched_articles", f"SELECT f.page_id, f.url, a.page_id AS article_id FROM ({FOUND}) f LEFT JOIN ({t.ARTICLES}) a ON f.url = a.url")
def fetched_articles(spark, sf):
    return discovery.fetched(build.rows(spark, sf, FOUND), build.rows(spark, sf, t.ARTICLES).select("url", "page_id"))


@query("seed_pages", "SELECT site_id, base_url, page_id FROM (SELECT page_id AS site_id, CASE WHEN page_id % 5 = 0 THEN url || '&x=1' ELSE url END AS base_url FROM pages) s LEFT JOIN (SELECT url, page_id FROM pages) p ON s.base_url = p.url")
def seed_pages(spark, sf):
    pages = build.given_pages(spark, sf)
    seeds = pages.select(F.col("page_id").alias("site_id"), F.expr("CASE WHEN page_id % 5 = 0 THEN concat(url, '&x=1') ELSE url END").alias("base_url"))
    return src.seed_pages(seeds, pages.select("page_id", "url")).select("site_id", "base_url", "page_id")


@query("extraction_errors", """SELECT page_id, url, 'dom' AS stage, 'page has no html' AS error FROM pages WHERE page_id % 10 = 3 UNION ALL
SELECT page_id, url, 'links', 'no usable link' FROM pages WHERE page_id % 10 IN (3, 4)""")
def extraction_errors(spark, sf):
    pages = build.given_pages(spark, sf).withColumn("html", F.expr(
        "CASE WHEN page_id % 10 = 3 THEN NULL WHEN page_id % 10 = 4 THEN '<a href=\"#top\">x</a>' ELSE html END"))
    nodes = src.write_stage(flatten_dom(pages).select("page_id", "kind", "tag", "text", "attrs"), "errors")
    return src.page_errors(nodes, pages).unionByName(discovery.link_errors(pages, nodes))


# Two increments of a crawl: every site's listing shows five of its eight stories, then five again; stories land in
# between, the first of them twice, and one page in neither list.
def _increment(first: int, stories: str) -> str:
    site = "concat('https://n', c_custkey, '.example.com/news/')"
    story = "concat('https://n', c_custkey, '.example.com/news/2024/acme-wins-deal-', j)"
    link = "concat('<li><a href=\"/2024/acme-wins-deal-', j, '\">Deal ', j, '</a></li>')"
    return f"""SELECT c_custkey * 100 + {first} AS page_id, {site} AS url,
concat('<ul>', array_join(transform(sequence({first}, {first} + 4), j -> {link}), ''), '</ul>') AS html FROM customer UNION ALL
SELECT c_custkey * 100 + 10 + j + {first} * 10 AS page_id, {story} AS url,
concat('<head><meta property=\"og:title\" content=\"Deal ', j, ' of ', c_name, '\"/></head><body><article><p>It was won.</p></article></body>') AS html
FROM (SELECT c_custkey, c_name, explode(array({stories})) AS j FROM customer)"""


def two_increments(spark, sf):
    """Both increments in a new state folder; the second one is broken off after its frontier, and repeated."""
    import uuid

    pages = [build.spread(build.rows(spark, sf, _increment(*p))) for p in ((0, "0, 1, 2, 9"), (3, "0, 3, 4, 5"))]
    state = f"{src.work_folder(spark)}/state-{uuid.uuid4().hex}"
    seeds = build.rows(spark, sf, "SELECT c_custkey AS site_id, concat('https://n', c_custkey, '.example.com/news/') AS base_url, 1 AS more FROM customer")
    seeds.write.parquet(f"{state}/seeds")
    seeds = src.read_seeds(spark, f"{state}/seeds")
    increments.run_increment(state, "day-1", seeds, pages[0], html=False)
    runs.write_run(build.rows(spark, sf, "SELECT 'https://half.example.com/' AS url, c_custkey AS site_id FROM customer"), f"{state}/frontier", "day-2", commit=False)
    increments.run_increment(state, "day-2", seeds, pages[1], html=False)
    increments.run_increment(state, "day-2", seeds, pages[1], html=False)
    return state


STORIES = "SELECT c_custkey, c_name, unnest(range(0, 8)) AS j FROM customer"


@query("pipeline_articles", f"""SELECT CASE WHEN j < 3 THEN 'day-1' ELSE 'day-2' END AS run, c_custkey * 100 + 10 + j + CASE WHEN j < 3 THEN 0 ELSE 30 END AS page_id,
'https://n' || CAST(c_custkey AS STRING) || '.example.com/news/2024/acme-wins-deal-' || CAST(j AS STRING) AS url, 'Deal ' || CAST(j AS STRING) || ' of ' || c_name AS title,
CAST(1 AS BIGINT) AS n_content FROM ({STORIES}) WHERE j < 6""")
def pipeline_articles(spark, sf):
    return runs.read_runs(spark, f"{two_increments(spark, sf)}/records").select("run", "page_id", "url", "title", "n_content")


@query("pipeline_open_links", f"""SELECT 'day-2' AS run, c_custkey AS site_id, 'https://n' || CAST(c_custkey AS STRING) || '.example.com/news/2024/acme-wins-deal-' || CAST(j AS STRING) AS url
FROM ({STORIES}) WHERE j >= 6""")
def pipeline_open_links(spark, sf):
    return increments.open_links(spark, two_increments(spark, sf)).select("run", "site_id", "url")


@query("committed_runs", """SELECT c_custkey AS page_id, CAST(j AS BIGINT) AS url_no, 'u' || CAST(c_custkey AS STRING) AS url, CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS run,
CASE WHEN c_custkey % 2 = 0 THEN 'before' ELSE 'after' END AS seen FROM (SELECT c_custkey, unnest(range(0, 2)) AS j FROM customer)""")
def committed_runs(spark, sf):
    """Two runs of links: the second fails half-way, is not seen, is repeated twice, and leaves the first alone."""
    import uuid

    links = build.rows(spark, sf, "SELECT c_custkey AS page_id, explode(sequence(0L, 1L)) AS url_no, concat('u', c_custkey) AS url FROM customer")
    path = f"{build.src.work_folder(spark)}/links-{uuid.uuid4().hex}"
    even, odd = links.where("page_id % 2 = 0"), links.where("page_id % 2 = 1")
    discovery.write_links(even, path, buckets=8, run="a")
    runs.write_run(odd.withColumn("bucket", F.lit(0).cast("long")).where("url_no = 0"), path, "b", partition_by=("bucket",), commit=False)
    before = src.write_stage(runs.read_runs(spark, path).select("page_id", "url_no", "run"), "before")
    for _ in range(2):
        discovery.write_links(odd, path, buckets=8, run="b")
    seen = before.withColumn("seen", F.lit("before"))
    return (runs.read_runs(spark, path).join(seen, ["page_id", "url_no", "run"], "left")
            .select("page_id", "url_no", "url", "run", F.coalesce("seen", F.lit("after")).alias("seen")))
