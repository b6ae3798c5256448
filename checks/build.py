"""Spark side of the templates: parts to HTML pages."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import templates as t
from pressframe.sources import pages as src

TABLES = ["orders", "customer", "part", "documents"]


def configure(spark: SparkSession) -> SparkSession:
    """The package's settings; a session on this machine that names no stage folder gets one of its own."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pressframe-checks-"))
    return src.configure(spark)


def tables(spark: SparkSession, sf_dir: str) -> SparkSession:
    configure(spark)
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    return spark


def rows(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return tables(spark, sf_dir).sql(sql)


def given_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The test sets come in one or two splits.
    return src.read_pages(configure(spark), f"{sf_dir}/pages.parquet", spread=spark.sparkContext.defaultParallelism)


def spread(frame: DataFrame) -> DataFrame:
    """The templates come from a few small files; give every core its share of the pages."""
    return frame.repartition(frame.sparkSession.sparkContext.defaultParallelism, "page_id")


def _joined(frame: DataFrame, order: str, piece: str) -> DataFrame:
    return (frame.selectExpr("page_id", f"{order} AS o", f"{piece} AS piece").groupBy("page_id")
            .agg(F.array_sort(F.collect_list(F.struct("o", "piece"))).alias("p"))
            .select("page_id", F.concat(F.lit("<html><body>"), F.array_join(F.col("p.piece"), ""),
                                        F.lit("</body></html>")).alias("html")))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrap = """CASE WHEN anc_flex LIKE '%nav' THEN concat('<nav>', link, '</nav>')
                   WHEN anc_flex LIKE '%footer' THEN concat('<footer>', link, '</footer>')
                   WHEN anc_flex LIKE '%aside%' THEN concat('<aside><ul><li>', link, '</li></ul></aside>')
                   WHEN anc_flex LIKE '%section%' THEN concat('<section><ul><li>', link, '</li></ul></section>')
                   ELSE concat('<main id="news"><ul><li class="item', IF(pos % 2 = 0, ' even', ''), '"',
                        IF(hides, ' style="display: none"', ''), '>', link, '</li></ul></main>') END"""
    links = rows(spark, sf_dir, t.ANCHORS).withColumn(
        "link", F.expr("concat('<a href=\"', href, '\">', text, '</a>')"))
    return _joined(links, "pos", wrap).withColumn(
        "url", F.expr("concat('https://ir', page_id, '.example.com/list/')"))


def text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    piece = """concat('<', parent_tag, IF(parent_class = '', '', concat(' class="', parent_class, '"')),
               IF(parent_style = '', '', concat(' style="', parent_style, '"')), '>', text, '</', parent_tag, '>')"""
    return _joined(rows(spark, sf_dir, t.TEXT_NODES), "pos", piece)


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(rows(spark, sf_dir, t.ARTICLES).selectExpr("page_id", "url", f"{article_html()} AS html"))


def article_html(kept: bool = False, prio: str = "0") -> str:
    """SQL text of a whole article page; with ``kept`` only of the parts that survive pruning."""
    def piece(html: str, survives: str = "true") -> str:
        return f"coalesce(CASE WHEN {survives} THEN {html} END, '')" if kept else f"coalesce({html}, '')"

    def meta(kind: str, name: str, value: str, when: str) -> str:
        return f"CASE WHEN {when} THEN '<meta {kind}=\"{name}\" content=\"' || {value} || '\"/>' END"

    json_object = ("'{\"headline\": \"' || coalesce(ld_title, 'In a list') || '\", \"datePublished\": \"' "
                   "|| coalesce(ld_date, '2001-01-01') || '\"}'")
    head = [
        meta("property", "og:title", "og", "og IS NOT NULL"),
        meta("property", "article:published_time", "meta_date", "meta_date IS NOT NULL"),
        meta("property", "og:published_time", "og_date", "og_date IS NOT NULL"),
        meta("name", "author", "'Ann ' || CAST(k AS STRING)", "author_method = 1"),
        meta("property", "article:author", "'Bob ' || CAST(k AS STRING)", "author_method = 2"),
        meta("name", "keywords", "keywords_text", "keywords_text IS NOT NULL"),
        meta("property", "article:section", "category", "category IS NOT NULL"),
        f"CASE WHEN k % 3 = 0 THEN '<script type=\"application/ld+json\">' || CASE WHEN k % 9 = 0 THEN '[' || {json_object} || ']' ELSE {json_object} END || '</script>' END",
    ]
    body = [
        piece("'<nav><a href=\"/x\">Home</a></nav>'"), piece("'<div class=\"promo\">Buy now</div>'", "false"),
        piece("'<h1>' || loose_h1 || '</h1>'", f"{prio} = 4"),
        piece("CASE WHEN author_method IN (1, 3) THEN '<a rel=\"nofollow author\">Cy ' || CAST(k AS STRING) || '</a>' END", "author_method = 3"),
        piece("CASE WHEN author_method = 4 THEN '<span class=\"post Byline\"><i>By</i> Di ' || CAST(k AS STRING) || '</span>' END", "author_method = 4"),
        piece("CASE WHEN k % 10 = 4 THEN '<div class=\"Article-Content\">short</div>' END", "false"),
        "CASE WHEN k % 5 <> 4 THEN '<article>' WHEN k % 10 = 4 THEN '<div class=\"post main-content\">' ELSE '<section>' END",
        piece("CASE WHEN story IS NOT NULL THEN '<h1>' || story || '</h1>' END", f"{prio} = 3"),
        piece("CASE WHEN k % 10 = 4 THEN '<p>' || repeat('z ', 150) || '</p>' END"),
        piece("dates_html"), piece("opening_html"), piece("boiler_html", "false"), piece("list_html"),
        piece("loose_html", "false"), piece("table_html", "k % 6 = 1"), piece("header_html", "NOT is_cut"),
        piece("after_html", "NOT is_cut"),
        "CASE WHEN k % 5 <> 4 THEN '</article>' WHEN k % 10 = 4 THEN '</div>' ELSE '</section>' END",
        piece("'<aside><section>' || repeat('y', 3000) || '</section></aside>'", "false"),
        piece("'<form><p>Sign up</p></form><footer>Foot</footer>'"),
    ]
    parts = ["'<html><head>'", *[f"coalesce({h}, '')" for h in head], "'</head><body>'", *body, "'</body></html>'"]
    return " || ".join(f"({p})" for p in parts)


def tree_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = """concat('<html><body>', outer_html, repeat('<span>', CAST(n AS INT)), '<a href="/x">go <b>now</b></a>',
              repeat('</span>', CAST(n AS INT)), '</div>tail ', p_name, '</body></html>')"""
    return spread(rows(spark, sf_dir, t.TREES).selectExpr("page_id", f"{html} AS html", "p_name", "n"))


def control_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(rows(spark, sf_dir, t.CONTROLS).selectExpr(
        "page_id", "url", "concat('<html><body><p>x</p>', more_html, '<hr/>', next_html, '</body></html>') AS html"))


def year_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decoy select, then years; end tags of options are left out, as pages often do."""
    years = "array_join(transform(sequence(1, CAST(n_years AS INT) + 1), i -> concat('<option value=\"y', i, '\"> ', 2026 - i)), '')"
    other = "array_join(transform(sequence(1, CAST(n_other AS INT) + 1), i -> concat('<option>Topic ', i)), '')"
    html = f"""concat('<html><body>', IF(decoy, '<select><option>2020</option></select>', ''), '<select name="f">',
               IF(has_all, '<option value="*">All Years', ''), IF(n_years > 0, array_join(slice(split({years}, '(?=<option)'), 1, CAST(n_years AS INT)), ''), ''),
               IF(n_other > 0, array_join(slice(split({other}, '(?=<option)'), 1, CAST(n_other AS INT)), ''), ''), '</select></body></html>')"""
    return spread(rows(spark, sf_dir, t.YEARS).selectExpr("page_id", f"{html} AS html"))


def odd_crawl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years that are no numbers or null, a page landed twice, a hole in the numbering, and load-more controls."""
    start = "'<li><a href=\"/', coalesce(year, 'none'), '/p', page_no, '/acme-wins-deal-', slot"
    items = ", ".join(f"{start}, '-{j}\">Deal {j}</a></li>'" for j in range(5))
    html = f"concat('<ul>', {items}, '</ul>', IF(has_control, '<button>Load More</button>', ''))"
    frame = rows(spark, sf_dir, t.ODD_CRAWL).selectExpr("site_id", "base_url", "page_no", "year", f"{html} AS html")
    # By columns: dealt out in turns, rows would be sorted first.
    return frame.repartition(frame.sparkSession.sparkContext.defaultParallelism, "site_id", "year", "page_no")


def crawl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = ("concat('<li', IF(client_side AND j > 0, ' class=\"hidden\"', ''), '><a href=\"/', year, '/p', page_no, "
            "'/acme-wins-deal-', j, '\">Deal ', j, '</a></li>')")
    html = f"IF(is_empty, '<p>none</p>', concat('<ul>', array_join(transform(sequence(0, 4), j -> {link}), ''), '</ul>'))"
    frame = rows(spark, sf_dir, t.CRAWL).selectExpr("site_id", "base_url", "page_no", "year", f"{html} AS html")
    return frame.repartition(frame.sparkSession.sparkContext.defaultParallelism)
