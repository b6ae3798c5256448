"""Article pages to labels, records and clean HTML (second stage).

``dom_nodes`` is built once (see ``write_stage`` or ``write_dom_table``); title, date, content
and metadata are branches over it, each reading its own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressframe.operators import content, dates, head, prune
from pressframe.sources.pages import write_stage
from pressframe.sources.runs import write_run


def article_parts(nodes: DataFrame, as_of: Column | None = None) -> dict[str, DataFrame]:
    """The four branches of an article page.

    Facts, dated texts, dates and content roles are read by several consumers (labels, counts, record), so
    each is written once: about one short row per page or per labelled node.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    facts = write_stage(head.head_facts(nodes), "facts")
    dated = write_stage(dates.dated_texts(nodes), "dated")
    date = write_stage(dates.article_dates(nodes, head.head_dates(facts, as_of), as_of, dated), "dates")
    rows = write_stage(content.content_rows(nodes), "content")
    return {"title": head.titles(head.title_candidates(facts)), "date": date,
            "metadata": head.metadata(facts), "rows": rows}


def labels(parts: dict[str, DataFrame]) -> DataFrame:
    """All labels in long form: ``(page_id, pos, label_type, label_value)``."""
    def rows(frame: DataFrame, kind: str, pos: str, value: str) -> DataFrame:
        return frame.where(F.col(pos).isNotNull()).select(
            "page_id", F.col(pos).alias("pos"), F.lit(kind).alias("label_type"), F.col(value).alias("label_value"))

    meta = parts["metadata"]
    named = [rows(parts["title"], "title", "pos", "title"), rows(parts["date"], "date", "pos", "published_text"),
             rows(meta, "author", "author_pos", "author"), rows(meta, "keywords", "keywords_pos", "keywords_json"),
             rows(meta, "category", "category_pos", "category"), content.content_labels(parts["rows"])]
    out = named[0]
    for frame in named[1:]:
        out = out.unionByName(frame)
    return out


def article_records(pages: DataFrame, nodes: DataFrame, parts: dict[str, DataFrame] | None = None,
                    html: bool = True, as_of: Column | None = None) -> DataFrame:
    """One record per page; a page that could not be read has its ``error`` and nothing else."""
    parts = parts or article_parts(nodes, as_of)
    counts = content.content_labels(parts["rows"]).groupBy("page_id").agg(
        F.count_if(F.col("label_type") == "content").alias("n_content"),
        F.count_if(F.col("label_type") == "table").alias("n_tables"))
    failed = nodes.where("kind = 'R'").select("page_id", F.col("text").alias("error"))
    record = (pages.select("page_id", "url")
              .join(parts["title"].select("page_id", "title"), "page_id", "left")
              .join(parts["date"].select("page_id", "published_ts", "published_text"), "page_id", "left")
              .join(parts["metadata"].select("page_id", "author", "keywords", "category"), "page_id", "left")
              .join(counts, "page_id", "left").join(failed, "page_id", "left")
              .join(content.failing_pages(parts["rows"]), "page_id", "left"))
    columns = ["page_id", "url", "title", "published_ts", "published_text", "author", "keywords", "category",
               F.coalesce("n_content", F.lit(0)).alias("n_content"), F.coalesce("n_tables", F.lit(0)).alias("n_tables"),
               F.coalesce("ref_would_fail", F.lit(False)).alias("ref_would_fail"), "error"]
    if html:
        record = record.join(clean_html(nodes, labels(parts)), "page_id", "left")
        columns.append("clean_html")
    return record.select(*columns)


def kept_nodes(nodes: DataFrame, found: DataFrame) -> DataFrame:
    return prune.prune(prune.label_nodes(nodes, found))


def clean_html(nodes: DataFrame, found: DataFrame, mark: bool = False) -> DataFrame:
    """``(page_id, clean_html)`` after pruning; ``mark`` keeps the labels in the markup."""
    return prune.render_html(nodes, prune.cuts(prune.labelled_outline(nodes, found, mark), mark), mark)


def check_prune(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """``(page_id, labels_kept)`` by the digests that the pruning pass carries; a label on no node at all is a lost one."""
    return prune.cuts(prune.labelled_outline(nodes, found)).select("page_id", "labels_kept")


def write_clean_html(clean: DataFrame, path: str, run: str | None = None) -> None:
    """One parquet row per page; tasks write their own files.  With ``run`` a committed run of the table (see ``read_runs``); without,
    what ``path`` held before is replaced.  Either way a run that failed can be repeated."""
    rows = clean.select("page_id", "clean_html")
    if run is None:
        rows.write.mode("overwrite").parquet(path)
    else:
        write_run(rows, path, run)
