"""Content root, body text and tables of an article page.

One exchange by page, one sort by position; every rule below is a window over that order.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from pressframe.functions import boilerplate as bp
from pressframe.functions.text import attr, strip
from pressframe.operators.tree import holds, inside

# Ship the code of this module inside the task, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Class patterns of a content block, in order of preference; block tags that may
# hold the content; tags under which no block counts; tags whose text is read.
CONTENT_CLASSES = ["(article|post|entry).*content", "main-content", "story-content", "news-content"]
BLOCK_TAGS = ["div", "section"]
UNWANTED_TAGS = ["nav", "footer", "aside", "script", "style", "noscript"]
TARGET_TAGS = ["p", "h2", "h3", "h4", "ul", "ol", "blockquote"]
CELL_TAGS = ["th", "td"]
MIN_CONTENT = 200


def _page() -> WindowSpec:
    return Window.partitionBy("page_id")


def class_rank(css_class: Column) -> Column:
    """Number of the first content class pattern that fits, null if none does."""
    return F.coalesce(*[F.when(css_class.rlike(f"(?diu){p}"), F.lit(i)) for i, p in enumerate(CONTENT_CLASSES)])


def content_roots(nodes: DataFrame) -> DataFrame:
    """``(page_id, root_pos, root_end, root_method)``: article, classed div, or largest block."""
    rows = _root_rows(nodes.where((F.col("kind") == "E") & F.col("tag").isin("article", *BLOCK_TAGS, *UNWANTED_TAGS)))
    best = rows.groupBy("page_id").agg(*[F.min(c).alias(name) for name, c in _root_options().items()])
    return (best.select("page_id", _choose_root().alias("root")).where("root is not null")
            .select("page_id", F.col("root.pos").alias("root_pos"), F.col("root.end_pos").alias("root_end"),
                    F.col("root.method").alias("root_method")))


def _root_rows(nodes: DataFrame) -> DataFrame:
    rank = F.when(F.col("tag") == "div", class_rank(attr("class")))
    return (nodes.withColumn("class_rank", rank)
            .withColumn("unwanted", inside((F.col("kind") == "E") & F.col("tag").isin(UNWANTED_TAGS))))


def _root_options() -> dict[str, Column]:
    """What each element offers to the three root methods; the least offer per page wins."""
    element, tag = F.col("kind") == "E", F.col("tag")
    span = [F.col("pos"), F.col("end_pos")]
    return {
        "by_article": F.when(element & (tag == "article"), F.struct(*span)),
        "by_class": F.when(F.col("class_rank").isNotNull() & (F.col("text_len") > MIN_CONTENT),
                           F.struct("class_rank", *span)),
        "by_size": F.when(element & tag.isin(BLOCK_TAGS) & ~F.col("unwanted"),
                          F.struct((-F.col("text_len")).alias("rank"), *span)),
    }


def _choose_root() -> Column:
    return F.coalesce(*[
        F.when(F.col(name).isNotNull(), F.struct(F.col(f"{name}.pos"), F.col(f"{name}.end_pos"), F.lit(i).alias("method")))
        for i, name in enumerate(_root_options(), 1)])


def content_rows(nodes: DataFrame) -> DataFrame:
    """Text, tables and cells inside the content root, each with its role.

    Columns ``role`` (content, boilerplate, header, table, table_header, table_cell),
    ``skipped`` (at or after the first section header) and ``breaks`` (see ``failing_pages``).
    Every line is judged before the exchange, so three flags travel instead of the text.
    """
    element, text = F.col("kind") == "E", (F.col("kind") == "T") & F.col("seq").isNotNull()
    wanted_tags = sorted({"article", "table", *BLOCK_TAGS, *UNWANTED_TAGS, *TARGET_TAGS, *CELL_TAGS})
    place = (F.col("owner.tag"), F.col("owner.class"), F.col("owner.style"))
    # What several flags look at is worked out in steps, once for each line.
    lines = nodes.where(text | (element & F.col("tag").isin(wanted_tags))).withColumn("low", F.when(text, F.lower("text")))
    lines = lines.withColumns({"basic": F.when(text, bp.is_basic(F.col("text"), F.col("low"))),
                               "may_be": F.when(text, bp.may_be_header(F.col("text"), F.col("low")))})
    judged = [F.col("text"), *place, F.col("may_be"), F.col("basic")]
    narrow = lines.select("page_id", "pos", "end_pos", "kind", "tag", "text_len", "attrs", "basic",
                          *[F.when(text, flag(*judged)).alias(name) for name, flag in [("header", bp.is_header), ("breaking", bp.bold_test_breaks)]])
    is_table = element & (F.col("tag") == "table")
    rows = (_root_rows(narrow)
            .withColumn("in_table", inside(is_table))
            .withColumns({name: F.min(c).over(_page()) for name, c in _root_options().items()})
            .withColumn("root", _choose_root())
            .withColumn("in_root", F.coalesce((F.col("pos") > F.col("root.pos"))
                                              & (F.col("pos") <= F.col("root.end_pos")), F.lit(False))))
    target = element & F.col("tag").isin(TARGET_TAGS) & F.col("in_root") & ~F.col("in_table")
    read = ~element & ~F.col("in_table")
    rows = rows.withColumn("is_read", read & inside(target))
    rows = (rows.withColumns({"is_basic": F.col("is_read") & F.col("basic"), "is_header": F.col("is_read") & F.col("header"),
                              "breaks": F.col("is_read") & F.col("breaking")})
            .withColumn("stop", F.min(F.when(F.col("is_header"), F.col("pos"))).over(_page()))
            .withColumn("skipped", F.coalesce(F.col("pos") >= F.col("stop"), F.lit(False))))
    live_table = is_table & F.col("in_root") & ~F.col("skipped")
    full_cell = element & F.col("tag").isin(CELL_TAGS) & (F.col("text_len") > 0)
    rows = (rows.withColumn("in_live_table", inside(live_table))
            .withColumn("full_cell", full_cell & F.col("in_live_table"))
            .withColumn("has_cells", holds(F.col("full_cell"))))
    role = (F.when(F.col("is_header"), "header").when(F.col("is_basic"), "boilerplate")
            .when(F.col("is_read"), "content").when(live_table & F.col("has_cells"), "table")
            .when(F.col("full_cell"), F.when(F.col("tag") == "th", "table_header").otherwise("table_cell")))
    return (rows.withColumn("role", role).where("role is not null")
            .select("page_id", "pos", "end_pos", "role", "skipped", F.coalesce("breaks", F.lit(False)).alias("breaks")))


def content_labels(rows: DataFrame) -> DataFrame:
    """Labels in the common long form."""
    return (rows.where("not skipped and role not in ('header', 'boilerplate')")
            .select("page_id", "pos", F.col("role").alias("label_type"), F.lit(None).cast("string").alias("label_value")))


def failing_pages(rows: DataFrame) -> DataFrame:
    """Pages on which the test for bold classes finds no single class to look at before the section cut."""
    return rows.groupBy("page_id").agg(
        F.bool_or(F.col("breaks") & (~F.col("skipped") | (F.col("role") == "header"))).alias("ref_would_fail"))


def table_cells(nodes: DataFrame) -> DataFrame:
    """Tables as rows: ``(page_id, table_pos, row_no, col_no, is_header, text)``, cells numbered as they stand in their row."""
    return _numbered_cells(nodes).drop("cell_pos")


def table_grid(nodes: DataFrame) -> DataFrame:
    """``(page_id, table_pos, grid_row, grid_col, row_span, col_span, is_header, text)``: cells where they stand in the grid.

    A cell covers ``col_span`` columns of ``row_span`` rows and pushes later cells of those rows to the next free column.  That
    depends on all rows above, so it is one fold over the cells in order, with the columns still covered as its state; a table is
    part of one page, and no task holds more than a batch and that state.
    """
    spans = nodes.where((F.col("kind") == "E") & F.col("tag").isin(CELL_TAGS)).select(
        "page_id", F.col("pos").alias("cell_pos"), *[_span(name, most).alias(column) for name, column, most in (("rowspan", "row_span", 65534), ("colspan", "col_span", 1000))])
    cells = _numbered_cells(nodes).join(spans, ["page_id", "cell_pos"])
    order = ["page_id", "table_pos", "row_no", "col_no"]
    cells = cells.repartition("page_id").sortWithinPartitions(*order).select(*order, "row_span", "col_span", "is_header", "text")
    key = nodes.schema["page_id"].dataType.simpleString()
    return cells.mapInArrow(_placed, f"page_id {key}, table_pos int, grid_row int, grid_col int, row_span int, col_span int, is_header boolean, text string")


def _span(name: str, most: int) -> Column:
    """A span as browsers read it: leading digits, one if there are none or zero columns; zero rows mean all that follow."""
    digits = F.nullif(F.regexp_extract(F.coalesce(attr(name), F.lit("")), r"^\s*\+?([0-9]{1,9})", 1), F.lit("")).cast("int")
    least = 1 if name == "colspan" else 0
    return F.least(F.greatest(F.coalesce(digits, F.lit(1)), F.lit(least)), F.lit(most))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fold: ``covered`` has stretches of columns, ``(first, after, last row)``, that cells of earlier rows cover, ``fresh`` those of this row."""
    table, row, column, seen, covered, fresh = None, None, 0, 0, [], []
    for batch in batches:
        columns = []
        tables = zip(batch.column(0).cast(pa.binary()).to_pylist() if pa.types.is_string(batch.column(0).type) else batch.column(0).to_pylist(),
                     batch.column(1).to_pylist())
        for at, row_no, rows, width in zip(tables, *(batch.column(i).to_pylist() for i in (2, 4, 5))):
            if at != table:
                table, row, covered, fresh = at, None, [], []
            if row_no != row:
                covered = sorted(s for s in covered + fresh if s[2] >= row_no)
                row, column, seen, fresh = row_no, 1, 0, []
            while seen < len(covered) and covered[seen][0] <= column:
                column, seen = max(column, covered[seen][1]), seen + 1
            columns.append(column)
            last = row_no + rows - 1 if rows else 1 << 30
            if fresh and fresh[-1][1:] == (column, last):  # neighbours that end together are one stretch
                fresh[-1] = (fresh[-1][0], column + width, last)
            elif last > row_no:
                fresh.append((column, column + width, last))
            column += width
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(columns, pa.int32()), *batch.columns[4:]],
                                         names=["page_id", "table_pos", "grid_row", "grid_col", "row_span", "col_span", "is_header", "text"])


def _numbered_cells(nodes: DataFrame) -> DataFrame:
    """Each string belongs to its innermost open cell.  Numbering the cells that are open at a
    position gives a level; on one level the last cell opened is the innermost.
    """
    pieces = (F.col("kind") == "T") & F.col("seq").isNotNull()
    element = F.col("kind") == "E"
    rows = nodes.where(pieces | (element & F.col("tag").isin("table", "tr", *CELL_TAGS))).select(
        "page_id", "pos", "end_pos", "kind", "tag", F.when(pieces, F.col("text")).alias("text"))
    is_table = F.coalesce(F.col("tag") == "table", F.lit(False))
    rows = rows.withColumn("in_table", inside(is_table)).where(is_table | F.col("in_table")).drop("in_table")
    cell = F.col("tag").isin(CELL_TAGS) & (F.col("kind") == "E")
    opened = rows.select("*", F.inline(F.concat(
        F.array(F.struct(F.col("pos").alias("at"), F.lit(0).alias("closes"))),
        F.when(F.col("kind") == "E", F.array(F.struct(F.col("end_pos").alias("at"), F.lit(1).alias("closes"))))
        .otherwise(F.array()))))
    walk = Window.partitionBy("page_id").orderBy("at", "closes", F.desc("pos"))
    running = walk.rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("closes") == 1, -1).otherwise(1)

    def level(condition: Column) -> Column:
        return F.sum(F.when(condition, step).otherwise(0)).over(running)

    def innermost(tag_rows: Column, name: str) -> Column:
        within = (Window.partitionBy("page_id", f"{name}_level").orderBy("at")
                  .rowsBetween(Window.unboundedPreceding, 0))
        return F.when(F.col(f"{name}_level") > 0,
                      F.last(F.when(tag_rows & (F.col("closes") == 0), F.col("pos")), ignorenulls=True).over(within))

    levels = {"table": is_table, "tr": F.col("tag") == "tr", "cell": cell}
    open_rows = opened.withColumns({f"{k}_level": level(F.coalesce(v, F.lit(False))) for k, v in levels.items()})
    open_rows = open_rows.where("closes = 0")
    for name, condition in levels.items():
        open_rows = open_rows.withColumn(f"{name}_pos", innermost(F.coalesce(condition, F.lit(False)), name))
    # A cell belongs to the innermost row of its own table, not to a row around that table.
    own = F.col("cell_pos").isNotNull() & (F.col("tr_pos") > F.col("table_pos"))
    cells = (open_rows.where(own).groupBy("page_id", "table_pos", "tr_pos", "cell_pos")
             .agg(F.bool_or(F.col("tag") == "th").alias("is_header"), F.bool_or(cell).alias("opens"),
                  F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("pos", "text")))).alias("pieces"))
             .where("opens"))
    by_table = Window.partitionBy("page_id", "table_pos").orderBy("tr_pos")
    by_row = Window.partitionBy("page_id", "table_pos", "tr_pos").orderBy("cell_pos")
    joined = F.array_join(F.transform("pieces", lambda p: strip(p["text"])), "")
    return cells.select("page_id", "table_pos", "cell_pos", F.dense_rank().over(by_table).alias("row_no"),
                        F.row_number().over(by_row).alias("col_no"), "is_header", joined.alias("text"))
