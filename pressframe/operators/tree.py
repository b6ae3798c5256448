"""Tree questions over ``dom_nodes`` as windows and equi-joins.

A node lies inside an element exactly when its ``pos`` falls in the element's
``(pos, end_pos]``.  Windows go by ``page_id``: a page is one HTML cell that one task has read
already, so a window partition is bounded by one input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from pressframe.functions.text import attr, strip


def earlier() -> WindowSpec:
    """All nodes of the page before the current one."""
    return Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)


def later() -> WindowSpec:
    """All nodes after it, read in reverse order: a frame that runs on to the end of the
    partition would be recomputed for every row."""
    return Window.partitionBy("page_id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)


# Tags that keep a page rendering and are never cleared.
STRUCTURAL_TAGS = ("html head body main article style script link meta nav header footer button form").split()

_CELL = 256


def inside(condition: Column) -> Column:
    """Has the node an ancestor that meets the condition?"""
    reach = F.max(F.when(condition, F.col("end_pos"))).over(earlier())
    return F.coalesce(reach >= F.col("pos"), F.lit(False))


def holds(condition: Column) -> Column:
    """Has the node a descendant that meets the condition?"""
    following = F.min(F.when(condition, F.col("pos"))).over(later())
    return F.coalesce(following <= F.col("end_pos"), F.lit(False))


def is_structural(tag: Column) -> Column:
    return tag.isin(STRUCTURAL_TAGS)


def first_per_page(nodes: DataFrame, condition: Column, *columns: str) -> DataFrame:
    """First node of each page, in document order, that meets the condition."""
    return (nodes.where(condition).groupBy("page_id")
            .agg(F.min(F.struct("pos", *columns)).alias("hit")).select("page_id", "hit.*"))


def hides_itself(attrs: str = "attrs") -> Column:
    """Inline ``display:none`` (blanks ignored) or a class with "hidden" in its name."""
    style = F.replace(attr("style", attrs), F.lit(" "), F.lit(""))
    return (F.coalesce(style.contains("display:none"), F.lit(False))
            | F.coalesce(F.lower(attr("class", attrs)).contains("hidden"), F.lit(False)))


def with_hidden(nodes: DataFrame, wanted: Column, levels: int = 3, hides: Column | None = None) -> DataFrame:
    """The wanted elements with a ``hidden`` flag: they or one of ``levels`` nearest ancestors hide.

    An element that hides at depth d counts for depths d to d + levels inside its interval.
    So it is repeated once per such depth, and one running maximum per (page, depth) answers
    the question.  Only wanted and hiding elements take part.  ``hides`` is for nodes that no longer carry their attributes.
    """
    hides = hides_itself() if hides is None else hides
    roles = F.concat(
        F.when(hides, F.array(*[F.struct((F.col("depth") + k).alias("level"), F.lit(0).alias("role")) for k in range(levels + 1)]))
        .otherwise(F.array()),
        F.when(wanted, F.array(F.struct(F.col("depth").alias("level"), F.lit(1).alias("role"))))
        .otherwise(F.array()))
    by_level = (Window.partitionBy("page_id", "level").orderBy("pos", "role")
                .rowsBetween(Window.unboundedPreceding, 0))
    reach = F.max(F.when(F.col("role") == 0, F.col("end_pos"))).over(by_level)
    return (nodes.where((F.col("kind") == "E") & (hides | wanted))
            .select("*", F.inline(roles))
            .withColumn("hidden", F.coalesce(reach >= F.col("pos"), F.lit(False)))
            .where("role = 1").drop("level", "role"))


def contained(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs (target, node inside it) for ``targets(page_id, t_pos, t_end)``.

    Intervals are cut into cells of fixed width, so this is an equi-join on (page, cell): a
    large page spreads over many keys, and nodes outside every target meet nothing.
    """
    cells = F.sequence((F.col("t_pos") / _CELL).cast("int"), (F.col("t_end") / _CELL).cast("int"))
    left = targets.withColumn("cell", F.explode(cells))
    right = nodes.withColumn("cell", (F.col("pos") / _CELL).cast("int"))
    return left.join(right, ["page_id", "cell"]).where("pos > t_pos and pos <= t_end").drop("cell")


def subtree_text(nodes: DataFrame, targets: DataFrame, raw: bool = False) -> DataFrame:
    """``(page_id, t_pos, subtree)``: the text below each target, pieces joined with nothing."""
    pieces = nodes.where("kind = 'T'").select("page_id", "pos", "text")
    piece = F.col("text") if raw else strip(F.col("text"))
    return (contained(pieces, targets).groupBy("page_id", "t_pos")
            .agg(F.array_sort(F.collect_list(F.struct("pos", piece.alias("piece")))).alias("pieces"))
            .select("page_id", "t_pos", F.array_join(F.col("pieces.piece"), "").alias("subtree")))


def text_nodes(nodes: DataFrame) -> DataFrame:
    """Non-blank page text with its enclosing element: text directly inside an element."""
    return (nodes.where("kind = 'T' and seq is not null")
            .select("page_id", "pos", "seq", "text", F.col("owner.tag").alias("parent_tag"),
                    F.col("owner.class").alias("parent_class"), F.col("owner.style").alias("parent_style")))
