"""Publication dates found in page text, for pages whose head names none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressframe.functions.dates import PUBLICATION_WORDS, has_text_date, text_dates
from pressframe.functions.text import attr
from pressframe.operators.tree import inside

POINTS = 5


def _holds_word(low: Column) -> Column:
    return reduce(Column.__or__, [F.contains(low, F.lit(word)) for word in PUBLICATION_WORDS])


def _says_published(text: Column) -> Column:
    return _holds_word(F.lower(text))


def dated_texts(nodes: DataFrame) -> DataFrame:
    """Text nodes that show a date, with ``news_class``: some enclosing element has "new" and
    "date" in its classes.  Only those texts and those elements enter the window."""
    classes = F.lower(attr("class"))
    marks = F.coalesce((F.col("kind") == "E") & classes.contains("new") & classes.contains("date"), F.lit(False))
    shows = (F.col("kind") == "T") & has_text_date(F.col("text"))
    return (nodes.where(marks | shows)
            .select("page_id", "pos", "end_pos", "parent", "text", "owner", marks.alias("marks"), shows.alias("shows"))
            .withColumn("news_class", inside(F.col("marks")))
            .where("shows").drop("marks", "shows"))


def _word_parts(texts: DataFrame) -> DataFrame:
    """``page_id, pos, own, head, tail`` of pieces of text: whether a publication word is inside, and as much of both ends as one may share with others."""
    longest = max(map(len, PUBLICATION_WORDS))
    low = texts.select("page_id", "pos", F.lower("text").alias("low"))
    return low.select("page_id", "pos", _holds_word(F.col("low")).alias("own"), F.substring("low", 1, longest - 1).alias("head"),
                      F.substring("low", 1 - longest, longest - 1).alias("tail"))


def _ends_of_words(pieces: DataFrame) -> DataFrame:
    """``page_id, pos, ends``: for each piece of page text, where the first publication word that starts in it or after it at once ends.

    A word may run over several pieces, at most one for each of its characters; so a piece is read together with the
    beginnings of as many pieces after it (see :func:`_word_parts`).
    """
    longest = max(map(len, PUBLICATION_WORDS))
    in_order = Window.partitionBy("page_id").orderBy("pos")
    rows = pieces.withColumns({f"{name}_{k}": F.lead(name, k).over(in_order) for k in range(1, longest) for name in ("head", "pos")})
    so_far, steps = F.col("tail"), []
    for k in range(1, longest):
        so_far = F.concat(so_far, F.coalesce(f"head_{k}", F.lit("")))
        steps.append(F.when(_holds_word(so_far), F.col(f"pos_{k}")))
    ends = F.when(F.col("own"), F.col("pos")).when(_holds_word(so_far), F.coalesce(*steps))
    return rows.select("page_id", "pos", ends.alias("ends"))


def near_publication_words(nodes: DataFrame, asking: DataFrame) -> DataFrame:
    """``(page_id, pos)`` of the dated texts in ``asking(page_id, pos, parent, parent_end)`` whose parent holds a publication word.

    Of the texts only their ends are exchanged, and only pages in ``asking`` go further.  Each question stands before its parent's pieces; read from the page's end, the running
    minimum of the words' ends says whether one that starts inside the parent also ends there.  That is one
    row for each piece and each question, however the parents nest.
    """
    pieces = _word_parts(nodes.where("kind = 'T'"))
    pieces = _ends_of_words(pieces.join(asking.select("page_id").distinct(), "page_id", "left_semi"))
    rows = pieces.join(asking, ["page_id", "pos"], "left")
    piece = F.struct(F.col("pos").alias("at"), F.col("ends").alias("ends"), F.lit(None).cast("int").alias("asks"))
    question = F.struct(F.col("parent").alias("at"), F.lit(None).cast("int").alias("ends"), F.col("pos").alias("asks"))
    events = rows.select("page_id", "parent_end", F.inline(F.when(F.col("parent").isNotNull(), F.array(piece, question)).otherwise(F.array(piece))))
    from_the_end = Window.partitionBy("page_id").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    events = events.withColumn("first_end", F.min("ends").over(from_the_end))
    return events.where("asks is not null and first_end <= parent_end").select("page_id", F.col("asks").alias("pos"))


def text_date_candidates(nodes: DataFrame, as_of: Column | None = None, settled: DataFrame | None = None,
                         dated: DataFrame | None = None) -> DataFrame:
    """``(page_id, pattern_no, pos, day, score)`` for every text node and pattern.

    Pages in ``settled(page_id)`` are left out as soon as their few dated texts are known.  ``dated`` is the result of
    :func:`dated_texts`, which is read three times, where it has been written already.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    found = dated_texts(nodes) if dated is None else dated
    if settled is not None:
        found = found.join(settled.select("page_id"), "page_id", "left_anti")
    found = found.withColumn("own_word", _says_published(F.col("text")))
    # The parent's text is looked at only where the node's own text does not settle it.
    asking = found.where("not own_word").select("page_id", "pos", "parent", F.col("owner.end_pos").alias("parent_end"))
    near = near_publication_words(nodes, asking).withColumn("near_word", F.lit(True))
    scored = (found.join(near, ["page_id", "pos"], "left")
              .withColumn("score", F.when(F.col("news_class"), POINTS).otherwise(0)
                          + F.when(F.col("own_word") | F.coalesce("near_word", F.lit(False)), POINTS).otherwise(0)))
    days = F.array(*text_dates(F.col("text"), as_of))
    return (scored.select("page_id", "pos", "score", F.posexplode(days).alias("pattern_no", "day"))
            .where(F.col("day").isNotNull() & (F.col("day").cast("timestamp") <= as_of))
            .select("page_id", (F.col("pattern_no") + 1).alias("pattern_no"), "pos", "day", "score"))


def best_text_dates(found: DataFrame) -> DataFrame:
    """Highest score; the lower pattern number, then the earlier node, wins a tie."""
    return (found.groupBy("page_id")
            .agg(F.min(F.struct((-F.col("score")).alias("rank"), "pattern_no", "pos", "day")).alias("best"))
            .select("page_id", "best.pos",
                    F.concat(F.date_format("best.day", "yyyy-MM-dd"), F.lit(" 00:00:00")).alias("published_text"),
                    F.col("best.day").cast("timestamp").alias("published_ts"), F.lit("text").alias("method")))


def article_dates(nodes: DataFrame, head: DataFrame, as_of: Column | None = None, dated: DataFrame | None = None) -> DataFrame:
    """Date per page: head dates first, page text only for the pages they leave open."""
    return head.unionByName(best_text_dates(text_date_candidates(nodes, as_of, settled=head, dated=dated)))
