"""Publication words around dates: all nestings against the text below the parent, and rows in proportion."""

import random

from pyspark.sql import functions as F

from pressframe.operators import dates, tree
from pressframe.sources.dom import flatten_dom


def random_page(rng):
    parts = ["<p>", "</p>", "<b>", "</b>", "<div>", "</div>", "2020-01-02", "pub", "lished", "press", "re", "lease", "Post", "ED", " ", "x", "<br>", "p", "s", "PUBLISHED 1/2/20"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(2, 30)))


def test_context_is_the_text_of_the_parent(spark, pages_of):
    rng = random.Random(11)
    nodes = flatten_dom(pages_of(*[random_page(rng) for _ in range(400)])).cache()
    found = dates.dated_texts(nodes).select("page_id", "pos", "parent", F.col("owner.end_pos").alias("parent_end"))
    targets = found.select("page_id", F.col("parent").alias("t_pos"), F.col("parent_end").alias("t_end")).distinct()
    below = tree.subtree_text(nodes, targets, raw=True).where(dates._says_published(F.col("subtree"))).select("page_id", F.col("t_pos").alias("parent"))
    want = {tuple(r) for r in found.join(below, ["page_id", "parent"], "left_semi").select("page_id", "pos").collect()}
    got = [tuple(r) for r in dates.near_publication_words(nodes, found).collect()]
    assert len(got) == len(set(got)) and set(got) == want and 20 < len(want) < found.count()


def rows_made(frame):
    """Rows of all operators of the executed plan together."""
    frame.collect()
    total, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        metric = node.metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return total


def test_rows_grow_with_the_page(spark, pages_of):
    """Unclosed paragraphs that all ask about the text below them."""
    small, large = (rows_made(dates.text_date_candidates(flatten_dom(pages_of("<p>On 2020-03-04 " * n)))) for n in (500, 1000))
    assert 500 < small and large < 2.3 * small
