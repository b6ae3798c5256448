"""Cut a page down to its labelled parts, render it, and check that no label was lost.

What is cut follows from positions, tags and labels alone.  Those narrow rows go through the windows and end as one short row per
page: a flag for every position, its labels, and digests of the labels before and after the cut.  Texts and
attributes are rendered beside that, node by node, and meet that row by page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from pressframe.operators.tree import earlier, holds, inside, is_structural
from pressframe.sources.dom import VOID_TAGS


_SPECIAL = {"C": ("<!--", "-->"), "D": ("<!DOCTYPE ", ">\n"), "N": ("<!", ">"), "M": ("<![", "]>"), "P": ("<?", ">")}


def _page() -> WindowSpec:
    return Window.partitionBy("page_id")


def _with_values(labels: DataFrame) -> DataFrame:
    return labels if "label_value" in labels.columns else labels.withColumn("label_value", F.lit(None).cast("string"))


def _valued() -> Column:
    return F.when(F.col("label_value").isNotNull(), F.struct("label_type", "label_value"))


def label_nodes(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes with ``label_types`` and ``label_values`` (null where there is none); labels are unique per node first.

    ``label_values`` holds the types that have a value with the first of their values.
    """
    per_node = (_with_values(labels).select("page_id", "pos", "label_type", "label_value").repartition("page_id").groupBy("page_id", "pos")
                .agg(F.array_sort(F.collect_set("label_type")).alias("label_types"),
                     F.array_sort(F.collect_set(_valued())).alias("label_values")))
    return nodes.repartition("page_id").join(per_node, ["page_id", "pos"], "left")


# What of a node decides about cutting, as bits of one number.
ELEMENT, SHOWN, STRUCTURAL, BODY = 1, 2, 4, 8


def _traits() -> Column:
    element, tag = F.col("kind") == "E", F.col("tag")
    bits = {ELEMENT: element, SHOWN: F.col("seq").isNotNull(), STRUCTURAL: element & is_structural(tag), BODY: element & (tag == "body")}
    return sum([F.when(test, bit).otherwise(0) for bit, test in bits.items()], F.lit(0))


def _has(bit: int) -> Column:
    return F.col("traits").bitwiseAND(bit) != 0


def labelled_outline(nodes: DataFrame, labels: DataFrame, mark: bool = False) -> DataFrame:
    """``page_id, pos, end_pos, traits, n, total, mixed`` of every node, and of labels without one (null ``end_pos``).

    ``n, total, mixed`` are the number, sum and exclusive-or of the node's hashed labels.  Nodes and labels are united and put together
    by position: one exchange of short numbers.  With ``mark`` also ``label_types`` and ``label_values``.
    """
    texts = ["label_type", "label_value"] if mark else []
    h = F.xxhash64("pos", "label_type")
    of_node = nodes.select("page_id", "pos", "end_pos", _traits().alias("traits"), F.lit(None).cast("long").alias("h"), *[F.lit(None).cast("string").alias(c) for c in texts])
    of_label = _with_values(labels).select("page_id", "pos", *[F.lit(None).cast("int").alias(c) for c in ("end_pos", "traits")], h.alias("h"), *texts)
    types = F.array_sort(F.collect_set("label_type"))
    lists = [F.when(F.size(types) > 0, types).alias("label_types"), F.array_sort(F.collect_set(_valued())).alias("label_values")] if mark else []
    return of_node.union(of_label).repartition("page_id").groupBy("page_id", "pos").agg(
        F.max("end_pos").alias("end_pos"), F.max("traits").alias("traits"), *_digest(F.col("h")), *lists)


def _digest(h: Column) -> list[Column]:
    """Number, sum and exclusive-or of hashes: equal for equal labels in any order."""
    none = F.lit(0).cast("long")
    return [F.count(h).alias("n"), F.coalesce(F.sum(F.shiftrightunsigned(h, 24)), none).alias("total"), F.coalesce(F.bit_xor(h), none).alias("mixed")]


def with_gone(rows: DataFrame, labelled: Column) -> DataFrame:
    """Rows with ``gone``, from rows with ``traits``.

    A node is *free* when neither it nor anything above or below it is labelled.  The outermost
    free nodes of the body are where the page is cut: a structural one stays whole, any other
    goes with its subtree.  A body without labels is itself free and structural, so that page
    stays as it is.
    """
    body = F.first(F.when(_has(BODY), F.struct("pos", "end_pos")), ignorenulls=True).over(earlier())
    rows = rows.withColumn("above", holds(labelled)).withColumn("body", body)
    is_body = F.col("body").isNull() & _has(BODY)
    rows = (rows.withColumn("in_body", F.coalesce(is_body | (F.col("pos") <= F.col("body.end_pos")), F.lit(False)))
            .withColumn("below", inside(labelled & F.col("in_body")))
            .withColumn("free", F.coalesce(F.col("in_body") & (_has(ELEMENT) | _has(SHOWN)) & ~labelled & ~F.col("below") & ~F.col("above"), F.lit(False)))
            .withColumn("cut", F.col("free") & ~inside(F.col("free"))))
    goes = F.col("cut") & ~_has(STRUCTURAL)
    return rows.withColumn("gone", goes | inside(goes)).drop("above", "body", "in_body", "below", "free", "cut")


def prune(nodes: DataFrame) -> DataFrame:
    """Nodes that stay, from nodes with ``label_types``; see :func:`with_gone`."""
    outline = nodes.select("page_id", "pos", "end_pos", _traits().alias("traits"), F.col("label_types").isNotNull().alias("labelled"))
    gone = with_gone(outline, F.col("labelled")).where("gone").select("page_id", "pos")
    return nodes.join(gone, ["page_id", "pos"], "left_anti").select(*nodes.columns)


def cuts(outline: DataFrame, mark: bool = False) -> DataFrame:
    """``page_id, stays, labels_kept``: one row per page, from :func:`labelled_outline`.

    ``stays`` lists the positions in order, each as twice the number and one if the node stays; with ``mark`` they are structs
    of that and the labels.  ``labels_kept`` compares the digest of all labels with that of the labels on nodes that stay.
    """
    is_node, kept = F.col("end_pos").isNotNull(), F.col("end_pos").isNotNull() & ~F.col("gone")
    code = F.col("pos").cast("long") * 2 + F.when(F.col("gone"), 0).otherwise(1)
    entry = F.struct(code.alias("code"), "label_types", "label_values") if mark else code
    sums = [F.sum(F.col(c)).alias(f"all_{c}") for c in ("n", "total")] + [F.sum(F.when(kept, F.col(c))).alias(f"kept_{c}") for c in ("n", "total")]
    mixed = [F.bit_xor("mixed").alias("all_mixed"), F.bit_xor(F.when(kept, F.col("mixed"))).alias("kept_mixed")]
    pages = with_gone(outline, F.col("n") > 0).groupBy("page_id").agg(F.sort_array(F.collect_list(F.when(is_node, entry))).alias("stays"), *sums, *mixed)
    same = [F.col(f"all_{c}") == F.coalesce(f"kept_{c}", F.lit(0)) for c in ("n", "total", "mixed")]
    return pages.select("page_id", "stays", (same[0] & same[1] & same[2]).alias("labels_kept"))


def lost_labels(before: DataFrame, after: DataFrame) -> DataFrame:
    """Labels on one side only, as ``(page_id, pos, label_type, side)``; only pages whose digests differ are compared."""
    wrong = verify_prune(before, after).where("not labels_kept").select("page_id")
    columns = ["page_id", "pos", "label_type"]
    left, right = (f.join(wrong, "page_id", "left_semi").select("page_id", "pos", F.explode("label_types").alias("label_type")) for f in (before, after))
    return (left.exceptAll(right).select(*columns, F.lit("lost").alias("side"))
            .unionByName(right.exceptAll(left).select(*columns, F.lit("new").alias("side"))))


def verify_prune(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(page_id, labels_kept)``: does every label of the page survive, and no other appear?  One short row per page and side is compared."""
    sums = ["n", "total", "mixed"]

    def side(frame: DataFrame, name: str) -> DataFrame:
        rows = frame.select("page_id", "pos", F.explode_outer("label_types").alias("label_type"))
        h = F.when(F.col("label_type").isNotNull(), F.xxhash64("pos", "label_type"))
        return rows.groupBy("page_id").agg(*_digest(h)).select("page_id", F.struct(*sums).alias(name))

    same = F.col("old").eqNullSafe(F.col("new")) | (F.coalesce("old.n", F.lit(0)) + F.coalesce("new.n", F.lit(0)) == 0)
    return side(before, "old").join(side(after, "new"), "page_id", "full").select("page_id", same.alias("labels_kept"))


def _escape(text: Column, quote: bool = False) -> Column:
    out = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                    F.lit(">"), F.lit("&gt;"))
    if not quote:
        return out
    single = out.contains('"') & ~out.contains("'")
    return F.when(single, F.concat(F.lit("'"), out, F.lit("'"))).otherwise(
        F.concat(F.lit('"'), F.replace(out, F.lit('"'), F.lit("&quot;")), F.lit('"')))


def render_html(nodes: DataFrame, cut: DataFrame | None = None, mark: bool = False) -> DataFrame:
    """``(page_id, clean_html)`` from nodes, without those that do not stay by ``cut`` (see :func:`cuts`).

    Nodes meet the cut of their page row by row, in the order of pages, so a task puts its pages together one at a time.  Every element
    gives an opening and a closing chunk; sorting by (position, closing, depth) restores the nesting.  A closing chunk sorts after all that starts inside its interval, the
    innermost first.  ``mark`` writes node numbers and the labels in ``cut`` as ``data-`` attributes, and a
    label's value as ``data-<label>``.
    """
    element = F.col("kind") == "E"
    void = F.col("tag").isin(sorted(VOID_TAGS))
    entries = F.transform(F.map_entries("attrs"), lambda e: F.concat(
        F.lit(" "), e["key"], F.lit("="), _escape(e["value"], quote=True)))
    number = F.concat(F.lit(' data-node="'), F.col("node_idx").cast("string"), F.lit('"')) if mark else F.lit("")
    written = F.when(F.size("attrs") == 0, "").otherwise(F.array_join(entries, ""))
    head = F.concat(F.lit("<"), F.col("tag"), written, number)
    tail = F.when(void, F.lit("/>")).otherwise(F.lit(">"))
    raw = F.col("owner.tag").isin("script", "style")
    words = F.when(raw, F.col("text")).otherwise(_escape(F.col("text")))
    for kind, (opens, closes) in _SPECIAL.items():
        words = F.when(F.col("kind") == kind, F.concat(F.lit(opens), F.col("text"), F.lit(closes))).otherwise(words)
    in_span = F.col("seq").isNotNull() & (F.col("kind") == "T") if mark else F.lit(False)
    span = F.concat(F.lit('<span data-seq="'), F.col("seq").cast("string"), F.lit('"'), number)

    if mark:  # labels go in between
        texts = [F.when(element, head).when(in_span, span).otherwise(words).alias("chunk"),
                 F.when(element, tail).when(in_span, F.concat(F.lit(">"), words, F.lit("</span>"))).alias("after_labels")]
    else:
        texts = [F.when(element, F.concat(head, tail)).otherwise(words).alias("chunk")]
    rows = nodes.where("kind <> 'R'").select(
        "page_id", "pos", "end_pos", *texts, F.when(element & ~void, F.concat(F.lit("</"), F.col("tag"), F.lit(">"))).alias("closes"))
    shown = []
    if cut is None:
        rows = rows.withColumn("kept", F.lit(True)).sortWithinPartitions("page_id")
    else:
        rows = rows.join(cut, "page_id")
        first = F.col("stays")[0]["code"] if mark else F.col("stays")[0]
        wanted, place = F.col("pos").cast("long") * 2, F.get("stays", F.col("pos") - F.shiftright(first, 1).cast("int"))
        found = place["code"] if mark else place
        in_place = F.shiftright(found, 1) == F.col("pos")
        # By the place its number should have; where numbers are missing, by search.
        rows = rows.withColumn("kept", F.when(in_place, found == wanted + 1).otherwise(
            F.exists("stays", lambda x: (x["code"] if mark else x) == wanted + 1)))
        if mark:
            entry = F.when(in_place, place).otherwise(F.get(F.filter("stays", lambda x: F.shiftright(x["code"], 1) == F.col("pos")), 0))
            rows = rows.withColumn("shown", F.when(F.col("after_labels").isNull(), F.col("chunk")).otherwise(
                F.concat("chunk", _label_attributes(entry), "after_labels")))
            shown = ["after_labels", "shown"]

    def chunk(at: str, closing: int, *text: Column) -> Column:
        # Position, closing and depth as one number, which is compared faster than three.
        place = F.shiftleft(F.col(at).cast("long") * 2 + closing, 31) + ((1 << 31) - 1 - F.col("pos").cast("long"))
        return F.struct(place.alias("place"), *[t.cast("string").alias(n) for n, t in zip(["chunk", *shown], text)])

    opening = chunk("pos", 0, F.col("chunk"), *map(F.col, shown))
    closing = chunk("end_pos", 1, F.col("closes"), *[F.lit(None), F.col("closes")][:len(shown)])
    lists = [F.collect_list(F.when(F.col("kept"), opening)), F.collect_list(F.when(F.col("kept") & F.col("closes").isNotNull(), closing))]
    pages = rows.groupBy("page_id").agg(F.sort_array(F.concat(*lists)).alias("chunks"))
    return pages.select("page_id", F.array_join(F.col("chunks")["shown" if shown else "chunk"], "").alias("clean_html"))


def _label_attributes(entry: Column) -> Column:
    values = F.transform(entry["label_values"], lambda v: F.concat(
        F.lit(" data-"), v["label_type"], F.lit("="), _escape(v["label_value"], quote=True)))
    return F.concat(F.coalesce(F.concat(F.lit(' data-label="'), F.array_join(entry["label_types"], " "), F.lit('"')), F.lit("")),
                    F.coalesce(F.array_join(values, ""), F.lit("")))
