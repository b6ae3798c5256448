"""Filter interaction audit: what each filter removes in every order of the filters.

A document's failures do not depend on the order, so they are worked out once, as one bit per filter.  Copies are
found by an existential self-join: a left-semi join on hash, exact text and a smaller ``doc_id``.  Its ids are united with
those of the other failures, the bits of a document are put together, and only counts of bit combinations (at most 32
for each part) are left for the orders to read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from .common import Stages
from .filters import bit_filter, passing_rows

#: Filters in order of their bits; the last one looks at other documents.
FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
#: A hash with more than one in so many rows is split over several keys, so at most so many hashes are.
HOT_SHARE = 500

_WHITE = "[ \t-\r]+"


def own_failures(text: str = "text", words: str = "words") -> Column:
    """Bits of the filters that look at one document: few words, repetitive, shouting, symbols."""
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = [n < 100, 100 * different < 80 * n, 100 * capitals > 10 * F.char_length(text), F.col(text).rlike("[#$%&*|]")]
    bits = [F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests)]
    return sum(bits[1:], bits[0])


def marked_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, part, h, bits``: hash of the text and bits of its own failures, one row for each document."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), text)
    rows = rows.select("*", F.array_remove(F.split("text", _WHITE), "").alias("words"))
    return rows.select("doc_id", "part", F.xxhash64("text").alias("h"), own_failures().alias("bits"))


def later_copies(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """``doc_id, part, h`` of documents whose text a smaller ``doc_id`` has too.

    Only texts whose hash occurs under two ids are exchanged.  The side that is looked up holds one row for each
    text, its smallest id; a hash with a large share of all rows is dealt out under several salts, with its row in each.
    """
    hashes = marked.groupBy("h").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = hashes.where("least < most").select("h", "n")
    rows = marked.count()
    hot = [(r.h, -(-r.n * HOT_SHARE // rows)) for r in shared.where(F.col("n") * HOT_SHARE > rows).collect()]
    salts = F.lit(1)
    if hot:
        salts = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in hot for x in pair]), F.col("h")), salts)

    texts = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = passing_rows(texts.select("*", F.xxhash64("text").alias("h")), "h", bit_filter(shared, "h")).where("maybe").drop("maybe")
    first = texts.groupBy("h", "text").agg(F.min("doc_id").alias("least"))
    first = first.select("h", "text", "least", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    dealt = texts.withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int"))
    copies = dealt.alias("d").join(first.alias("f"), (F.col("d.h") == F.col("f.h")) & (F.col("d.salt") == F.col("f.salt"))
                                   & (F.col("d.text") == F.col("f.text")) & (F.col("f.least") < F.col("d.doc_id")), "left_semi")
    return copies.select("doc_id", "part", "h")


def combinations(docs: DataFrame, labels: DataFrame, stages: Stages) -> DataFrame:
    """``part, bits, n, good, toxic``: documents of each combination of failures, and the labelled ones among them."""
    marked = stages.write(marked_documents(docs), "marked")
    copies = later_copies(docs, marked).select("doc_id", "part", "h", F.lit(1 << FILTERS.index("E")).alias("bits"), F.lit(0).alias("n"))
    failures = marked.select("doc_id", "part", "h", "bits", F.lit(1).alias("n")).union(copies)
    united = failures.groupBy("doc_id", "part", "h").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    united = stages.write(united.select("doc_id", "part", "bits", "n"), "united")
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = united.where("doc_id is not null").join(marks, "doc_id", "left").select("part", "bits", "n", "good", "toxic")
    known = known.union(united.where("doc_id is null").select("part", "bits", "n", F.lit(0), F.lit(0)))
    of = {k: F.sum(F.col("n") * F.coalesce(F.col(k), F.lit(0))).alias(k) for k in ("good", "toxic")}
    return known.groupBy("part", "bits").agg(F.sum("n").alias("n"), of["good"], of["toxic"])


def order_report(counts: DataFrame) -> DataFrame:
    """The rows of :func:`audit_filters` from :func:`combinations`: all orders and steps, for each part in one row until then."""
    found = counts.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("found"))
    rows = found.select("part", "found", F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))

    def bit(name: Column) -> Column:
        return sum([F.when(name == f, 1 << i).otherwise(0) for i, f in enumerate(FILTERS[1:], 1)], F.when(name == FILTERS[0], 1).otherwise(0))

    earlier = F.aggregate(F.sequence(F.lit(1), F.col("step")), F.lit(0),
                          lambda mask, i: F.when(i < F.col("step"), mask.bitwiseOR(bit(F.substring("filter_order", i, F.lit(1))))).otherwise(mask))
    rows = rows.select("part", "filter_order", "step", "found", bit(letter).alias("own"), earlier.alias("before"))

    def total(value: str, test) -> Column:
        return F.aggregate(F.filter("found", test), F.lit(0).cast("long"), lambda s, c: s + c[value])

    def fails(c) -> Column:
        return c["bits"].bitwiseAND(F.col("own")) != 0

    def gone(c) -> Column:
        return c["bits"].bitwiseAND(F.col("before")) != 0

    def removed(c) -> Column:
        return fails(c) & ~gone(c)

    # Of all orders, each failing filter of a document is the first in an equal share.
    shapley = F.aggregate(F.filter("found", fails), F.lit(0).cast("long"),
                          lambda s, c: s + c["n"] * (F.lit(len(ORDERS)) / F.bit_count(c["bits"])).cast("long"))
    return rows.select(
        "part", "filter_order", "step", total("n", lambda c: ~fails(c) & ~gone(c)).alias("kept"), total("n", removed).alias("removed"),
        total("n", lambda c: fails(c) & gone(c)).alias("redundant"), total("n", lambda c: c["bits"] == F.col("own")).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"), shapley.alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    One row for each ``lang`` of ``docs(doc_id, text, lang)``, order of the five filters and step; ``labels(doc_id, quality, toxic)``
    says which removed documents were good or toxic (any row of an id may say so).
    Defined cases: a null text is empty, a null ``lang`` the empty part; an empty text has too few words and no other failure of
    its own; of equal texts under one id none is a later copy, and repeated rows count each; a document without id
    is no copy of another, makes none, and has no label; empty ``docs`` give no rows, empty ``labels`` zeros; other columns are not
    read.  Documents of one id, part and 64-bit text hash are taken for the same text.
    """
    stages = Stages(docs.sparkSession, "filter-audit")
    counts = stages.write(combinations(docs, labels, stages), "counts")
    stages.drop("marked", "united")
    return order_report(counts)
