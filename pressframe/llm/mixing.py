"""Mixing sources to target weights by entropy balancing.

Documents belong to cells (here: their source).  The rates closest in relative entropy to
"every token once" that meet all token targets have the form ``exp(sum of the multipliers of a
cell's constraints)``; the multipliers solve a convex dual.  Each Newton step is a Spark aggregate
over cells, which are summed from the documents once, so a hot source costs one short row.  Rates
become whole copies by a hashed threshold for each cell, found through histograms.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Stages

#: With more constraints than this the curvature is not solved on the driver but bounded by its diagonal.
SOLVED_CONSTRAINTS = 1000
#: Rates beyond exp of this mean that the targets contradict each other.
_FAR = 200.0


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def weighted_targets(sources: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, share: float = 1.0) -> DataFrame:
    """``cell, source_size, target`` from ``sources(cell, source, source_size)``, one row a source.

    Sources in code-point order, null last, get the repeating weights and share ``share`` of all
    tokens.  A target stops at ``most`` times its source's size and the excess goes to the others by
    weight until none is above: the capped sources are those with the smallest size for their
    weight, so running sums in that order tell them.
    """
    named = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    by_room = Window.orderBy(F.col("room") / F.col("weight"), "rank")
    rows = (named.withColumn("weight", weight).withColumn("room", most * F.col("source_size"))
            .withColumn("total", share * F.sum("source_size").over(Window.partitionBy()))
            .withColumn("weights", F.sum("weight").over(Window.partitionBy()))
            .withColumn("room_before", F.coalesce(F.sum("room").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))))
    level = (F.col("total") - F.col("room_before")) / (F.col("weights") - F.col("weight_before"))
    rows = rows.withColumn("capped", F.col("room") <= level * F.col("weight"))
    left = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(Window.partitionBy())
    spare = F.col("total") - F.sum(F.when(F.col("capped"), F.col("room")).otherwise(0.0)).over(Window.partitionBy())
    target = F.when(F.col("capped"), F.col("room")).otherwise(spare * F.col("weight") / left)
    return rows.select("cell", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def _newton_move(member: DataFrame, at: DataFrame, lam: DataFrame) -> DataFrame:
    """``constraint, held, move``: the Newton step with the whole curvature, tokens shared by each two constraints, solved on the driver."""
    weighted = member.join(at.select("cell", "exponent"), "cell").withColumn("now", F.col("tokens") * F.exp("exponent"))
    both = weighted.select("cell", "constraint", "now").join(member.select("cell", F.col("constraint").alias("other")), "cell")
    shared = both.groupBy("constraint", "other").agg(F.sum("now").alias("now")).collect()
    target = {r.constraint: r.target for r in lam.where("target > 0").select("constraint", "target").collect()}
    held = {r.constraint: r.now for r in shared if r.constraint == r.other}
    names = [c for c in sorted(held) if c in target]
    place = {c: i for i, c in enumerate(names)}
    curvature, gap = np.zeros((len(names), len(names))), np.array([target[c] - held[c] for c in names])
    for r in shared:
        if r.constraint in place and r.other in place:
            curvature[place[r.constraint], place[r.other]] = r.now
    move = np.linalg.lstsq(curvature, gap, rcond=1e-12)[0] if names else gap
    # What no step can change: sums of targets that the cells tie together, such as all sources and all languages.
    if np.abs(gap - curvature @ move).max(initial=0.0) > 1e-6 * max(target.values(), default=0.0):
        raise ValueError("no rates meet all targets: they contradict each other")
    move *= min(1.0, 2.0 / max(np.abs(move).max(initial=0.0), 1e-300))
    rows = [(c, float(held[c]), float(move[place[c]]) if c in place else -2.0) for c in held]
    return member.sparkSession.createDataFrame(rows, "constraint string, held double, move double")


def balance(cells: DataFrame, targets: DataFrame, stages: Stages, tolerance: float = 1e-9, steps: int = 400) -> DataFrame:
    """Rates ``cell, rate`` that meet token targets.

    ``cells(cell, tokens, constraints)``: tokens of a cell and the array of constraint names it counts
    for.  ``targets(constraint, target)``.  The dual ``sum tokens * exp(sum of multipliers) - sum target *
    multiplier`` is lowered by Newton steps until every target is met.  Without overlap the curvature is its diagonal; where cells count
    for several constraints, the whole curvature is summed in Spark and solved on the driver, up to ``SOLVED_CONSTRAINTS``; beyond,
    the diagonal times the largest number of constraints on a cell bounds it.
    Constraints without tokens, and cells without constraints, keep rate 1; a target of 0 gives rate 0.
    Raises ValueError when the targets cannot be met together, or not within ``steps``.
    """
    member = cells.where("tokens > 0").select("cell", "tokens", F.explode("constraints").alias("constraint"))
    overlap = cells.agg(F.max(F.size("constraints"))).first()[0] or 1
    solved = overlap > 1 and targets.count() <= SOLVED_CONSTRAINTS
    # The multiplier of a zero target falls without end; its rate is 0 from the start.
    lam = stages.write(targets.select("constraint", "target", F.when(F.col("target") > 0, 0.0).otherwise(-800.0).alias("multiplier")), "multipliers-0")
    for step in range(1, steps + 1):
        at = member.join(lam, "constraint").groupBy("cell", "tokens").agg(F.sum("multiplier").alias("exponent"))
        if solved:
            found = _newton_move(member, at, lam)
        else:
            held = (member.select("cell", "constraint").join(at, "cell").groupBy("constraint")
                    .agg(F.sum(F.col("tokens") * F.exp("exponent")).alias("held")))
            found = lam.join(held, "constraint").select(
                "constraint", "held", F.when(F.col("held") > 0, (F.col("target") / F.col("held") - 1) / overlap).otherwise(0.0).alias("move"))
            found = found.withColumn("move", F.least(F.greatest("move", F.lit(-2.0)), F.lit(2.0)))
        counts = F.col("target") > 0
        lam = stages.write(lam.join(found, "constraint", "left").select(
            "constraint", "target", (F.col("multiplier") + F.when(counts, F.coalesce("move", F.lit(0.0))).otherwise(0.0)).alias("multiplier"),
            F.when(counts, F.abs(F.coalesce(F.col("held") / F.col("target") - 1, F.lit(0.0)))).otherwise(0.0).alias("off")), f"multipliers-{step}")
        stages.drop(f"multipliers-{step - 1}")
        state = lam.agg(F.max("off").alias("off"), F.max(F.when(F.col("target") > 0, F.abs("multiplier"))).alias("far")).first()
        lam = lam.drop("off")
        if (state.off or 0.0) < tolerance:
            break
        if state.far > _FAR:
            raise ValueError("no rates meet all targets: they contradict each other")
    else:
        raise ValueError(f"targets are not met after {steps} steps; the worst is off by a share of {state.off:.2g}")
    rates = member.join(lam, "constraint").groupBy("cell").agg(F.exp(F.sum("multiplier")).alias("rate"))
    return cells.select("cell").join(rates, "cell", "left").select("cell", F.coalesce("rate", F.lit(1.0)).alias("rate"))


def round_to_copies(units: DataFrame, stages: Stages, most: float = 3.0) -> DataFrame:
    """Adds ``copies`` to ``units(..., cell, size, rate, draw)``.

    Each unit gets the whole part of its rate; the rest goes to the units of its cell with the smallest
    ``draw / fraction`` until the cell's tokens are met as closely as whole documents allow.  The limit is
    found in three histograms, each within one bin of the one before.  ``draw`` is uniform in
    [0, 1) and a function of the row, so reruns agree; equal rows share one fate.
    """
    rate = F.least(F.col("rate"), F.lit(float(most)))
    whole = F.floor(rate + 1e-9)
    fraction = F.greatest(rate - whole, F.lit(0.0))
    order = F.when(fraction > 1e-9, F.least(F.floor(F.col("draw") / fraction * float(1 << 32)), F.lit((1 << 44) - 1)))
    units = units.withColumns({"whole": whole.cast("long"), "order": order.cast("long")})
    wanted = units.groupBy("cell").agg(F.sum(F.col("size") * fraction).alias("wanted"))
    found = stages.write(wanted.select("cell", "wanted", F.lit(0).cast("long").alias("limit")), "limit-0")
    for step, shift in enumerate((32, 20, 8), 1):
        inside = units.where("order is not null and size > 0").join(found, "cell")
        if step > 1:
            inside = inside.where(F.shiftright("order", shift + 12) == F.shiftright("limit", shift + 12))
        bins = (inside.groupBy("cell", "wanted", "limit", F.shiftright("order", shift).alias("bin"))
                .agg(F.sum("size").cast("double").alias("tokens")))
        upto = F.sum("tokens").over(Window.partitionBy("cell").orderBy("bin"))
        bins = bins.withColumn("before", upto - F.col("tokens"))
        # The bin in which the wanted tokens run out: the last that starts below them.
        bins = bins.where("before < wanted").groupBy("cell").agg(F.max_by(F.struct("bin", "before", "tokens"), "bin").alias("last"))
        rest = F.col("wanted") - F.coalesce("last.before", F.lit(0.0))
        limit = F.shiftleft(F.coalesce("last.bin", F.shiftright("limit", shift)), shift)
        if step == 3:  # the last bin holds a document or equal rows: taken if that is nearer
            limit = limit + F.when(F.coalesce("last.tokens", F.lit(0.0)) <= 2 * rest, F.lit(1 << shift)).otherwise(F.lit(0))
        found = stages.write(found.join(bins, "cell", "left").select("cell", rest.alias("wanted"), limit.cast("long").alias("limit")), f"limit-{step}")
        stages.drop(f"limit-{step - 1}")
    extra = F.when(F.col("order") < F.col("limit"), 1).otherwise(0)
    return (units.join(found.select("cell", "limit"), "cell").withColumn("copies", F.col("whole") + extra)
            .drop("whole", "order", "limit"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, share: float = 1.0,
                seed: int = 7) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` for every row of ``docs``.

    Sizes are words of the whole text.  Defined cases: a null text has size 0 and a source without words target 0;
    a null source is a source of its own, last in order; equal rows get equal copies; an empty table gives no
    rows; columns other than doc_id, text and source are ignored.
    """
    stages = Stages(docs.sparkSession, "mixing")
    cell = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    draw = (F.xxhash64("doc_id", "source", "text", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52)))
    sizes = stages.write(docs.select("doc_id", "source", cell.alias("cell"), word_count(F.col("text")).alias("size"),
                                     draw.alias("draw")), "sizes")
    sources = sizes.groupBy("cell", "source").agg(F.sum("size").alias("source_size"))
    targets = stages.write(weighted_targets(sources, weights, most, share), "targets")
    cells = targets.select("cell", F.col("source_size").cast("double").alias("tokens"), F.array("cell").alias("constraints"))
    rates = balance(cells, targets.select(F.col("cell").alias("constraint"), "target"), stages)
    # Written, so that its true size decides how it meets the documents.
    rates = stages.write(targets.join(rates, "cell"), "rates")
    units = sizes.join(rates, "cell")
    return (round_to_copies(units, stages, most)
            .select("doc_id", "source", "size", "source_size", "target", "rate", F.col("copies").cast("long").alias("copies"),
                    (F.col("size") * F.col("copies")).cast("long").alias("taken")))
