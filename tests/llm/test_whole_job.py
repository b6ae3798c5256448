"""Cases a fixed bound once cut short."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressframe.llm.chosen_path import LEAST_PERCENT, TREES, components, least_equal, near_duplicates, trees_for
from pressframe.llm.common import Stages
from pressframe.llm.language import best_path, label_words


def test_components_of_a_long_chain(spark):
    rng = np.random.default_rng(5)
    chains = [rng.permutation(2000), 5000 + rng.permutation(300), 9000 + np.arange(50)]
    links = [(int(a), int(b)) for ids in chains for a, b in zip(ids[:-1], ids[1:])]
    stages = Stages(spark, "chain")
    found = components(spark.createDataFrame(links, "a long, b long"), stages, "chain").collect()
    want = {int(i): int(ids.min()) for ids in chains for i in ids}
    assert len(found) == len(want) and {r.cid: r.comp for r in found} == want


def test_recall_holds_at_lower_percent(spark):
    assert (trees_for(75), least_equal(75, 3 * trees_for(75))) == (TREES, 30)
    rng, rows = np.random.default_rng(8), []
    for i in range(60):
        words = [f"w{x}" for x in rng.integers(0, 10**9, 300)]
        rows += [(2 * i, " ".join(words[:200])), (2 * i + 1, " ".join(words[66:266]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(docs, percent=50, q=1).collect()}
    assert found == {i: i - i % 2 for i in range(120)}
    for refused in ({"percent": LEAST_PERCENT - 1}, {"percent": 60, "trees": TREES}):
        with pytest.raises(ValueError):
            near_duplicates(docs, **refused)


def test_short_cut_sees_two_small_gains():
    scores = np.array([[0, 7, -20], [0, 7, -20], [0, -20, 7], [0, -20, 7]], float)
    path, _ = label_words(scores, np.zeros(4, int), 1, 20.0)
    assert path.tolist() == best_path(scores, 20.0).tolist() == [1, 1, 2, 2]


def test_overlapping_constraints_are_met_or_refused(spark):
    from pressframe.llm import mixing

    cells = spark.createDataFrame([("a", 100.0, ["x", "p"]), ("b", 300.0, ["x", "q"]), ("c", 50.0, ["y", "p"]), ("d", 80.0, ["y", "q"]), ("e", 9.0, []), ("f", 0.0, ["x"])],
                                  "cell string, tokens double, constraints array<string>")
    tokens = {r.cell: r.tokens for r in cells.collect()}

    def met(wanted, solved, tolerance=1e-6):
        targets = spark.createDataFrame(list(wanted.items()), "constraint string, target double")
        mixing.SOLVED_CONSTRAINTS, before = solved, mixing.SOLVED_CONSTRAINTS
        try:
            rate = {r.cell: r.rate for r in mixing.balance(cells, targets, Stages(spark, "overlap"), tolerance=tolerance).collect()}
        finally:
            mixing.SOLVED_CONSTRAINTS = before
        return rate, {c: sum(tokens[r.cell] * rate[r.cell] for r in cells.collect() if c in r.constraints) for c in wanted}

    wanted = {"x": 500.0, "y": 100.0, "p": 250.0, "q": 350.0}
    rate, held = met(wanted, 1000)
    assert all(abs(held[c] / wanted[c] - 1) < 1e-5 for c in wanted) and rate["e"] == 1.0
    # An exponential tilt: the odds ratio of the four cells is what it was.
    assert abs(rate["a"] * rate["d"] / rate["b"] / rate["c"] - 1) < 1e-4
    bounded, _ = met({"x": 500.0, "y": 100.0}, 0, 1e-3)
    assert abs(bounded["a"] - 1.25) < 2e-3 and abs(bounded["c"] - 100 / 130) < 2e-3
    assert met({"x": 0.0, "y": 100.0}, 1000)[0]["a"] < 1e-300
    with pytest.raises(ValueError):
        met({"x": 500.0, "y": 100.0, "p": 250.0, "q": 3500.0}, 1000)


def test_of_repeated_rows_always_the_same_one_stays(spark):
    from pyspark.sql import functions as F

    from pressframe.llm.common import row_keys, without

    rows = [(1, "same text", f"lang{i}", f"src{i % 3}") for i in range(50)] + [(2, "other", "en", "src")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    once = docs.select(*row_keys()).groupBy("did", "th").count().where("count > 1")
    found = {tuple(sorted(tuple(r) for r in without(docs.repartition(n).orderBy(F.rand(n)), once.where("false"), once=once).collect())) for n in (1, 3, 7)}
    assert len(found) == 1 and len(next(iter(found))) == 2


def test_quality_is_learned_from_every_label(spark, tmp_path):
    """As many labelled documents as were rejected lie under the threshold, beyond any number gathered at once, and slices change little."""
    from pressframe.llm import quality
    from pressframe.llm.common import Stages

    n, bad = 26_000, 2_503
    noise = [((F.xxhash64("doc_id", F.lit(i)) % 1000) / 1000).cast("float") for i in range(len(quality.FEATURES) - 1)]
    good = F.col("doc_id") >= bad
    spark.range(n).toDF("doc_id").select("doc_id", F.array((noise[0] + good.cast("int")).cast("float"), *noise).alias("features")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    labels = rows.select("doc_id", good.cast("int").alias("quality"))
    columns = [quality.fit_quality(rows, labels, Stages(spark, "test-quality"), **how).alias(name) for name, how in (("whole", {}), ("sliced", {"slice_docs": 1_000}))]
    found = rows.select("doc_id", *columns).toPandas()
    for name in ("whole", "sliced"):
        assert (found[name] < quality.THRESHOLD).sum() == bad
        assert ((found[name] >= quality.THRESHOLD) == (found.doc_id >= bad)).mean() > 0.9
    assert (found.whole - found.sliced).abs().max() < 0.1
