"""Tables of committed runs: what readers see while runs are written, fail, are repeated."""

import pytest
from pyspark.sql import functions as F

from pressframe.plans import articles, increments
from pressframe.sources import runs


@pytest.fixture()
def table(tmp_path):
    return f"file://{tmp_path}/table"


def rows(spark, table):
    return sorted((r.x, r.run) for r in runs.read_runs(spark, table).collect())


def test_only_committed_runs_are_read(spark, table):
    with pytest.raises(FileNotFoundError):
        runs.read_runs(spark, table)
    assert runs.read_runs(spark, table, "x long").count() == 0
    one = spark.range(3).select(F.col("id").alias("x"))
    runs.write_run(one, table, "1")
    runs.write_run(one, table, "2", commit=False)
    assert rows(spark, table) == [(0, "1"), (1, "1"), (2, "1")]
    bad = one.select(F.when(F.col("x") < 2, F.col("x")).otherwise(F.raise_error(F.lit("lost"))).alias("x"))
    for run in ("1", "2"):
        with pytest.raises(Exception, match="lost"):
            runs.write_run(bad, table, run)
        assert not runs.is_committed(spark, table, run)
    runs.write_run(one.where("x = 1"), table, "2")
    assert rows(spark, table) == [(1, "2")]
    runs.write_run(one.where("x = 0"), table, "1")
    runs.write_run(one.where("x = 0"), table, "1")
    assert rows(spark, table) == [(0, "1"), (1, "2")] and list(runs.committed_runs(spark, table)) == ["1", "2"]


def test_an_empty_run_counts(spark, table):
    runs.write_run(spark.range(0).select(F.col("id").alias("x")), table, "none")
    assert runs.is_committed(spark, table, "none") and rows(spark, table) == []


@pytest.mark.parametrize("name", ["", "a/b", "..", "_x", "a b", ".hidden"])
def test_names_that_are_no_folders(spark, table, name):
    with pytest.raises(ValueError):
        runs.write_run(spark.range(1), table, name)


def test_clean_html_reads_back(spark, table):
    clean = spark.createDataFrame([(1, "<p>a</p>", 5), (2, None, 6)], "page_id long, clean_html string, more int")
    articles.write_clean_html(clean, table, run="r")
    articles.write_clean_html(clean, table, run="r")
    assert sorted(map(tuple, runs.read_runs(spark, table).collect())) == [(1, "<p>a</p>", "r"), (2, None, "r")]


def test_frontier_takes_every_url_once(spark, tmp_path):
    state = f"file://{tmp_path}/state"
    first = spark.createDataFrame([("u1", 7), ("u1", 5), ("u2", 5), (None, 1)], "url string, site_id long")
    second = spark.createDataFrame([("u2", 1), ("u3", 9)], "url string, site_id long")
    assert sorted((r.url, r.site_id) for r in increments.extend_frontier(state, "1", first).collect()) == [("u1", 5), ("u2", 5)]
    for _ in range(2):
        assert [(r.url, r.site_id, r.run) for r in increments.extend_frontier(state, "2", second).collect()] == [("u3", 9, "2")]
    assert sorted(r.url for r in increments.open_links(spark, state).collect()) == ["u1", "u2", "u3"]
