"""Run queries against their oracles: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(map(cell, value))
    return value


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def difference(spark, con, function, oracle, sf_dir) -> tuple[int, str | None]:
    """Row count, and None when both sides give the same rows, else a short account of what differs."""
    frame = function(spark, sf_dir)
    names = sorted(frame.columns)
    mine = sorted((tuple(map(cell, r)) for r in frame.select(*names).collect()), key=repr)
    relation = con.execute(oracle)
    columns = [c[0] for c in relation.description]
    if sorted(columns) != names:
        return len(mine), f"columns {names} vs {sorted(columns)}"
    order = [columns.index(n) for n in names]
    theirs = sorted((tuple(cell(r[i]) for i in order) for r in relation.fetchall()), key=repr)
    if mine == theirs:
        return len(mine), None
    only_mine, only_theirs = set(mine) - set(theirs), set(theirs) - set(mine)
    return len(mine), (f"rows {len(mine)} vs {len(theirs)}\n   spark only {sorted(only_mine, key=repr)[:2]}"
            f"\n   oracle only {sorted(only_theirs, key=repr)[:2]}")


def main() -> None:
    from pyspark.sql import SparkSession
    from checks import build
    from checks.queries import ORACLES, QUERIES
    from pressframe.sources.pages import remove_stages

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            rows, found = difference(spark, con, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as problem:  # noqa: BLE001 - a report, not a rescue
            rows, found = -1, f"{type(problem).__name__}: {str(problem)[:500]}"
        remove_stages(build.configure(spark))
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {rows} rows {time.time() - start:.1f}s {found or ''}", flush=True)


if __name__ == "__main__":
    main()
