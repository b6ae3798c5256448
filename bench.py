"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "news_link_discovery", "news_links_from_html", "link_group_winner", "host_url_profile", "url_structure",
    "dom_tag_counts", "page_titles", "boilerplate_lines", "article_title", "article_date", "article_metadata",
    "content_labels", "article_tables", "clean_html", "article_records", "load_more_controls", "next_controls",
    "year_selector", "nav_plan", "crawl_links",
]


def main() -> None:
    from pyspark.sql import SparkSession
    from checks import build
    from checks.queries import QUERIES
    from pressframe.sources.pages import remove_stages

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["page_titles"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the workers
    first, times = {}, {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        took = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(round(time.perf_counter() - start, 3))
            remove_stages(build.configure(spark))
        first[name], times[name] = took[0], sorted(took)[1]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    size = sum(os.path.getsize(f"{sf_dir}/{t}.parquet") for t in ("pages",) if os.path.isfile(f"{sf_dir}/{t}.parquet"))
    discovery = times.get("news_link_discovery")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "first_run": first, "pages_per_sec": round(pages / discovery, 1) if discovery else None,
        "page_bytes_per_sec": round(size / discovery) if discovery else None}))


if __name__ == "__main__":
    main()
