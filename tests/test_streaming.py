from pressframe.plans.discovery import discover_links, fetch_frontier, write_links
from pressframe.streaming.landing import stream_links, watch_pages


def html(n):
    return "<ul>" + "".join(f'<li><a href="/news/acme-opens-{n}-{i}">x</a></li>' for i in range(6)) + "</ul>"


def test_stream_gives_the_batch_result_and_takes_up_where_it_stopped(spark, pages_of, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("landing", "out", "mark"))
    pages = pages_of(html(1), html(2), "<p>x</p>", html(3))
    pages.where("page_id < 2").write.parquet(landing)
    stream_links(watch_pages(spark, landing, 1), out, mark).awaitTermination()
    pages.where("page_id >= 2").write.mode("append").parquet(landing)
    stream_links(watch_pages(spark, landing, 1), out, mark).awaitTermination()
    got = spark.read.parquet(out).select("page_id", "url_no", "href", "url")
    want = discover_links(pages)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_link_sink_feeds_the_frontier(spark, pages_of, tmp_path):
    path = str(tmp_path / "links")
    write_links(discover_links(pages_of(html(1), html(2))), path, buckets=4)
    stored = spark.read.parquet(path)
    known = spark.createDataFrame([(7, "https://h.example.com/news/news/acme-opens-1-0")], "page_id long, url string")
    assert stored.count() == 12 and fetch_frontier(stored, known).count() == 11
