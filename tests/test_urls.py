from pyspark.sql import functions as F

from pressframe.functions import urls


def evaluate(spark, values, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, u string")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("u"))).collect()]


def test_structure_flags(spark):
    cases = {  # url: (multi level, extension, slug length)
        "/x": (True, False, 1), "https://example.com": (False, True, 0), "https://example.com/a": (True, False, 1),
        "https://example.com/a.html#x": (True, False, 11), "news/acme-announces-deal/index.html?x=1": (True, True, 19),
        "/news/acme-stopped-trial/": (True, False, 18), "index.html": (False, True, 0), "": (False, False, 0),
        "a?x=/b": (False, False, 1),
    }
    flags = lambda u: F.struct(urls.url_flags(u)["multi_level_path"], urls.url_flags(u)["has_file_extension"], urls.slug_length(u))
    assert [tuple(r) for r in evaluate(spark, list(cases), flags)] == list(cases.values())


def test_subdomain_and_port(spark):
    values = ["https://www.a.com/", "https://a.com", "http://x.a.com:80/p", "www.a.com", "/a.b", "a:8"]
    assert evaluate(spark, values, lambda u: urls.url_flags(u)["has_subdomain"]) == [False, True, True, False, False, False]
    assert evaluate(spark, values, lambda u: urls.url_flags(u)["has_port"]) == [False, False, True, False, False, True]


def test_social(spark):
    cases = {"https://a.com/x.com": True, "http://www.x.com": True, "notfacebook.com/": True, "facebook.com?x=1": False,
             "https://WWW.LinkedIn.com/company/a": True, "https://youtube.com": True, "https://tiktok.company/": False,
             "https://facebook.com\n": True, "https://x.com/a": True, "https://max.com/": False}
    assert evaluate(spark, list(cases), urls.is_social) == list(cases.values())


def test_typical(spark):
    cases = [("/about", "", True), ("https://h.com/About/", "Read on", True), ("/about?x=1", "", False),
             ("/x", "About us", True), ("/x", "one two three about five", False), ("/x", "Aboutness", False),
             ("/x", "press-room", True), ("/x", "- Press kit", True), ("/x", "", False), ("/x", "a press b c", True)]
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, u string, t string, want boolean")
    got = frame.orderBy("i").select(urls.is_typical(F.col("u"), F.col("t"))).collect()
    assert [r[0] for r in got] == [c[2] for c in cases]
    assert evaluate(spark, ["/privacy-policy", "/privacy", "https://h/Terms_of_use/x", "/aboutx", "/careers"],
                    lambda u: urls.is_typical(u, mode="path")) == [True, False, True, False, True]


def test_verbs(spark):
    cases = {"/news/acme-announces-deal": True, "/acme-stoped-it": True, "/acme-stopped-it": False, "/announces": False,
             "/n/Acme_WON_prize": True, "/acme-announcing": False, "/acme.launch.html": False, "/launch-day/index.html": True,
             "index.html": False, "/acme-planed-x/": True, "/acme--/": False}
    assert evaluate(spark, list(cases), urls.has_verb) == list(cases.values())


def test_verb_table_matches_the_literals(spark):
    table = urls.verb_table(spark)
    assert {r.form for r in table.collect()} == set(urls.verb_forms())
    assert table.select("verb").distinct().count() == 52
    forms = {r.form for r in table.where("verb in ('take', 'close', 'enter', 'forms')").collect()}
    assert forms == {"take", "takes", "took", "close", "closes", "closed", "enter", "enters", "entered", "forms", "formss", "formsed"}


def test_absolute(spark):
    base = F.lit("https://h/news/")
    cases = {"/a": "https://h/news/a", "//cdn/x": "https://h/news/cdn/x", "httpx": "httpx", "b": "https://h/news/b"}
    assert evaluate(spark, list(cases), lambda u: urls.absolute_url(u, base)) == list(cases.values())


def test_absolute_rfc3986(spark):
    from urllib.parse import urljoin
    base = "http://a/b/c/d?q"
    links = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g;x", "", ".", "./", "..", "../", "../g", "../..",
             "../../", "../../g", "https://z/x", "g/./h", "g/../h"]
    got = evaluate(spark, links, lambda u: urls.absolute_url(u, F.lit(base), "rfc3986"))
    assert got == [urljoin(base, x) for x in links]
    assert evaluate(spark, ["?p=2", "x"], lambda u: urls.absolute_url(u, F.lit("https://h"), "rfc3986")) == ["https://h?p=2", "https://h/x"]


def test_link_filter(spark):
    cases = {"/": False, "": False, "#": False, "javascript:void(0)": False, "javascript:void(0);": True, "#a": False,
             "tel:1": False, "TEL:1": True, "mailto:x": False, "/a": True, "https://twitter.com/a": False}
    assert evaluate(spark, list(cases), urls.is_news_link) == list(cases.values())
