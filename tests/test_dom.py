import random

from pyspark.sql import functions as F

from pressframe.operators import tree
from pressframe.sources.dom import flatten_dom
from pressframe.sources.pages import page_errors, write_dom_table


def rows(spark, pages_of, html):
    return flatten_dom(pages_of(html)).orderBy("pos").collect()


def shape(nodes):
    return [(r.pos, r.end_pos, r.parent, r.kind, r.tag or r.text) for r in nodes]


def test_unclosed_tags_nest(spark, pages_of):
    got = rows(spark, pages_of, "<p>a<b>b<p>c</b>d</p>e")
    assert shape(got) == [(1, 7, 0, "E", "p"), (2, 2, 1, "T", "a"), (3, 6, 1, "E", "b"), (4, 4, 3, "T", "b"),
                          (5, 6, 3, "E", "p"), (6, 6, 5, "T", "c"), (7, 7, 1, "T", "d"), (8, 8, 0, "T", "e")]


def test_void_and_stray_tags(spark, pages_of):
    got = rows(spark, pages_of, "<br>a</i><img src=x><br/>b</br><p/>c")
    assert [(r.kind, r.tag or r.text, r.parent) for r in got] == [
        ("E", "br", 0), ("T", "a", 0), ("E", "img", 0), ("E", "br", 0), ("T", "b", 0), ("E", "p", 0), ("T", "c", 0)]


def test_string_kinds_numbers_and_lengths(spark, pages_of):
    html = ("<!DOCTYPE html><div> <!--c--><script>s<b></script><style>y</style><template><i>t</i></template>"
            "<?pi?> x&amp;y&#151;&nope; </div>")
    got = rows(spark, pages_of, html)
    assert [(r.kind, r.text) for r in got if r.kind != "E"] == [
        ("D", "html"), ("T", " "), ("C", "c"), ("S", "s<b>"), ("Y", "y"), ("X", "t"), ("P", "pi?"), ("T", " x&y—&nope ")]
    assert [r.seq for r in got if r.kind != "E"] == [1, None, 2, 3, 4, 5, 6, 7]
    div = next(r for r in got if r.tag == "div")
    assert div.text_len == len("x&y—&nope") and div.node_idx == 1
    assert [r.node_idx for r in got if r.node_idx is not None] == list(range(12))


def test_attributes(spark, pages_of):
    got = rows(spark, pages_of, '<a CLASS=" x  y " href="/a" href="/b?x=1&amp;y=2" hidden id="i"><b>t</b></a>')[0]
    assert got.attrs == {"class": "x y", "href": "/b?x=1&y=2", "hidden": "", "id": "i"}
    assert (got.text, got.anc_flex, got.anc_strict) == ("t", "[document]", "[document]")


def test_ancestor_paths(spark, pages_of):
    html = '<html><body id="m" class="a b"><ul id=""><li class="">x<a href="/1">t</a></li></ul></body></html>'
    link = [r for r in rows(spark, pages_of, html) if r.tag == "a"][0]
    assert link.anc_flex == "[document] > html > body > ul > li"
    assert link.anc_strict == "[document] > html > body#m.a.b > ul > li"


def test_bad_pages_become_errors(spark, pages_of):
    pages = pages_of("<p>x</p>", None, "")
    got = page_errors(flatten_dom(pages), pages).collect()
    assert [(r.page_id, r.stage, r.error) for r in got] == [(1, "dom", "page has no html")]


def random_html(rng):
    tags = ["div", "p", "span", "b", "ul", "li", "table", "section"]
    out = []
    for _ in range(rng.randint(1, 60)):
        kind = rng.random()
        tag = rng.choice(tags)
        out.append(f"<{tag}>" if kind < 0.45 else f"</{tag}>" if kind < 0.8 else rng.choice([" ", "word", "two words ", "<br>"]))
    return "".join(out)


def test_windows_agree_with_brute_force(spark, pages_of):
    rng = random.Random(3)
    htmls = [random_html(rng) for _ in range(60)]
    nodes = flatten_dom(pages_of(*htmls)).cache()
    hit = F.coalesce(F.col("tag").isin("span", "b"), F.lit(False))
    got = {(r.page_id, r.pos): (r.up, r.down) for r in
           nodes.withColumn("up", tree.inside(hit)).withColumn("down", tree.holds(hit)).collect()}
    plain = [r.asDict() for r in nodes.collect()]
    by_page = {}
    for r in plain:
        by_page.setdefault(r["page_id"], []).append(r)
    for page, items in by_page.items():
        hits = [r for r in items if r["tag"] in ("span", "b")]
        for r in items:
            up = any(h["pos"] < r["pos"] <= h["end_pos"] for h in hits)
            down = any(r["pos"] < h["pos"] <= r["end_pos"] for h in hits)
            assert got[(page, r["pos"])] == (up, down)
            # intervals agree with parents, lengths with the text below
            assert all(r["pos"] < c["pos"] <= r["end_pos"] for c in items if c["parent"] == r["pos"])
            below = "".join((c["text"] or "").strip() for c in items if c["kind"] == "T" and r["pos"] <= c["pos"] <= r["end_pos"])
            assert r["text_len"] == len(below)
    targets = nodes.where("kind = 'E'").select("page_id", F.col("pos").alias("t_pos"), F.col("end_pos").alias("t_end"))
    texts = {(r.page_id, r.t_pos): r.subtree for r in tree.subtree_text(nodes, targets, raw=True).collect()}
    for page, items in by_page.items():
        for r in items:
            below = "".join(c["text"] for c in items if c["kind"] == "T" and r["pos"] < c["pos"] <= r["end_pos"])
            if r["kind"] == "E" and below:
                assert texts[(page, r["pos"])] == below


def test_hidden_looks_three_levels_up(spark, pages_of):
    def page(levels, mark):
        return f"<div {mark}>" + "<i>" * levels + '<a href="/x">x</a>' + "</i>" * levels + '</div><a href="/y">y</a>'
    marks = ['style="display: none"', 'class="a is-HIDDEN"', 'style="display:block"']
    htmls = [page(n, m) for m in marks for n in (0, 2, 3)] + ['<a href="/x" style="display:none">x</a>', "<div class=hidden></div><a href=/x>x</a>"]
    link = (F.col("tag") == "a") & F.col("attrs.href").isNotNull()
    got = {(r.page_id, r.attrs["href"]): r.hidden for r in tree.with_hidden(flatten_dom(pages_of(*htmls)), link).collect()}
    for i, (mark, n) in enumerate((m, n) for m in marks for n in (0, 2, 3)):
        assert got[(i, "/x")] == (mark != marks[2] and n < 3) and not got[(i, "/y")]
    assert got[(9, "/x")] and not got[(10, "/x")]


def test_bucketed_table_needs_no_exchange(spark, pages_of):
    table = write_dom_table(flatten_dom(pages_of("<p>a</p>", "<div><b>c</b></div>")), "dom_bucketed", 4)
    asked = table.withColumn("in_p", tree.inside(F.col("tag") == "p")).groupBy("page_id").agg(F.count_if("in_p").alias("n"))
    assert "Exchange" not in asked._jdf.queryExecution().executedPlan().toString()
    assert {r.page_id: r.n for r in asked.collect()} == {0: 1, 1: 0}


def test_dates_over_a_bucketed_table_move_no_page_text(spark, pages_of):
    """On a table bucketed by page the text side of the containment join stays where it is."""
    from pressframe.operators.dates import text_date_candidates

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = write_dom_table(flatten_dom(pages_of("<p><i>pub</i>lished 2020-01-02</p>", "<p>2019-03-04</p>")), "dom_dates", 4)
        found = text_date_candidates(table)
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text
        assert {(r.page_id, str(r.day), r.score) for r in found.collect()} == {(0, "2020-01-02", 5), (1, "2019-03-04", 0)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
