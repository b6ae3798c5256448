"""The page reader: character sets, and output in proportion to the page."""

import pyarrow as pa
import pytest

from pressframe.functions.urls import is_typical
from pressframe.sources import dom
from pressframe.sources.dom import decode_page, flatten_dom


@pytest.mark.parametrize("data, sent, text", [
    (b"\xef\xbb\xbfa\xff", "latin1", "a\ufffd"), ("é".encode("utf-16-be"), None, "\x00é".encode("latin-1").decode("utf-8", "ignore")),
    (b"\xfe\xff" + "é".encode("utf-16-be"), None, "é"), (b"\xe9\x80\x81", "ISO-8859-1", "é€\x81"), (b"\xe9", "us-ascii", "é"),
    (b"\xe9", "x-nothing", "é"), ("é".encode(), "base64", "é"), ("é".encode(), "utf-7", "é"), ("ж".encode("koi8-r"), " KOI8-R ", "ж"),
    (b"<meta charset=utf-8>\xe9", None, "<meta charset=utf-8>\ufffd"), (b"<META x charset = 'cp1251'>\xe9", None, "<META x charset = 'cp1251'>й"),
    (b" " * 1100 + b"<meta charset=koi8-r>\xe9", None, " " * 1100 + "<meta charset=koi8-r>é"), (b"", None, ""), (b"\x80", "", "€"),
    ("漢".encode("shift_jis"), "Shift_JIS", "漢"),
])
def test_character_sets(data, sent, text):
    if data == "é".encode("utf-16-be"):
        text = "\x00é"  # no mark, no UTF-8: windows-1252
    assert decode_page(data, sent) == text


def test_charset_column(spark):
    pages = spark.createDataFrame([(1, bytearray(b"<p>\xd6</p>"), "koi8-r"), (2, bytearray(b"<p>\xd6</p>"), None)], "page_id long, html binary, charset string")
    assert [(r.page_id, r.text) for r in flatten_dom(pages).where("kind = 'T'").orderBy("page_id").collect()] == [(1, "ж"), (2, "Ö")]


def test_bad_bytes_in_ids_and_texts(spark):
    pages = spark.sql("select cast(X'61ff' as string) as page_id, cast(X'3c703e62ff3c2f703e' as string) as html union all select 'b', null")
    got = flatten_dom(pages).selectExpr("cast(page_id as binary) as id", "kind", "text").orderBy("id", "kind").collect()
    assert [(bytes(r.id), r.kind, r.text) for r in got] == [(b"a\xff", "E", None), (b"a\xff", "T", "b\ufffd"), (b"b", "R", "page has no html")]


def output_of(html):
    nodes = dom._PageReader().read(html)
    for n in nodes:
        n.size = dom._emitted(n)
    return sum(b.nbytes for b in dom._in_batches([(0, n) for n in nodes], pa.array([1])))


@pytest.mark.parametrize("piece", ['<a href="/x">w ', '<a href="/x">w', "<h1>t ", '<span class="author">by ', '<p class="a b"><a href="x">t', "<template><b>x",
                                   "<!--a", "<!--a>", "</a", "<a", "<?x", "<![CDATA[x>", "<![if x>", '<a b="x>', "<b><!x"])
def test_output_is_in_proportion_to_the_page(piece):
    small, large = (output_of(piece * n) for n in (4000, 8000))
    assert large < 2.3 * small


def test_a_long_class_is_not_repeated_by_every_string():
    assert output_of('<div class="%s">' % ("c" * 50_000) + "a<br>" * 5000) < 30_000_000


def test_long_paths_stay_apart():
    inner = "".join(f'<div id="a{i}">' for i in range(300))
    nodes = dom._PageReader().read(f'{inner}<a href="/1">x</a><a href="/2">y</a><b><a href="/3">z</a></b><div id="q"><a href="/4">z</a>')
    flex, strict = zip(*[dom._paths(n) for n in nodes if n.tag == "a"])
    assert flex[0] == flex[1] and strict[0] == strict[1] and len(set(flex)) == len(set(strict)) == 3
    assert all(len(p) < 300 and p.startswith("[document] > div") for p in flex + strict)
    assert len({dom._paths(n)[0] for n in dom._PageReader().read("<i>" * 2000 + '<a href=x>') if n.tag == "a"}) == 1


def test_long_texts_count_as_many_words(spark):
    """Whether a link is a usual section is told from the text that is kept as from the whole."""
    long = "w" * 1500
    texts = ["press " + long, "press " + long + " a b", "press " + long + " a b c", long + " about", long + " a b about", long + "-a-b-c-about",
             "press " + "a " * 600, "x" * 998 + " press", "x" * 1004 + " press", "x" * 994 + " press" + "y" * 50, "x" * 994 + " press" + "y" * 200, "about " + long * 3 + " y " + long]
    nodes = dom._PageReader().read("".join(f'<a href="/n">{t}</a>' for t in texts))
    kept = [n.text for n in nodes if n.tag == "a"]
    assert all(len(k) <= 1700 for k in kept) and [n.length for n in nodes if n.tag == "a"] == [len(t.strip()) for t in texts]
    frame = spark.createDataFrame([("/n", t.strip(), k) for t, k in zip(texts, kept)], "href string, whole string, kept string")
    got = frame.select(is_typical(frame.href, frame.whole).alias("a"), is_typical(frame.href, frame.kept).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and {r.a for r in got} == {True, False}
