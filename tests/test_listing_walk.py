"""One walk over listing pages answers what the whole DOM answers."""

import random

from checks import templates as t
from pressframe.operators import links, navigation
from pressframe.plans import discovery
from pressframe.sources.dom import flatten_dom


def test_the_walk_keeps_what_is_asked(spark, pages_of):
    rng = random.Random(9)
    parts = [h for h, _ in t.LOAD_MORE] + [n[0] for n in t.NEXT] + [
        "<select><option>2024<option><b>2023</b></select>", "<div class='hidden'>", "</div>", "<p>", "<li>", "</li>", '<a href="/2024/p0/x-wins-y">n</a>', "<section><i class=more>"]
    pages = pages_of(*["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(250)])
    whole, walk = flatten_dom(pages).cache(), discovery.listing_nodes(pages)
    asks = [navigation.load_more_controls, navigation.next_controls, navigation.year_options, links.anchors]
    for ask in asks:
        found = [sorted(map(repr, ask(nodes).collect())) for nodes in (whole, walk)]
        assert found[0] == found[1] and len(found[0]) > 20


def test_following_a_crawl_reads_its_pages_once(spark):
    rows = [(1, "https://c.example.com/news/", 0, "2023", "<ul>" + "".join(f'<li><a href="/2023/p0/a-wins-{j}">D</a></li>' for j in range(5)) + "</ul>")]
    crawl = spark.createDataFrame(rows, "site_id long, base_url string, page_no int, year string, html string")
    plan = discovery.discover_crawl(crawl, follow=True)
    assert plan.count() == 5
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in text
