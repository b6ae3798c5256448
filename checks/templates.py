"""Input templates: SQL that Spark and DuckDB both run over the given tables.

A template spells out page parts as plain columns.  Spark joins the parts to HTML and must find
them again through the operators; the oracle works on the same parts directly.  A page holds at
most 40 orders (or one customer, one part), so pages grow in number, not in size.
"""

PAGE_OF_ORDER = "CAST((o_orderkey - o_orderkey % 40) / 40 AS BIGINT)"

# Links of listing pages: page variant v = page_id % 10 decides which rule of the ranking bites.
ANCHORS = f"""
SELECT page_id, pos, v,
  CASE WHEN r = 0 THEN '[document] > html > body > nav'
       WHEN r = 1 THEN '[document] > html > body > footer'
       WHEN r = 4 THEN '[document] > html > body > aside > ul > li'
       WHEN r = 3 AND v = 8 THEN '[document] > html > body > section > ul > li'
       ELSE '[document] > html > body > main > ul > li' END AS anc_flex,
  CASE WHEN r = 0 THEN '[document] > html > body > nav'
       WHEN r = 1 THEN '[document] > html > body > footer'
       WHEN r = 4 THEN '[document] > html > body > aside > ul > li'
       WHEN r = 3 AND v = 8 THEN '[document] > html > body > section > ul > li'
       WHEN pos % 2 = 0 THEN '[document] > html > body > main#news > ul > li.item.even'
       ELSE '[document] > html > body > main#news > ul > li.item' END AS anc_strict,
  CASE WHEN r = 0 THEN CASE pos % 4 WHEN 0 THEN '/about' WHEN 1 THEN '/careers/' WHEN 2 THEN 'https://www.linkedin.com/company/x' ELSE '#top' END
       WHEN r = 1 THEN CASE pos % 4 WHEN 0 THEN '/about' WHEN 1 THEN 'mailto:ir@example.com' WHEN 2 THEN '/privacy' ELSE 'tel:+1' END
       WHEN v = 0 THEN '/news/fixed-item-' || CAST(pos % 7 AS STRING)
       WHEN v = 8 THEN '/news/acme-opens-site-' || CAST(100000 + pos % 89999 AS STRING)
       WHEN r = 4 AND v < 3 THEN '/insights/very-long-topic-slug-number-' || CAST(pos AS STRING)
       WHEN r = 4 AND v = 3 THEN 'https://host.example.com/?id=' || CAST(pos AS STRING)
       WHEN r = 4 AND v = 4 THEN '/ir/acme-announces-a-much-longer-headline-' || CAST(pos AS STRING)
       WHEN r = 4 THEN 'https://host.example.com/ir/' || CAST(pos AS STRING) || '.html#top'
       ELSE '/news/2024/acme-' || CASE pos % 3 WHEN 0 THEN 'announces' WHEN 1 THEN 'quarterly' ELSE 'launched' END
            || '-item-' || CAST(pos AS STRING) || CASE WHEN pos % 11 = 0 THEN '?ref=x' ELSE '' END END AS href,
  CASE WHEN r < 2 THEN 'About us' WHEN v = 9 AND pos % 40 = 2 THEN 'Press - room' ELSE 'Item ' || o_orderpriority END AS text,
  v = 5 AND pos % 10 < 8 AS hides
FROM (SELECT {PAGE_OF_ORDER} AS page_id, {PAGE_OF_ORDER} % 10 AS v, o_orderkey AS pos, o_orderkey % 5 AS r,
             o_orderpriority FROM orders)
"""

# Lines of text with their enclosing element.
TEXT_NODES = f"""
SELECT {PAGE_OF_ORDER} AS page_id, o_orderkey AS pos,
  CASE o_orderkey % 38 WHEN 30 THEN 'Forward-Looking Statements' WHEN 31 THEN 'About Acme' WHEN 32 THEN 'About Acme, Inc.'
    WHEN 3 THEN 'Copyright 2024 Acme. All rights reserved.' WHEN 4 THEN 'Published ' || CAST(CAST(o_orderdate AS DATE) AS STRING)
    WHEN 35 THEN 'Acme''s Safe Harbor Statement' WHEN 6 THEN 'On 13/13/2024 and 3/4/21 we met' WHEN 7 THEN 'Sept 5, 2023'
    WHEN 8 THEN 'Mayor 12, 2020' WHEN 9 THEN 'due 2099-01-01' WHEN 10 THEN 'on 31/12/98 and Marching Mar 3 2011'
    WHEN 11 THEN 'Contact us about forward-looking statements' WHEN 12 THEN 'see 2023-02-30, 4/31/2020, Feb 7, 1999'
    WHEN 13 THEN 'The safe  harbor statements follow' ELSE 'Body line ' || o_orderpriority END AS text,
  CASE o_orderkey % 5 WHEN 0 THEN 'b' WHEN 1 THEN 'strong' ELSE 'p' END AS parent_tag,
  CASE o_orderkey % 3 WHEN 0 THEN 'news-date' WHEN 1 THEN 'Bold-lead' ELSE '' END AS parent_class,
  CASE WHEN o_orderkey % 6 = 0 THEN 'color:red; Font-Weight: bold' ELSE '' END AS parent_style
FROM orders
"""

# Article pages, one per customer.  Every *_html column is one piece of the page.
ARTICLES = """
SELECT k AS page_id, 'https://ir.example.com/story/' || CAST(k AS STRING) AS url, name, seg, k,
  CASE WHEN k % 2 = 0 THEN 'OG title of ' || name || CASE WHEN k % 6 = 0 THEN repeat('x', 200) ELSE '' END END AS og,
  CASE WHEN k % 3 = 0 AND k % 9 <> 0 THEN 'Headline ' || name || CASE WHEN k % 12 = 0 THEN ' with a long tail' ELSE '' END END AS ld_title,
  CASE WHEN k % 3 = 0 AND k % 9 <> 0 THEN 'March ' || CAST(k % 28 + 1 AS STRING) || ', 2021' END AS ld_date,
  CASE WHEN k % 5 <> 4 THEN 'Story ' || name || ' ' || seg END AS story,
  CASE WHEN k % 5 = 4 OR k % 7 = 0 THEN 'Loose heading ' || CAST(k AS STRING) END AS loose_h1,
  CASE WHEN k % 8 = 0 THEN 'soon' WHEN k % 4 = 0 THEN '2024-0' || CAST(k % 9 + 1 AS STRING) || '-1' || CAST(k % 10 AS STRING) || 'T10:30:00+02:00' END AS meta_date,
  CASE WHEN k % 8 = 0 THEN '2023-0' || CAST(k % 9 + 1 AS STRING) || '-2' || CAST(k % 8 AS STRING) END AS og_date,
  CASE k % 11 WHEN 0 THEN '<p>On 3/4/21 it began.</p><p>Published 2022-01-05 by the desk</p>'
    WHEN 1 THEN '<p>Made on 13/2/2021 here</p>' WHEN 2 THEN '<p>Mayor 12, 2020</p>' WHEN 3 THEN '<p>Sept 5, 2023</p>'
    WHEN 4 THEN '<p>due 2099-01-01</p>' WHEN 5 THEN '<p>2018-01-01</p><p><span class="news-date">7/8/2020</span></p>'
    WHEN 6 THEN '<p>2016-01-01</p><p><b>Pub</b>lished 2017-06-05</p>' ELSE '' END AS dates_html,
  CASE k % 11 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN 2 WHEN 6 THEN 3 ELSE 0 END AS dates_n,
  CASE k % 11 WHEN 0 THEN '2022-01-05' WHEN 1 THEN '2021-02-13' WHEN 3 THEN '2023-09-05' WHEN 5 THEN '2020-07-08' WHEN 6 THEN '2017-06-05' END AS text_date,
  CASE WHEN k % 13 = 0 THEN 0 ELSE k % 4 + 1 END AS author_method,
  CASE WHEN k % 3 = 1 THEN 'alpha, beta,,' || seg END AS keywords_text,
  CASE WHEN k % 5 = 2 THEN seg END AS category,
  '<p>Opening line ' || name || '.</p>' AS opening_html,
  CASE WHEN k % 2 = 1 THEN '<p>Contact us for more</p>' ELSE '' END AS boiler_html,
  '<ul><li>Point one</li><li>Point two <b>bold</b></li></ul>' AS list_html,
  '<div>loose words</div>' AS loose_html,
  CASE WHEN k % 6 = 1 THEN '<table><tr><th>Name</th><th></th></tr><tr><td>' || name || '</td><td> </td></tr></table>'
       WHEN k % 6 = 2 THEN '<table><tr><td> </td></tr></table>' ELSE '' END AS table_html,
  CASE k % 7 WHEN 0 THEN '<p>About Acme</p>' WHEN 1 THEN '<p><b>About Acme, Inc.</b></p>' WHEN 2 THEN '<p class="bold-lead">About Acme, Inc.</p>'
    WHEN 3 THEN '<p>About Acme, Inc.</p>' WHEN 4 THEN '<p>Acme''s Safe Harbor Statement</p>' ELSE '' END AS header_html,
  k % 7 IN (0, 1, 2, 4) AS is_cut,
  '<p>After text</p><table><tr><td>late</td></tr></table>' AS after_html
FROM (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS seg FROM customer)
"""

# Pages to test tree questions, one per part: n spans around a link, hidden at the top or not.
TREES = """
SELECT p_partkey AS page_id, CAST(p_size % 6 AS BIGINT) AS n,
  CASE p_partkey % 4 WHEN 0 THEN '<div style="color:red; display: none">' WHEN 1 THEN '<div class="Is-Hidden x">'
       WHEN 2 THEN '<div style="DISPLAY:none">' ELSE '<div>' END AS outer_html,
  p_partkey % 4 < 2 AS outer_hides, p_name, p_brand
FROM part
"""

# Listing controls, one page per part: load-more variant and next-link variant by key.
LOAD_MORE = [  # (page part, rule it meets first, order of the element among the page's elements)
    ("<ul><li>More News</li></ul>", 1), ("<ul><li>Load More</li></ul>", 2), ("<button>Load More</button>", 3),
    ("<button>Show More</button>", 4), ("<a href=\"#\">Show More</a>", 5), ("<a href=\"#\">Load More</a>", 6),
    ("<span>Load More</span>", 7), ("<div>Load More</div>", 8), ("<div class=\"x load-more\">y</div>", 9),
    ("<div class=\"loadMore\">y</div>", 10), ("<button class=\"more\">y</button>", 11),
    ("<a href=\"#\" class=\"load-more\">y</a>", 13), ("<a href=\"#\" class=\"loadMore\">y</a>", 14),
    ("<button id=\"load-more\">y</button>", 15), ("<button id=\"loadMore\">y</button>", 16),
    ("<div id=\"load-more\">y</div>", 17), ("<button>View More</button>", 18), ("<a href=\"#\">View More</a>", 19),
    ("<button>See More</button>", 20), ("<a href=\"#\">See More</a>", 21),
    ("<button>y<i class=\"more\"></i></button>", 22), ("<button>Learn More</button>", 22),
    ("<p aria-label=\"Load more\">y</p>", 24), ("<p aria-label=\"Show more\">y</p>", 25),
    ("<button>y <b>Load More</b></button>", 0), ("<div>y<!-- c -->Load More</div>", 0), ("<p>Load More</p>", 0),
    ("<span>Load More</span><button class=\"more\">y</button>", 7),
]
NEXT = [  # (page part, rule, href)
    ("<ul><li class=\"PAGEr NEXT\"><a href=\"?page=2\">n</a></li></ul>", 1, "?page=2"),
    ("<ul><li class=\"pager next\"><button>n</button><a href=\"?page=2\">n</a></li></ul>", 1, None),
    ("<ul><li><a href=\"/p/2\"><span class=\"glyphicon-menu-right\"></span></a></li></ul>", 2, "/p/2"),
    ("<ul><li><a href=\"/p/3\"><span class=\"arrow-right\"></span></a></li></ul>", 3, "/p/3"),
    ("<ul><li><a href=\"/p/4\"><i class=\"fa fa-arrow-right\"></i></a></li></ul>", 4, "/p/4"),
    ("<ul><li><a href=\"/p/5\"><b><span class=\"sr-only\">Next</span></b></a></li></ul>", 5, "/p/5"),
    ("<ul><li><a href=\"/p/6\"><span aria-label=\"Next\">x</span></a></li></ul>", 6, "/p/6"),
    ("<ul><li><a href=\"?page=7\"><b class=\"right\">x</b></a></li></ul>", 7, "?page=7"),
    ("<ul><li><a href=\"?page=8\" rel=\"next\">x</a></li></ul>", 8, "?page=8"),
    ("<ul><li class=\"pager next\">n</li><li><a href=\"?page=9\" aria-label=\"Next\">x</a></li></ul>", 8, "?page=9"),
    ("<a href=\"?page=9\" rel=\"next\">x</a>", 0, None),
]


def _case(key: str, values: list[str]) -> str:
    lines = " ".join("WHEN {} THEN '{}'".format(i, v.replace("'", "''")) for i, v in enumerate(values))
    return f"CASE {key} {lines} END"


CONTROLS = f"""
SELECT p_partkey AS page_id, 'https://news.example.com/list/' || CAST(p_partkey AS STRING) || '?page=1' AS url,
  CAST(p_partkey % {len(LOAD_MORE)} AS BIGINT) AS more_case, CAST(p_partkey % {len(NEXT)} AS BIGINT) AS next_case,
  {_case(f"p_partkey % {len(LOAD_MORE)}", [h for h, _ in LOAD_MORE])} AS more_html,
  {_case(f"p_partkey % {len(NEXT)}", [n[0] for n in NEXT])} AS next_html
FROM part
"""

# Year selectors, one page per part: n_years year options, n_other others, perhaps one with "all".
YEARS = """
SELECT p_partkey AS page_id, CAST(p_partkey % 10 AS BIGINT) AS n_years, CAST(p_size % 4 AS BIGINT) AS n_other,
  p_partkey % 3 = 0 AS has_all, p_partkey % 2 = 0 AS decoy
FROM part
"""

# Crawls: six listing pages per site, three years with two pages each.
# Slots: three pages of 2023, the second landed twice; two pages under words; one without a year; 2022 with a hole.
ODD_CRAWL = """
SELECT CAST((o_orderkey - o_orderkey % 9) / 9 AS BIGINT) AS site_id,
  'https://c' || CAST(CAST((o_orderkey - o_orderkey % 9) / 9 AS BIGINT) AS STRING) || '.example.com/news/' AS base_url,
  CASE WHEN o_orderkey % 9 < 4 THEN '2023' WHEN o_orderkey % 9 = 4 THEN 'Older' WHEN o_orderkey % 9 = 5 THEN 'Archive' WHEN o_orderkey % 9 > 6 THEN '2022' END AS year,
  CAST(CASE o_orderkey % 9 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 8 THEN 2 ELSE 0 END AS INT) AS page_no,
  CAST(o_orderkey % 9 AS INT) AS slot,
  o_orderkey % 9 = 0 AND CAST((o_orderkey - o_orderkey % 9) / 9 AS BIGINT) % 2 = 0 OR o_orderkey % 9 IN (1, 2, 7) AS has_control
FROM orders
"""
CRAWL = """
SELECT CAST((o_orderkey - o_orderkey % 6) / 6 AS BIGINT) AS site_id,
  'https://c' || CAST(CAST((o_orderkey - o_orderkey % 6) / 6 AS BIGINT) AS STRING) || '.example.com/news/' AS base_url,
  CAST(2021 + CAST(FLOOR((o_orderkey % 6) / 2.0) AS INT) AS STRING) AS year, CAST(o_orderkey % 2 AS INT) AS page_no,
  CAST((o_orderkey - o_orderkey % 6) / 6 AS BIGINT) % 4 = 1 AND o_orderkey % 6 = 2 AS client_side,
  CAST((o_orderkey - o_orderkey % 6) / 6 AS BIGINT) % 4 = 2 AND o_orderkey % 2 = 1 AS is_empty
FROM orders
"""
