"""Grid places against a plain grid that is filled cell by cell."""

import random

from pressframe.operators import content
from pressframe.sources.dom import flatten_dom


def plain_places(rows):
    taken, out = set(), []
    for r, cells in enumerate(rows, 1):
        c = 1
        for down, wide in cells:
            while (r, c) in taken:
                c += 1
            out.append((r, c))
            taken |= {(r + i, c + j) for i in range(down or 40) for j in range(wide)}
            c += wide
    return out


def test_random_tables(spark, pages_of):
    rng = random.Random(6)
    tables = [[[(rng.choice([0, 1, 1, 1, 2, 3, 9]), rng.choice([1, 1, 1, 2, 3])) for _ in range(rng.randint(1, 5))] for _ in range(rng.randint(1, 9))] for _ in range(60)]
    htmls = ["<table>" + "".join("<tr>" + "".join(f'<td rowspan="{d}" colspan={w}>x</td>' for d, w in row) + "</tr>" for row in t) + "</table>" for t in tables]
    got = {}
    for r in content.table_grid(flatten_dom(pages_of(*htmls))).orderBy("page_id", "grid_row", "grid_col").collect():
        got.setdefault(r.page_id, []).append((r.grid_row, r.grid_col))
    assert [got[i] for i in range(len(tables))] == [sorted(plain_places(t)) for t in tables]


def test_many_wide_spans_take_no_time(spark, pages_of):
    html = "<table>" + ("<tr>" + '<td rowspan="65534" colspan="1000">x</td>' * 3 + "</tr>") * 400 + "</table>"
    assert content.table_grid(flatten_dom(pages_of(html))).agg({"grid_col": "max"}).first()[0] == 400 * 3000 - 999
