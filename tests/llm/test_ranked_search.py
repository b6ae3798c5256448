"""Ranked search against a plain scorer, and the bounds that keep its sums exact."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import brute
from pressframe.llm import ranked_search
from pressframe.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate(brute.TO_LOWER))


def plain_search(texts, items, top=20):
    docs = [(i, Counter(w), len(w)) for i, w in ((i, terms_of(t)) for i, t in texts) if w]
    n_docs, n_terms, df = len(docs), sum(n for *_, n in docs), Counter(t for _, c, _ in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in set(items):
        wanted, scored = Counter(terms_of(text)), []
        for doc_id, counts, n in docs:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(q * weight[t] * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m)) for t, q in wanted.items() if t in counts)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd_items(spark, items):
    first = items.first().text
    return items.union(spark.createDataFrame(
        [(9001, "one two"), (9002, None), (None, "漢字 one"), (9003, " .,"), (9001, "one two"), (9001, "x"), (9004, first + " " + first), (9005, "unheardof")], items.schema))


@pytest.mark.parametrize("small", [{}, {"tile_docs": 7, "tile_terms": 5, "block_bytes": 4000, "top": 3}])
def test_odd_rows(odd_docs, texts, odd_items, no_docs, small):
    found = ranked_search.search(odd_docs, odd_items, **small)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    want = plain_search(texts, [tuple(r) for r in odd_items.select("item_id", "text").collect()], small.get("top", 20))
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert not ranked_search.search(no_docs, odd_items, **small).count()
    assert not ranked_search.search(odd_docs, odd_items.where("false"), **small).count()


def test_equal_scores_rank_by_id(spark):
    docs = spark.createDataFrame([(i, "alpha beta") for i in range(400, 0, -1)] + [(1000 + i, "gamma") for i in range(50)] + [(None, "alpha beta")],
                                 "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, "beta"), (2, "beta gamma")], "item_id long, text string")
    got = sorted(tuple(r) for r in ranked_search.search(docs, items, tile_docs=16).collect())
    assert [r[2] for r in got if r[0] == 1] == list(range(1, 21))
    assert [r[2] for r in got if r[0] == 2] == list(range(1000, 1020)) and len({r[3] for r in got if r[0] == 2}) == 1


def test_repeated_terms_stay_exact():
    """Counts far above a digit of a tile's bound, against whole numbers of any size."""
    rows = pa.table({"item_id": [1, 1, 2], "th": [0, 0, 0], "term": [5, 9, 9], "q": [10**7, 3, 12345678]})
    block = ranked_search.ItemBlock(rows)
    weights = np.array([27000, 26999])
    found = ranked_search._Multiplier(block, weights, 10**6, 10**9, 1024)
    assert len(found.digits) >= 3
    assert (found.base - 1) * 1024 * 27000 * 10**6 < 2**53
    n, tf = np.array([77, 12]), np.array([50, 1, 7])
    got = found.scores(n, np.array([0, 0, 1]), np.array([0, 1, 1]), tf)
    m = [75 + 25 * int(x) * 10**6 // 10**9 for x in n]
    value = {(0, 0): 27000 * (50 * 10**9 // (50000 + 12 * m[0])), (0, 1): 26999 * (10**9 // (1000 + 12 * m[0])), (1, 1): 26999 * (7 * 10**9 // (7000 + 12 * m[1]))}
    assert got.tolist() == [[10**7 * value[0, 0] + 3 * value[0, 1], 12345678 * value[0, 1]], [3 * value[1, 1], 12345678 * value[1, 1]]]
    with pytest.raises(ValueError):
        ranked_search.digit_base(30000, 1 << 19)


def test_query_gives_its_oracle(spark):
    from checks.compare import connect, difference

    rows, found = difference(spark, connect(brute.SF), QUERIES["op12_ranked_search"], ORACLES["op12_ranked_search"], brute.SF)
    assert found is None and rows == 800
