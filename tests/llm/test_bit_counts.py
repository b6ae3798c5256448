"""SimHash links by segment counts against all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import brute
from pressframe.llm import bit_counts
from pressframe.llm.common import Stages
from pressframe.llm.queries import QUERIES


def plain_fingerprint(text):
    words = brute.spaced(text)
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42) for i in range(len(words) - n + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest fingerprint reachable, by looking at all pairs."""
    prints = np.unique(np.array(prints, np.uint64))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    label = np.arange(len(prints))
    while True:
        low = np.where(near, label[None, :], len(prints)).min(1)
        if (low == label).all():
            return dict(zip(prints.tolist(), prints[label].tolist()))
        label = low


def test_documents(odd_docs, texts, no_docs):
    found = bit_counts.similar_fingerprints(odd_docs)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    prints = [plain_fingerprint(t) for _, t in texts]
    top = plain_components(prints)
    least = {}
    for (doc_id, _), fp in zip(texts, prints):
        if doc_id is not None:
            least[top[fp]] = min(doc_id, least.get(top[fp], doc_id))
    want = [(i, f"{fp:016x}", least.get(top[fp])) for (i, _), fp in zip(texts, prints)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert sum(w[0] != w[2] for w in want) > 10
    assert not bit_counts.similar_fingerprints(no_docs).count()


def test_query(spark):
    rows = QUERIES["op11_bit_counts"](spark, brute.SF).collect()
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    top, least = plain_components(list(prints.values())), {}
    for doc_id, fp in prints.items():
        least[top[fp]] = min(doc_id, least.get(top[fp], doc_id))
    assert sorted(map(tuple, rows)) == sorted((i, f"{fp:016x}", least[top[fp]]) for i, fp in prints.items())


def test_the_bound_holds():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 64, 2000, dtype=np.uint64) for _ in range(2))
    for width in (1, 2, 4, 8):
        counts = [bit_counts.segment_counts(x, width).astype(int) for x in (a, b)]
        apart = np.abs(counts[0] - counts[1]).sum(1)
        assert (apart == np.bitwise_count(bit_counts.stacked(a, width) ^ bit_counts.stacked(b, width))).all()
        assert (apart <= np.bitwise_count(a ^ b)).all()


def test_quarters_take_every_bit_once():
    for free in (-1 & (1 << 64) - 1, 0b1011, 1 << 63 | 7 << 20):
        parts = bit_counts._quarters(free)
        assert sum(parts) == free and len(parts) == 4


@pytest.mark.parametrize("width, crowded", [(2, 1024), (4, 16), (2, 16), (1, 16)])
def test_links_of_crowded_points(spark, width, crowded):
    """Random points, and points around a few that differ from it in bits at random or all in one half."""
    rng = np.random.default_rng(2)
    points = [*rng.integers(0, 1 << 64, 300, dtype=np.uint64).tolist()]
    for places in (range(0, 64, 4), range(32), range(50, 62)):
        centre = int(rng.integers(0, 1 << 64, dtype=np.uint64))
        for _ in range(300):
            flips = rng.choice(list(places), rng.integers(0, 8), replace=False)
            points.append(centre ^ sum(1 << int(i) for i in flips))
    points = sorted(set(points))
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in points], "fp long")
    stages = Stages(spark, "crowded")
    links = bit_counts.fingerprint_links(frame, stages, width, crowded)
    joined = {r.cid: r.comp for r in bit_counts.components(links, stages, "joined").collect()}
    want, groups = plain_components(points), {}
    for p in points:
        groups.setdefault(want[p], set()).add(p)
    signed = {p: int(np.uint64(p).view(np.int64)) for p in points}
    for group in groups.values():
        assert len({joined.get(signed[p], signed[p]) for p in group}) == 1
    assert len({joined.get(signed[p], signed[p]) for p in points}) == len(groups)
    assert links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 0).count() <= 40 * len(points)


def test_refused(odd_docs):
    for asked in ({"width": 5}, {"crowded": 3}):
        with pytest.raises(ValueError):
            bit_counts.similar_fingerprints(odd_docs, **asked)
