"""Near duplicates by a chosen-path set similarity join.

Each distinct shingle set is one class.  In every one of several independent trees a set walks from
the root by its minwise token of each level; sets that share the path stay in one node.  Small
nodes are compared exhaustively, larger ones branch on.  Two sets of similarity s share a node of depth d
with chance s^d, so the number of trees sets the recall.  Candidates are confirmed on full sets taken from the texts.

Groups of near copies never fall apart however deep a tree gets.  They are linked first, each
block of a node to one leader and the leaders to one of theirs: as many candidates as sets, not as many as
pairs.  The exhaustive comparison then skips nodes that are one component already, and within a node gives only
links that join components, which loses none between them: pairs are looked at inside tasks and never become rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .bytewords import Words, mix, not_space, run_hashes, signed, slices
from .common import Stages, row_keys, text_bytes
from .filters import bit_filter, passes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES, DEPTH, COMPARE_FROM = 20, 3, 2
#: Nodes up to this size are compared exhaustively.
SMALL = 64
#: Larger ones that no depth splits are compared in blocks of about this many.
BLOCK = 256
#: A pair at the least similarity may miss all trees with one chance, and have too few equal tokens to be confirmed with the other.
MISS_TREES, MISS_TOKENS = 2e-5, 1e-5
#: Below this similarity a text would need many hundred tokens.
LEAST_PERCENT = 50


def trees_for(percent: int) -> int:
    """Trees that a pair of this similarity misses altogether with a chance of at most ``MISS_TREES``; ``TREES`` at least."""
    shared = (percent / 100) ** DEPTH
    return TREES if shared >= 1 else max(TREES, math.ceil(math.log(MISS_TREES) / math.log1p(-shared)))


def least_equal(percent: int, tokens: int) -> int:
    """Of so many minwise tokens, how many a pair of this similarity shares but for a chance of at most ``MISS_TOKENS``."""
    same, below = percent / 100, 0.0
    for k in range(tokens + 1):
        below += math.comb(tokens, k) * same ** k * (1 - same) ** (tokens - k)
        if below > MISS_TOKENS:
            return k
    return tokens


def _seeds(tokens: int) -> np.ndarray:
    return np.random.default_rng(4242).integers(1, 1 << 63, (tokens, 2), dtype=np.uint64) | np.uint64(1)


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, q: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text of a slice, sorted; fewer words than ``q`` are one shingle."""
    w = Words(data, offsets, not_space())
    at, h = w.shingles(q)
    doc = w.doc[at]
    first = np.concatenate([[0], np.cumsum(w.counts)[:-1]]) if w.n_docs else np.zeros(0, np.int64)
    for n in range(1, q):
        short = np.flatnonzero(w.counts == n)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, run_hashes(w.hash, first[short], n)])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def signatures(docs: DataFrame, q: int = 5, trees: int = TREES) -> DataFrame:
    """``did, th, doc_id, n_shingles, set_one, set_two, tokens``: set size, set hash and minwise tokens of each text.

    ``tokens`` holds one 32-bit minimum for each level of each tree, and is null without words.
    """
    seeds = _seeds(trees * DEPTH)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(3)):
                n = end - row
                doc, h = distinct_shingles(data, offsets, q)
                size = np.bincount(doc, minlength=n)
                has = np.flatnonzero(size)
                tokens, sums = np.zeros((n, len(seeds)), np.uint32), np.zeros((2, n), np.uint64)
                if len(has):
                    first = np.searchsorted(doc, has)
                    for k, (a, b) in enumerate(seeds):
                        tokens[has, k] = np.minimum.reduceat(((h ^ a) * b) >> np.uint64(32), first)
                    sums[0, has] = np.add.reduceat(mix(h), first)
                    sums[1, has] = np.add.reduceat(mix(h + np.uint64(1)), first)
                flat = tokens.astype("<u4").tobytes()
                width = 4 * len(seeds)
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(size.astype(np.int64)), pa.array(signed(sums[0])), pa.array(signed(sums[1])),
                     pa.array([flat[i * width:(i + 1) * width] if size[i] else None for i in range(n)], pa.binary())],
                    names=["did", "th", "doc_id", "n_shingles", "set_one", "set_two", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*row_keys(), "doc_id", text_bytes().alias("__bytes")).mapInArrow(
        stage, f"did long, th long, doc_id {kind}, n_shingles long, set_one long, set_two long, tokens binary")


def tree_nodes(classes: DataFrame, trees: range) -> DataFrame:
    """``cid, node_2 .. node_DEPTH``: the node a class reaches at each compared depth of each tree."""
    depths = range(COMPARE_FROM, DEPTH + 1)
    names = ["cid", *(f"node_{d}" for d in depths)]

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            tokens = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(n, -1, DEPTH).astype(np.uint64)
            ids = batch.column(0).to_numpy()
            for t in trees:
                node, columns = np.full(n, t + 1, np.uint64), [pa.array(ids)]
                for level in range(DEPTH):
                    node = mix(node * np.uint64(0x9E3779B97F4A7C15) + tokens[:, t, level])
                    if level + 1 >= COMPARE_FROM:
                        columns.append(pa.array(signed(node)))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return classes.select("cid", "tokens").mapInArrow(stage, ", ".join(f"{c} long" for c in names))


def leader_pairs(nodes: DataFrame, small: int) -> DataFrame:
    """``a, b``: in each node, members to the leader of their block and leaders to the leader of the node."""
    node = f"node_{COMPARE_FROM}"
    sizes = nodes.groupBy(node).agg(F.count("*").alias("n"), F.min("cid").alias("top")).where("n > 1")
    block = F.pmod(F.xxhash64("cid"), F.ceil(F.col("n") / small))
    placed = nodes.select("cid", node).join(sizes, node).select("cid", node, "top", block.alias("block"))
    leaders = placed.groupBy(node, "block").agg(F.min("cid").alias("leader"), F.min("top").alias("top"))
    to_leader = placed.join(leaders.select(node, "block", "leader"), [node, "block"]).select(F.col("leader").alias("a"), F.col("cid").alias("b"))
    return to_leader.union(leaders.select(F.col("top").alias("a"), F.col("leader").alias("b"))).where("a < b").distinct()


def meetings(nodes: DataFrame, stages: Stages, small: int) -> DataFrame:
    """``meet, cid, comp``: who is to be compared with whom, from ``nodes(cid, comp, node_2, ..)``.

    A node with one component is done.  A node of at most ``small`` members is one meeting; a larger one branches into its
    children.  What is still larger at the last depth meets in blocks: each block of the members outside the largest
    component with each block of all members.  So a meeting has a few hundred members at most.
    """
    found, rest = [], nodes
    for depth in range(COMPARE_FROM, DEPTH + 1):
        node = f"node_{depth}"
        sizes = rest.groupBy(node).agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        sizes = sizes.where("low < high").select(node, "n")
        rest = stages.write(rest.join(sizes, node), f"nodes-{depth}")
        found.append(rest.where(F.col("n") <= small).select(F.xxhash64(F.lit(depth), node).alias("meet"), "cid", "comp"))
        rest = rest.where(F.col("n") > small).drop("n")
    node = f"node_{DEPTH}"
    shares = rest.groupBy(node, "comp").agg(F.count("*").alias("n"))
    largest = shares.groupBy(node).agg(F.max_by("comp", F.struct("n", "comp")).alias("largest"), F.sum("n").alias("members"),
                                       (F.sum("n") - F.max("n")).alias("others"))
    placed = (rest.join(largest, node).withColumn("rows", F.ceil(F.col("others") / BLOCK)).withColumn("columns", F.ceil(F.col("members") / BLOCK))
              .withColumn("at", F.xxhash64("cid")))

    def side(members: DataFrame, own: str, met: str, order: list[str]) -> DataFrame:
        block = {own: F.pmod("at", own), met: F.explode(F.sequence(F.lit(0).cast("long"), F.col(met) - 1))}
        cells = members.withColumn("own", block[own]).withColumn("met", block[met])
        return cells.select(F.xxhash64(F.lit(-1), node, *order).alias("meet"), "cid", "comp")

    found.append(side(placed.where("comp != largest"), "rows", "columns", ["own", "met"]))
    found.append(side(placed, "columns", "rows", ["met", "own"]))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every


def _by_meeting(judge):
    """A stage over rows sorted by their first column that calls ``judge`` with whole groups, a few thousand rows at a time."""
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < 4096:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            meet = table.column(0).to_numpy()
            cut = int(np.searchsorted(meet, meet[-1], "left"))
            if cut:
                yield judge(table.slice(0, cut))
            held, rows = table.slice(cut).to_batches(), table.num_rows - cut
        if held and rows:
            yield judge(pa.Table.from_batches(held).combine_chunks())

    return stage


def _groups_of(meet: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.concatenate([[True], meet[1:] != meet[:-1], [True]]))
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist())


def with_partners(rows: DataFrame, percent: int) -> DataFrame:
    """``meet, cid, comp`` of those that meet somebody of another component with a like size and enough equal tokens."""
    def judge(table: pa.Table) -> pa.RecordBatch:
        meet, cid, comp, size = (table.column(i).to_numpy() for i in range(4))
        tokens = np.frombuffer(b"".join(table.column(4).to_pylist()), "<u4").reshape(len(meet), -1)
        keep, least = np.zeros(len(meet), bool), least_equal(percent, tokens.shape[1])
        for a, b in _groups_of(meet):
            apart = comp[a:b, None] != comp[None, a:b]
            apart &= 100 * np.minimum(size[a:b, None], size[None, a:b]) >= percent * np.maximum(size[a:b, None], size[None, a:b])
            if apart.any():
                equal = np.zeros((b - a, b - a), np.uint16)
                for k in range(tokens.shape[1]):
                    equal += tokens[a:b, k, None] == tokens[None, a:b, k]
                keep[a:b] = (apart & (equal >= least)).any(1)
        return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (meet, cid, comp)], names=["meet", "cid", "comp"])

    placed = rows.select("meet", "cid", "comp", "n_shingles", "tokens").repartition("meet").sortWithinPartitions("meet", "cid")
    return placed.mapInArrow(_by_meeting(judge), "meet long, cid long, comp long")


def links_of_meetings(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links between different components in each meeting, from full sets in ``rows(meet, cid, comp, shingles)``.

    A meeting gives as many links as join its components, not all pairs: two members that are joined already need no more.
    """
    def judge(table: pa.Table) -> pa.RecordBatch:
        meet, cid, comp = (table.column(i).to_numpy() for i in range(3))
        sets = [np.frombuffer(x, "<u8") for x in table.column(3).to_pylist()]
        links = [(int(cid[a + i]), int(cid[a + j])) for a, b in _groups_of(meet) for i, j in _forest(sets[a:b], comp[a:b], percent)]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    placed = rows.select("meet", "cid", "comp", "shingles").repartition("meet").sortWithinPartitions("meet", "cid")
    return placed.mapInArrow(_by_meeting(judge), "a long, b long")


def _forest(sets: list[np.ndarray], comp: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    size = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], np.repeat(np.arange(len(sets)), size)[order]
    root = np.unique(comp, return_inverse=True)[1]
    for i, own in enumerate(sets):
        if (root == root[0]).all():
            return
        low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
        n = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        linked = (100 * both >= percent * (size + size[i] - both)) & (root != root[i]) & (both > 0)
        for j in np.flatnonzero(linked):
            if root[j] != root[i]:
                yield i, int(j)
                root[root == root[j]] = root[i]


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes allow the similarity and of whose minwise tokens enough are equal."""
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(n, -1) for i in (2, 3))
            equal = np.flatnonzero((one == two).sum(1) >= least_equal(percent, one.shape[1]))
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(equal)) for i in (0, 1)], names=["a", "b"])

    side = {k: classes.select(F.col("cid").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("tokens").alias(f"tokens_{k}")) for k in "ab"}
    near = pairs.join(side["a"], "a").join(side["b"], "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return near.select("a", "b", "tokens_a", "tokens_b").mapInArrow(stage, "a long, b long")


def texts_of(members: DataFrame, classes: DataFrame, docs: DataFrame, stages: Stages, name: str) -> DataFrame:
    """``cid, bytes``: the text of each class in ``members(cid)``; other documents are not exchanged."""
    needed = stages.write(members.distinct().join(classes.select("cid", "did", "th"), "cid"), f"{name}-needed")
    wanted = bit_filter(needed.select(F.xxhash64("did", "th").alias("key")), "key")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = passes(wanted, batch.column(2).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in (batch.column(0), batch.column(1), batch.column(3))],
                                             names=["did", "th", "bytes"])

    chosen = docs.select(*row_keys(), "text").select("did", "th", F.xxhash64("did", "th").alias("key"), text_bytes().alias("bytes"))
    texts = (chosen.mapInArrow(pick, "did long, th long, bytes binary").join(needed, ["did", "th"])
             .select("cid", "bytes").dropDuplicates(["cid"]))
    return stages.write(texts, f"{name}-texts")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, stages: Stages, name: str, percent: int, q: int = 5) -> DataFrame:
    """The pairs with ``100 * intersection >= percent * union`` on the full sets of their texts."""
    members = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid")))
    texts = texts_of(members, classes, docs, stages, name)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sets = [_sets(batch.column(i), q) for i in (2, 3)]
            for row, (one, two) in enumerate(zip(*sets)):
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep[row] = 100 * both >= percent * (len(one) + len(two) - both) and both > 0
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])

    one, two = (texts.select(F.col("cid").alias(k), F.col("bytes").alias(f"bytes_{k}")) for k in "ab")
    held = pairs.join(one, "a").join(two, "b").select("a", "b", "bytes_a", "bytes_b").mapInArrow(verify, "a long, b long")
    held = stages.write(held, f"{name}-links")
    stages.drop(f"{name}-needed", f"{name}-texts")
    return held


def compared(met: DataFrame, classes: DataFrame, docs: DataFrame, stages: Stages, name: str, percent: int, q: int = 5) -> DataFrame:
    """Links between components of :func:`meetings`: by tokens first, then on the full sets of those that have a partner."""
    near = met.join(classes.select("cid", "n_shingles", "tokens"), "cid")
    near = stages.write(with_partners(near, percent), f"{name}-near")
    texts = texts_of(near.select("cid"), classes, docs, stages, name)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.astype("<u8").tobytes() for s in _sets(batch.column(1), q)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["cid", "shingles"])

    full = texts.mapInArrow(sets, "cid long, shingles binary")
    links = stages.write(links_of_meetings(near.join(full, "cid"), percent).distinct(), f"{name}-links")
    stages.drop(f"{name}-near", f"{name}-needed", f"{name}-texts")
    return links


def _sets(column, q: int) -> Iterator[np.ndarray]:
    for row, end, data, offsets in slices(column):
        doc, h = distinct_shingles(data, offsets, q)
        cuts = np.searchsorted(doc, np.arange(end - row + 1))
        for i in range(end - row):
            yield h[cuts[i]:cuts[i + 1]]


def components(links: DataFrame, stages: Stages, name: str) -> DataFrame:
    """``cid, comp``: the smallest id reachable over ``links(a, b)``, for every id in them.

    Labels form trees that point to smaller ids.  In each step a node takes the smallest of the labels its own and its
    neighbours' labels have, and the node it pointed to takes the smallest found by those that point to it.  So whole
    trees are joined while paths are halved, and the steps grow with the logarithm of a chain whatever the order of its ids.
    Labels only get smaller and it goes on until a step changes nothing, which is when both ends of every link agree.  Each
    step is written, so no lineage grows.
    """
    both = stages.write(links.union(links.select("b", "a")).distinct(), f"{name}-both")
    labels = stages.write(both.groupBy(F.col("a").alias("cid")).agg(F.least(F.min("b"), F.min("a")).alias("comp")), f"{name}-0")
    step = 0
    while True:
        step += 1
        up = labels.join(labels.select(F.col("cid").alias("comp"), F.col("comp").alias("further")), "comp")
        near = (both.join(up.select(F.col("cid").alias("b"), F.col("further").alias("near")), "b").groupBy(F.col("a").alias("cid"))
                .agg(F.min("near").alias("near")))
        least = stages.write(up.join(near, "cid").select("cid", "comp", F.least("further", "near").alias("least")), f"{name}-least-{step}")
        hooked = least.groupBy(F.col("comp").alias("cid")).agg(F.min("least").alias("hooked"))
        moved = stages.write(least.join(hooked, "cid", "left").select(
            "cid", F.col("comp").alias("before"), F.least("least", F.coalesce("hooked", "least")).alias("comp")), f"{name}-{step}")
        stages.drop(f"{name}-{step - 1}", f"{name}-least-{step}")
        labels = moved.select("cid", "comp")
        if not moved.where("comp < before").limit(1).count():
            break
    stages.drop(f"{name}-both")
    return labels


def near_duplicates(docs: DataFrame, percent: int = 75, q: int = 5, trees: int | None = None, small: int = SMALL) -> DataFrame:
    """``did, th, doc_id, n_shingles, class_id, component_id, is_first`` for every row of ``docs(doc_id, text)``.

    Words are runs without white space, A-Z lower-cased; sets hold distinct shingles of ``q`` words (all words when
    there are fewer).  Sets with ``100 * intersection >= percent * union`` are linked; ``component_id`` is the smallest
    doc_id reachable.  ``is_first`` holds for one (did, th) of each component, the one to stay.
    The number of trees follows from ``percent``, which may be from ``LEAST_PERCENT`` to 100; fewer trees than it needs are refused.
    Defined cases: null, empty and blank texts have no shingles, are linked with nothing and form components of their own;
    equal texts are linked; rows with equal ids and texts are one document, those with equal ids and other texts are
    different; rows without id can be linked but give no component id of their own (null if nobody else does); empty tables give no rows; other columns are not read.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {LEAST_PERCENT} to 100, not {percent}")
    trees = trees_for(percent) if trees is None else trees
    if trees < trees_for(percent):
        raise ValueError(f"{trees} trees lose pairs of {percent} percent, which need {trees_for(percent)}")
    stages = Stages(docs.sparkSession, "near-duplicates")
    marked = signatures(docs, q, trees).withColumn("cid", F.when(F.col("n_shingles") > 0, F.xxhash64("set_one", "set_two", "n_shingles")))
    marked = stages.write(marked, "signatures")
    classes = stages.write(marked.where("cid is not null").groupBy("cid").agg(
        F.min("n_shingles").alias("n_shingles"), F.min(F.struct("did", "th")).alias("key"), F.min("doc_id").alias("least"),
        F.first("tokens").alias("tokens")).select("cid", "n_shingles", "key.*", "least", "tokens"), "classes")
    # First link blocks to leaders in a few trees, then compare what is still apart in all trees.
    first = likely(leader_pairs(stages.write(tree_nodes(classes, range(min(3, trees))), "few"), small), classes, percent)
    links = confirmed(stages.write(first, "first"), classes, docs, stages, "leaders", percent, q)
    stages.drop("few", "first")
    parts = stages.write(components(links, stages, "led"), "parts")
    nodes = tree_nodes(classes, range(trees)).join(parts, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    more = compared(meetings(stages.write(nodes, "all"), stages, small), classes, docs, stages, "rest", percent, q)
    stages.drop("all", *(f"nodes-{d}" for d in range(COMPARE_FROM, DEPTH + 1)))
    linked = links.union(more)
    joined = stages.write(components(linked, stages, "all-links"), "components")
    stages.drop("parts", "leaders-links", "rest-links")
    of_class = classes.select("cid", "did", "th", "least").join(joined, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    tops = of_class.groupBy("comp").agg(F.min("least").alias("component_id"), F.min(F.struct("did", "th")).alias("first"))
    of_class = stages.write(of_class.select("cid", "comp").join(tops, "comp").select("cid", "component_id", "first"), "result")
    stages.drop("classes", "components")
    out = marked.drop("tokens").join(of_class, "cid", "left")
    alone = F.col("cid").isNull()
    return out.select("did", "th", "doc_id", "n_shingles", F.col("cid").alias("class_id"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      (alone | ((F.col("did") == F.col("first.did")) & (F.col("th") == F.col("first.th")))).alias("is_first"))
