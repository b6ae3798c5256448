"""Filter audit against filters run one after the other in every order."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

import brute
from pressframe.llm import filter_audit
from pressframe.llm.queries import ORACLES, QUERIES


def plain_failures(docs):
    smallest = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    for doc_id, text, lang in docs:
        t = text or ""
        words = brute.re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": doc_id is not None and smallest[t] < doc_id}
        yield doc_id, lang or "", {f for f, failed in fails.items() if failed}


def plain_audit(docs, good, toxic):
    failures, out = list(plain_failures(docs)), []
    for part in {p for _, p, _ in failures}:
        mine = [(i, f) for i, p, f in failures if p == part]
        rows, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shapley[name] += len(gone)
                rows.append((part, "".join(order), step, len(left), len(gone), sum(name in f for _, f in mine) - len(gone),
                             sum(f == {name} for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), name))
        out += [(*r[:-1], shapley[r[-1]]) for r in rows]
    return sorted(out)


def test_odd_rows(spark, odd_docs, labels, no_docs):
    more = spark.createDataFrame([(1006, 1, 1), (1006, 0, 0), (1007, 0, 1), (None, 1, 1), (1001, 1, None)], "doc_id long, quality int, toxic int")
    labels = labels.select("doc_id", F.col("quality").cast("int"), F.col("toxic").cast("int")).union(more).withColumn("part", F.lit("x")).withColumn("h", F.lit(1))
    copies = odd_docs.limit(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) if (v := {"doc_id": 5000, "text": "a|b", "lang": "en"}.get(f.name)) else F.col(f.name) for f in odd_docs.schema])
    many = copies.withColumn("doc_id", F.explode(F.sequence(F.lit(5000).cast("long"), F.lit(5400).cast("long"))))
    docs = odd_docs.unionByName(many)
    marks = labels.collect()
    want = plain_audit([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()],
                       {r.doc_id for r in marks if r.quality == 1} - {None}, {r.doc_id for r in marks if r.toxic == 1} - {None})
    found = filter_audit.audit_filters(docs, labels)
    assert sorted(map(tuple, found.collect())) == want
    assert [f.name for f in found.schema] == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {f.dataType.simpleString() for f in found.schema[3:]} == {"bigint"}
    assert sum(w[7] for w in want) and sum(w[8] for w in want) and sum(w[5] for w in want)
    assert not filter_audit.audit_filters(no_docs, labels).count()
    assert not filter_audit.audit_filters(docs, labels.where("false")).where("good_lost + toxic_lost > 0").count()


def test_hot_texts_are_dealt_under_salts(spark, monkeypatch):
    """Of 300 equal texts and pairs of others, each later copy once; every hash split as far as it goes."""
    rows = [(i, "same") for i in range(300)] + [(1000 + i, f"pair {i // 2}") for i in range(40)] + [(7, "same"), (None, "same"), (2000, "alone")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    for share in (filter_audit.HOT_SHARE, 3):
        monkeypatch.setattr(filter_audit, "HOT_SHARE", share)
        copies = filter_audit.later_copies(docs, filter_audit.marked_documents(docs)).collect()
        assert sorted(r.doc_id for r in copies) == sorted([*range(1, 300), 7, *range(1001, 1040, 2)])


def test_query_gives_its_oracle(spark):
    from checks.compare import connect, difference

    rows, found = difference(spark, connect(brute.SF), QUERIES["op13_filter_audit"], ORACLES["op13_filter_audit"], brute.SF)
    assert found is None and rows % 600 == 0 and rows


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_filter_audit"])
def test_no_cross_join(spark, name):
    plan = QUERIES[name](spark, brute.SF)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
