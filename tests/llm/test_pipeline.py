"""The pipeline stage by stage against plain versions, on odd rows with clashing columns, and end to end."""

from collections import Counter

import pytest

import brute
import corpus_pipeline
from brute import SF

KEY = ("doc_id", "text", "lang", "source", "n_chars")


def rows_of(frame):
    return [tuple(r) for r in frame.select(*KEY).collect()]


@pytest.fixture(scope="module")
def steps(spark, odd_docs):
    """Input and output rows of every stage, each written and read again."""
    from pressframe.llm.common import Stages

    stages, docs, out = Stages(spark, "test-pipeline"), odd_docs, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stages.write(stage(spark, docs, SF), f"stage-{number}")
        out.append((docs, after))
        docs = after
    return out


def test_all_but_the_last_return_the_columns(steps):
    for before, after in steps[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_quality_drops_the_rejected_only(steps, labels):
    before, after = (rows_of(f) for f in steps[0])
    assert not Counter(after) - Counter(before)
    known = {r.doc_id: r.quality for r in labels.collect()}
    stay = {r[0] for r in after}
    judged = [(known[r[0]] > 0) == (r[0] in stay) for r in before if r[0] in known]
    assert sum(judged) / len(judged) > 0.95


def test_one_of_each_group_stays(steps):
    before, after = (rows_of(f) for f in steps[1])
    assert not Counter(after) - Counter(before)
    texts = [(r[0], r[1]) for r in before]
    _, group = brute.groups(texts)
    smallest = {}
    for (i, t), g in zip(texts, group):
        rank = (-(1 << 63) if i is None else i)
        smallest[g] = min(smallest.get(g, rank), rank)
    assert Counter(-(1 << 63) if r[0] is None else r[0] for r in after) == Counter(smallest.values())


def test_contaminated_go(steps, items):
    before, after = (rows_of(f) for f in steps[2])
    plain = brute.windows([(r.item_id, r.text) for r in items.collect()])
    assert Counter(after) == Counter(r for r in before if not brute.contamination(r[1], plain)[3])
    assert len(after) < len(before)


def test_secrets_are_replaced(steps):
    before, after = ({(r[0], r[2], r[3]): r for r in rows_of(f)} for f in steps[3])
    assert before.keys() == after.keys()
    changed = 0
    for key, row in before.items():
        if sum(brute.secrets(row[1])[0]):
            changed += 1
            assert after[key][1] != row[1] and after[key][4] == len(after[key][1])
            assert brute.secrets(after[key][1])[0][1:] == [0, 0]
        else:
            assert after[key] == row
    assert changed


def test_mixture_takes_whole_copies(steps):
    before, after = steps[4]
    given = Counter(r.doc_id for r in before.select("doc_id").collect())
    for r in after.collect():
        assert given[r.doc_id] and 1 <= r.copies <= 3 and r.taken == r.copies * r["size"]


def test_empty_documents(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert not docs.count()


def test_run_gives_the_rows_of_the_stages(spark):
    first = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert first and first == Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())


def test_python_gets_few_bytes_at_a_time(spark):
    """A batch ends at about a megabyte, whatever its rows hold; a smaller setting stays."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    from pressframe.llm.common import BATCH_BYTES, small_batches

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "64m")
        small_batches(spark)
        found = spark.range(0, 1000, 1, 1).select(F.repeat(F.lit("0123456789"), 1000).alias("text")).mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in found) == 1000 and max(r.size for r in found) < 1.1 * BATCH_BYTES
        spark.conf.set(setting, "100k")
        small_batches(spark)
        assert spark.conf.get(setting) == "100k"
    finally:
        spark.conf.set(setting, before)


def test_memory_of_a_text_pass_does_not_follow_the_batch():
    """Many short texts in one batch are worked on in small slices."""
    import tracemalloc

    import pyarrow as pa

    from pressframe.llm import bytewords, quality

    column = pa.array([b"some words of a short text, Number %d\n" % i * 20 for i in range(3000)], pa.binary())
    tracemalloc.start()
    try:
        n = sum(len(quality.text_features(data, offsets)) for _, _, data, offsets in bytewords.slices(column))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 3000 and most < 24e6, most
