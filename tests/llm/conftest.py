import pytest
from pyspark.sql import functions as F

from brute import SF


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def items(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark, given):
    """Given documents with nulls everywhere, empty and very long texts, ties, repeated rows and clashing names."""
    base = [r.text for r in given.orderBy("doc_id").limit(30).collect()]
    long = " ".join(base) * 12
    rows = [(1000, None, "en", "src0"), (1001, "", None, None), (1002, " \n\t", "en", None), (None, base[3], "en", "src1"),
            (1003, None, None, None), (1004, long, "en", "src0"), (1005, long + " more words at the end", "en", "src0"),
            (1006, base[5], None, "src2"), (1006, base[5], None, "src2"), (1007, base[5], "de", None), (1008, "one two", "en", "src3"),
            (1009, "One  TWO", "en", "src3"), (1010, "\x00 ÄÖ é 漢字 token = \"0123456789abcdef0123456789abcdef\"", "de", "src3"), (1011, "a" * 5000, None, "src3"), (1012, "x\n" * 3000, "fr", "src4")]
    rows += [(2000 + i, " ".join(reversed(base[i].split(" "))) + ' token = "0123456789abcdef0123456789abcde%d" and' % i, "en", "src1") for i in range(6, 10)]
    odd = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame = given.union(odd)
    for name in ("did", "th", "row", "features", "spans", "copies", "key", "maybe", "cid", "score", "rate", "size", "bytes"):
        frame = frame.withColumn(name, F.lit(7))
    path = f"{spark.conf.get('spark.checkpoint.dir')}/odd-docs"
    frame.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def texts(odd_docs):
    """(id, text) of every row."""
    return [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
