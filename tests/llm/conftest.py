import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts; ids count up from 0."""
    def make(texts, langs=None, ids=None):
        rows = [(i if ids is None else ids[i], t, None if langs is None else langs[i], "s", None if t is None else len(t))
                for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and blank texts, repeated rows, a very long text, columns whose
    names the operators use themselves."""
    base = make_docs([None, "", " \n\t ", "one two", "same row here", "same row here", "word " * 30_000 + "x" * 60_000,
                      "1234 !!! 5678"], ["en", None, "en", "de", "de", "de", "en", "en"], [0, 1, 2, 3, 4, 4, 5, None])
    return (base.withColumn("spans", F.lit(1)).withColumn("ids", F.lit("x")).withColumn("n", F.lit(2)).withColumn("kept", F.lit(False))
            .withColumn("doc", F.lit("d")).withColumn("near", F.lit(None).cast("string")).withColumn("pair", F.lit(3)))
