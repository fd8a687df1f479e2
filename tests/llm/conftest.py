import pytest
from llm.awkward import EXTRA, corpus


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from pyspark.sql import functions as F

    from godown.session import cut_lineage
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return cut_lineage(df.repartition(3).withColumns({c: F.lit(f"own {c}") for c in EXTRA}))


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.filter("false")
