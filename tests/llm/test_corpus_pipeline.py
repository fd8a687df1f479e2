"""The corpus pipeline: every stage acts on what the one before kept."""

import pytest

import corpus_pipeline
from godown.llm import lang_fusion, mcd_quality
from llm.test_joins import brute_jaccard
from llm.test_tokens import check_pieces, library  # noqa: F401


def test_stages(spark, library):  # noqa: F811
    from pyspark.sql import functions as F

    from godown.session import cut_lineage
    sf = "/root/testdata/sf0.001"
    docs = start = spark.read.parquet(f"{sf}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf))
        assert docs.columns == start.columns, name
        kept.append({r.doc_id: r for r in docs.collect()})
    assert kept[0].keys() == {r.doc_id for r in lang_fusion.keep_identified(start).collect()}
    assert kept[1].keys() == {r.doc_id for r in mcd_quality.quality(cut_lineage(start.filter(F.col("doc_id").isin(list(kept[0]))))).filter("kept").collect()}
    _, want = brute_jaccard([(r.doc_id, r.text) for r in kept[1].values()])
    assert kept[2].keys() == {d for d, c in want.items() if c == d}
    pieces = corpus_pipeline.run(spark, sf).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(pieces, [(r.doc_id, r.text) for r in kept[2].values()], library, 1, 2048)


def test_awkward_rows(spark, docs, no_docs):
    for start in (docs, no_docs):
        frame = start
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, "")
        assert (frame.count() > 0) == (start is docs)


@pytest.mark.parametrize("columns", [["text", "lang"], ["source"]])
def test_all_null_columns(spark, docs, columns):
    from pyspark.sql import functions as F
    frame = docs.limit(8).withColumns({c: F.lit(None).cast("string") for c in columns})
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "")
    assert (frame.count() > 0) == (columns == ["source"])


def test_very_long_white_space_run(spark):
    """A document with two million spaces between its paragraphs passes every stage, whole."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    a, b = docs.filter("lang = 'en' and n_chars between 1000 and 3000").orderBy("doc_id").limit(2).collect()
    padded = (1_000_000, a.text + " " * 2_000_000 + b.text, a.lang, a.source, len(a.text) + 2_000_000 + len(b.text))
    frame = docs.unionByName(spark.createDataFrame([padded], docs.schema))
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf)
    pieces = frame.filter("doc_id = 1000000").collect()
    assert sum(p.length for p in pieces) == pieces[0].doc_tokens > 2_000_000
