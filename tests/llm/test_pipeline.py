"""The pipeline's stages on planted rows, and the whole of it on the small table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]


def test_stages_on_the_small_table(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    columns, seen = docs.columns, [docs.count()]
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small)
        if at < 4:
            assert out.columns == columns, name
        out.write.parquet(str(tmp_path / str(at)))
        docs = spark.read.parquet(str(tmp_path / str(at)))
        seen.append(docs.select("doc_id").distinct().count())
        if at == 0:
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            clean = [k for k, r in labels.items() if r.quality == 1 and r.toxic == 0]
            assert sum(k in kept for k in clean) >= 0.95 * len(clean)
        if at == 3:
            assert docs.filter(F.col("text").rlike("[0-9a-f]{32}")).count() == 0
    assert seen == sorted(seen, reverse=True) and seen[3] == seen[4] == seen[5] > 0.5 * seen[0]


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_stages_keep_odd_rows_and_columns(spark, small, n):
    rows = [(1, "plain words that say nothing in particular to anyone"), (2, ""), (None, "another one of them without a number, still good"), (3, "plain but other words, quite different from all the rest")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "CAST(NULL AS STRING) AS source", "CAST(length(text) AS BIGINT) AS n_chars", "1 AS row", "2 AS bits", "3 AS text_hash", "4 AS spans", "5 AS input"
    )
    out = corpus_pipeline.STAGES[n][1](spark, docs, small)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    assert corpus_pipeline.STAGES[n][1](spark, docs.limit(0), small).collect() == []


def test_run(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0
