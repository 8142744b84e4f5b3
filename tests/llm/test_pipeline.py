"""The pipeline's stages: decisions take effect, columns stay, the mix comes from what is left."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tidemark.llm import decontam, jaccard_join, quality_rules


@pytest.fixture(scope="module")
def results(spark):
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("kept", F.lit(1)), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL).cache()
        out.append(docs)
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages(spark, results):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "mixing"]
    for df in results[:-1]:
        assert df.columns == [*docs.columns, "kept"]
    assert ids(results[0]) == {r.doc_id for r in quality_rules.quality_verdicts(docs).filter("kept").collect()}
    groups = jaccard_join.near_duplicates(results[0]).collect()
    assert ids(results[1]) == {r.component_id for r in groups}
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert ids(results[2]) == {r.doc_id for r in decontam.contamination(results[1], bench).filter("NOT contaminated").collect()}
    assert ids(results[3]) == ids(results[2])
    assert results[3].filter(F.col("text").rlike("AKIA[A-Z0-9]{14}")).count() == 0
    assert {i for r in results[4].select("doc_ids").collect() for i in r.doc_ids} <= ids(results[3])


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0
