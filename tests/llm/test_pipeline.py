"""The pipeline on tables with nulls, repeats and no rows. Its result on sf0.001 by hand is in test_llm.py."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    def made(docs):
        path = str(tmp_path_factory.mktemp("tables"))
        docs.write.parquet(f"{path}/documents.parquet")
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
        return path

    return made


def test_no_documents(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert corpus_pipeline.run(spark, folder(docs)).count() == 0


def test_rows_without_ids_or_texts_and_repeated_rows(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = docs.orderBy("doc_id").limit(3)
    odd = good.withColumn("doc_id", F.lit(None).cast("long")).unionByName(good).unionByName(
        good.limit(1).withColumn("doc_id", F.lit(9001)).withColumn("text", F.lit(None).cast("string"))
    )
    # Columns that the stages use for themselves, and one with a dot in its name.
    more = docs.unionByName(odd).withColumn("row", F.lit(1)).withColumn("fp", F.lit("x")).withColumn("a.b", F.lit(2))
    path = folder(more.withColumn("source", F.when(F.col("doc_id") % 10 > 0, F.col("source"))))
    rows = corpus_pipeline.run(spark, path).collect()
    # Starts and lengths fit together, and each text has its end id.
    ordered = sorted(rows, key=lambda r: r["start"])
    at = 0
    for r in ordered:
        assert r["start"] == at and r["n_tokens"] >= 1
        at += r["n_tokens"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in [r for r in ordered if r["doc_id"] in texts][::40]:
        assert r["n_tokens"] == len(known.encode(texts[r["doc_id"]], add_special_tokens=False).ids) + 1
    assert len(ordered) > 50


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), SF)
        assert empty.columns == docs.columns and empty.count() == 0, name
