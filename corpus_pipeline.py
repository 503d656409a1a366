"""From raw documents to token ids: filter, de-duplicate, decontaminate, mix, encode.

Each stage's result is written as Parquet and read again as the next one's documents. Documents may lack
their id, text or source and may be repeated; what each stage makes of those its operator says. A table
without rows gives a result without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlattice.llm import mixing, quality, simhash, tiling, token_orc
from revlattice.llm.queries import table, tokenizer_file
from revlattice.session import fresh_folder, store


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.drop_near_copies(docs, shingle=4, max_distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return tiling.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that every source weighs the same, in random order."""
    return mixing.mix_sources(docs).select(*[f"`{c}`" for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC files; the rows read back from them."""
    path = fresh_folder(spark, "token-orc")
    token_orc.write_token_orc(docs, path, tokenizer_file())
    return token_orc.token_digest(token_orc.read_token_orc(spark, path))


STAGES = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("mix_sources", mix),
    ("token_orc", encode),
]

#: Fingerprints, learned scores and token ids are beyond SQL; see tests/llm/test_llm.py and
#: tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
