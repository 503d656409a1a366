"""The operators as queries over the benchmark tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlattice.llm import embedding_dedup, fill_middle, html_text, licenses, mixing, order_minhash, prefix_trie, quality, secrets, simhash, tiling, token_orc, warc
from revlattice.session import fresh_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "token-orc")
    token_orc.write_token_orc(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return token_orc.token_digest(token_orc.read_token_orc(spark, path))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "text", "source", "mix.copy", "mix.place")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_embeddings(table(spark, sf_dir, "embeddings"), min_cosine=0.98)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "warc")
    index = warc.write_warc(table(spark, sf_dir, "pages"), path, min_revisit_bytes=0)
    return warc.read_back(index, path)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_distance=4)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_likeness(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.rebuilt(prefix_trie.turns_of(table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(turns)


QUERIES = {
    "op1_token_orc": op1_token_orc,
    "op2_mix_sources": op2_mix_sources,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_html_text": op4_html_text,
    "op5_warc": op5_warc,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_simhash": op7_simhash,
    "op8_secrets": op8_secrets,
    "op9_decontaminate": op9_decontaminate,
    "op10_licenses": op10_licenses,
    "op11_order_minhash": op11_order_minhash,
    "op12_fill_middle": op12_fill_middle,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE = {
    "op2_mix_sources": mixing.MIX_SQL,
    "op3_embedding_dedup": embedding_dedup.NEAR_SQL,
    "op5_warc": warc.WARC_SQL,
    "op10_licenses": licenses.LICENSE_SQL,
    "op12_fill_middle": fill_middle.FILL_SQL,
    "op13_prefix_trie": prefix_trie.TRIE_SQL,
}
