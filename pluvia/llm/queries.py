"""The registered queries of this subpackage: op<N>_<name> with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.llm import (collocations, decontaminate, html_extract, langid, lz_fingerprint, masked_lm,
                        oracles, packing, prefix_trie, simhash, substring_dedup, token_counts, toxicity, wavelet)
from pluvia.llm.common import table
from pluvia.session import work_dir

TOKEN_LIMIT = 2048
TOXIC_FROM = 0.7


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def pack_documents(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"))


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def fold(id_col: str = "doc_id"):
    """Remainder by 3 of the id's checksum: 1 marks held-out rows."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def q_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold() != 1)
    return langid.predict(docs, model).select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score",
        "coverage")


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold() != 1, fold() / 2)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"), "log_ratio", "n_words")


def q_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.compare_next(table(spark, sf_dir, "documents"))


def q_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def q_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.fit_and_score(table(spark, sf_dir, "documents"))


def q_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = wavelet.write_shards(table(spark, sf_dir, "documents"), work_dir(spark, "wavelet"),
                                  public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return wavelet.read_documents(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def q_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie_nodes(prefix_trie.rebuilt(turns))


def q_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_counts": q_token_counts,
    "op2_masked_lm": q_masked_lm,
    "op3_decontaminate": q_decontaminate,
    "op4_langid": q_langid,
    "op5_toxicity": q_toxicity,
    "op6_simhash": q_simhash,
    "op7_html_extract": q_html_extract,
    "op8_substring_dedup": q_substring_dedup,
    "op9_packing": q_packing,
    "op10_lz_fingerprint": q_lz_fingerprint,
    "op11_wavelet": q_wavelet,
    "op12_prefix_trie": q_prefix_trie,
    "op13_collocations": q_collocations,
}
ORACLE: dict[str, str] = {"op12_prefix_trie": oracles.PREFIX_TRIE, "op13_collocations": oracles.COLLOCATIONS}
