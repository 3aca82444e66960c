"""The operators as queries over the sample tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm.common import table
from riskmart.llm.conversation_trie import conversation_trie
from riskmart.llm.decontamination import contaminations
from riskmart.llm.kd_shards import kd_shards, numbered
from riskmart.llm.lexical_search import ranked
from riskmart.llm.line_windows import remove_repeated_windows
from riskmart.llm.quality_divergence import judged
from riskmart.llm.lsh_forest import near_duplicates
from riskmart.llm.phrase_automata import remove_repeated_passages
from riskmart.llm.piece_encoding import encode_pieces
from riskmart.llm.site_templates import main_texts
from riskmart.llm.suffix_ranks import remove_repeated_bytes
from riskmart.llm.toxicity_fm import held_out, learn, scored
from riskmart.llm.window_packing import pack_windows
from riskmart.llm.sql import (
    CONVERSATION_TRIE_SQL,
    LEXICAL_SEARCH_SQL,
    LINE_WINDOWS_SQL,
    LSH_FOREST_SQL,
    PHRASE_AUTOMATA_SQL,
    SUFFIX_RANKS_SQL,
)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed_lines", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5")
    )


def kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(kd_shards(table(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _covered(spans: str) -> Column:
    widths = F.transform(spans, lambda s: (s["end"] - s["start"]).cast("long"))
    return F.aggregate(widths, F.lit(0).cast("long"), lambda total, x: total + x)


def suffix_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        _covered("spans").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        _covered("spans").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_windows(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "passages", "question_percent", "answer_percent"
    )


def toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = learn(docs, table(spark, sf_dir, "labels"))
    return scored(docs, machine).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    return encode_pieces(table(spark, sf_dir, "documents"), model).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_quality_divergence": quality_divergence,
    "op2_window_packing": window_packing,
    "op3_line_windows": line_windows,
    "op4_kd_sharding": kd_sharding,
    "op5_site_templates": site_templates,
    "op6_toxicity_fm": toxicity_fm,
    "op7_suffix_ranks": suffix_ranks,
    "op8_phrase_automata": phrase_automata,
    "op9_lsh_forest": lsh_forest,
    "op10_decontamination": decontamination,
    "op11_piece_encoding": piece_encoding,
    "op12_lexical_search": lexical_search,
    "op13_conversation_trie": trie,
}

ORACLES = {
    "op3_line_windows": LINE_WINDOWS_SQL,
    "op7_suffix_ranks": SUFFIX_RANKS_SQL,
    "op8_phrase_automata": PHRASE_AUTOMATA_SQL,
    "op9_lsh_forest": LSH_FOREST_SQL,
    "op12_lexical_search": LEXICAL_SEARCH_SQL,
    "op13_conversation_trie": CONVERSATION_TRIE_SQL,
}
