"""Queries over the shared tables and, where SQL can express them, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bin_packing, byte_cnn, language_mix, personal_data, piece_bpe, quality_rules, reply_trees, residual_quantizer, simhash, token_files
from .common import fold, table


def op1_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = byte_cnn.train(docs, table(spark, sf_dir, "labels"))
    scored = byte_cnn.score_table(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op2_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_packing.pack(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_table(table(spark, sf_dir, "documents"))


def tokenizer(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long").alias(f"n_{k}")
    digest = F.sha2(personal_data.spans_text(F.col("spans")).cast("binary"), 256)
    return found.select("doc_id", *(count(k) for k in personal_data.PATTERNS), digest.alias("base_sha256"), personal_data.spans_text(F.col("all_spans")).alias("spans"))


def op7_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_mix.predict_table(docs, language_mix.train(docs))
    return found.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op8_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residual_quantizer.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], told.schema)
    return reply_trees.digests(reply_trees.linear(told.union(extra)))


QUERIES = {f.__name__: f for f in (op1_quality_cnn, op2_bin_packing, op3_quality_rules, op4_sentencepiece, op5_token_files, op6_personal_data, op7_language_mix, op8_additive_ann, op9_simhash, op10_reply_trees)}
ORACLES = {"op3_quality_rules": quality_rules.ORACLE, "op10_reply_trees": reply_trees.ORACLE}
