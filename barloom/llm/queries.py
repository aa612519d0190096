"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    chat_windows,
    conversation_repair,
    crf_language,
    gru_toxicity,
    host_reputation,
    kmeans_tree,
    pair_index_bpe,
    polar_whitening,
    simhash_decontam,
    spm_bpe,
    trie_join,
    unit_dedup,
    warc_derivatives,
)
from barloom.llm.common import held_out, table

VOCABULARY = "byte_bpe_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"
#: The conversation that the contract of op5 adds.
EXTRA_TURN = "<|im_end|><|im_start|>assistant ok"
EXTRA = [(-1, 0, "user", EXTRA_TURN), (-1, 1, "assistant", EXTRA_TURN)]


def op1_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = unit_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.withColumn("n_removed", F.size("removed"))


def op2_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = crf_language.identify(docs, crf_language.learn(docs), ["doc_id"])
    return found.withColumn("held_out", held_out())


def op3_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = gru_toxicity.learn(docs, table(spark, sf_dir, "labels"))
    found = gru_toxicity.score(docs, scorer, ["doc_id"])
    return found.withColumns({"held_out": held_out(), "predicted": (F.col("score") >= 0.5).cast("int")})


def op4_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_join.groups(table(spark, sf_dir, "documents"), width=3, percent=90)


def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    talks = talks.unionByName(spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string"))
    return chat_windows.read_back(chat_windows.windows(talks, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN))


def op6_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_spm_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spm_bpe.encode_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, ["doc_id"])


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_derivatives.derivatives(warc_derivatives.as_responses(table(spark, sf_dir, "pages")))


def op9_simhash_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return host_reputation.judge(pages, host_reputation.bad_page(F.col("html")))


def op11_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pair_index_bpe.encode_digests(docs, public_tokenizers.path(WORD_VOCABULARY), ["doc_id"])


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations")
    found = conversation_repair.repair(conversation_repair.damage(talks))
    parts = found.report.withColumnRenamed("conv", "r_conv"), conversation_repair.digests(found.turns).withColumnRenamed("conv", "d_conv")
    out = talks.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = out.join(parts[0], F.col("conv_id").eqNullSafe(F.col("r_conv")) & F.col("cost").isNotNull(), "left")
    out = out.join(parts[1], F.col("conv_id").eqNullSafe(F.col("d_conv")) & F.col("repaired_sha256").isNotNull(), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_polar_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polar_whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_unit_dedup": op1_unit_dedup,
        "op2_crf_language": op2_crf_language,
        "op3_gru_toxicity": op3_gru_toxicity,
        "op4_trie_join": op4_trie_join,
        "op5_chat_windows": op5_chat_windows,
        "op6_kmeans_tree": op6_kmeans_tree,
        "op7_spm_bpe": op7_spm_bpe,
        "op8_warc_derivatives": op8_warc_derivatives,
        "op9_simhash_decontam": op9_simhash_decontam,
        "op10_host_reputation": op10_host_reputation,
        "op11_pair_index_bpe": op11_pair_index_bpe,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_polar_whitening": op13_polar_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_host_reputation": host_reputation.ORACLE}
