"""The operators as queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    decontam,
    forest,
    lines,
    mixing,
    private,
    pulearn,
    repeats,
    rules,
    spelling,
    toxicity,
    trie,
    warc,
)
from tidemark.llm.common import table


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    result = lines.drop_lines(table(spark, folder, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return result.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    result = repeats.drop_repeats(table(spark, folder, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return forest.similar(table(spark, folder, "documents"))


def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    said = "</s>[INST] ok [/INST]"
    turns = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    added = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    columns = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(columns).unionByName(added)
    return chat.read_back(*chat.format_chats(rows))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_and_read(table(spark, folder, "pages"))


def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontam.contaminated(documents, benchmark)


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return pulearn.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(table(spark, folder, "documents"))


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return private.personal_data(table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_toxicity": op5_toxicity,
    "op6_warc": op6_warc,
    "op7_mix_sources": op7_mix_sources,
    "op8_decontamination": op8_decontamination,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_personal_data": op11_personal_data,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}
