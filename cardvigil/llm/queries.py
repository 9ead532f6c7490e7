"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardvigil.llm import (
    bpe,
    chat,
    decontaminate,
    filter_audit,
    line_dedup,
    near_dedup,
    pages,
    ppm,
    quality_classifier,
    quality_rules,
    ranked_search,
    substring_dedup,
    suffix_dedup,
)
from cardvigil.llm.tables import hex_sha256, table

#: A conversation made of the template's own control strings.
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", hex_sha256(kept.text).alias("kept_sha256"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(CONTROL_CONVERSATION, given.schema)
    return chat.read_back(chat.format_conversations(given.unionByName(own)))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(_documents(spark, sf_dir)))
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.cascade(_documents(spark, sf_dir))
    return judged.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", *decontaminate.RESULTS)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return ppm.identify(docs, ppm.train(docs))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_passages(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", hex_sha256(kept.kept_text).alias("kept_sha256"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return quality_classifier.classify(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels")).drop("filter")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op7_html_extraction": op7_html_extraction,
    "op8_language_id": op8_language_id,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_ranked_search": op12_ranked_search,
    "op13_filter_audit": op13_filter_audit,
}
