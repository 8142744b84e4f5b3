"""Contract queries of the operators: thin, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, byte_cnn, decontam, html_lines, jaccard_join, langid, lm_score, mixing, quality_rules, resample, secret_scan, token_counts, warc
from .oracle import ORACLE  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.findings(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    return lm_score.score_texts(_table(spark, sf_dir, "documents").select("doc_id", "text"), held)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = warc.derivatives(warc.responses(_table(spark, sf_dir, "pages")))
    return d.select(F.col("source_key").alias("page_id"), "warc_type", "record_id", "refers_to", "target_uri",
                    "content_type", "content_length", "block_digest", "payload_digest", "block")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_lines.extract(_table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = decontam.contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return c.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), n=3, percent=90)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = lambda c: F.pmod(F.crc32(c.cast("string")), F.lit(5))
    net = byte_cnn.fit_classifier(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"), rest(F.col("__id")) != 0)
    return byte_cnn.classify(docs, net).select("doc_id", (rest(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    found = langid.identify(docs, langid.fit(docs, rest != 0))
    return found.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align.alignment_digest(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scans": op1_secret_scans,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_warc": op3_warc,
    "op4_quality_rules": op4_quality_rules,
    "op5_html_extraction": op5_html_extraction,
    "op6_mixing": op6_mixing,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_language_id": op11_language_id,
    "op12_token_alignment": op12_token_alignment,
    "op13_target_resampling": op13_target_resampling,
}
