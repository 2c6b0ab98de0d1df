"""The registered queries of the text operators: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import conversation_repair, decontaminate, fingerprints, kneser_ney, license_scan, line_dedup, mixing, ngram_join, quality_cnn, repeats, source_divergence, \
    token_files, url_filter


def _docs(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_license_scan(spark, d):
    return license_scan.digest(license_scan.license_scan(_docs(spark, d)))


def op2_url_filter(spark, d):
    return url_filter.filter_urls(_docs(spark, d, "pages"))


def op3_kneser_ney(spark, d):
    return kneser_ney.score_documents(_docs(spark, d))


def op4_repeats(spark, d):
    return repeats.remove_repeats(_docs(spark, d))


def op5_quality_cnn(spark, d):
    docs = _docs(spark, d).select("doc_id", "text")
    return quality_cnn.digest(quality_cnn.classify(docs, _docs(spark, d, "labels")))


def op6_ngram_join(spark, d):
    return ngram_join.near_groups(_docs(spark, d))


def op7_decontaminate(spark, d):
    docs = _docs(spark, d).select("doc_id", "text")
    return decontaminate.digest(decontaminate.decontaminate(docs, _docs(spark, d, "benchmark")))


def op8_line_dedup(spark, d):
    return line_dedup.digest(line_dedup.line_dedup(_docs(spark, d).select("doc_id", "text")))


def op9_fingerprints(spark, d):
    return fingerprints.fingerprints(_docs(spark, d))


def op10_mixing(spark, d):
    return mixing.digest(mixing.schedule(_docs(spark, d).select("doc_id", "source", "text")))


def op11_conversation_repair(spark, d):
    rows = conversation_repair.damage(_docs(spark, d, "conversations"))
    return conversation_repair.digest(conversation_repair.repair(rows, rows["present"]))


def op12_token_files(spark, d):
    import public_tokenizers
    files = token_files.write_tokens(_docs(spark, d), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(files)


def op13_source_divergence(spark, d):
    return source_divergence.audit(_docs(spark, d))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_url_filter, op3_kneser_ney, op4_repeats, op5_quality_cnn, op6_ngram_join, op7_decontaminate, op8_line_dedup, op9_fingerprints,
    op10_mixing, op11_conversation_repair, op12_token_files, op13_source_divergence)}
ORACLES = {"op8_line_dedup": line_dedup.ORACLE, "op10_mixing": mixing.ORACLE, "op13_source_divergence": source_divergence.ORACLE}
