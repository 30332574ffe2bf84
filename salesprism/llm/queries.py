"""The operators as registered queries over their whole tables, and oracle SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesprism.llm import context_tree, fertility, jaccard, language, licenses, mixing, oracles, packing, phrases, pii, projections, spelling, token_codes, urls


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_tokeniser_fertility(spark: SparkSession, folder: str) -> DataFrame:
    found = fertility.judged(documents(spark, folder))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *fertility.MEASURES, F.array_join("outside", ",").alias("outside"),
    )


def op2_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    found = context_tree.scored(documents(spark, folder))
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op3_boosted_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.found(documents(spark, folder))


def op4_projection_passes(spark: SparkSession, folder: str) -> DataFrame:
    return projections.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op5_byte_network(spark: SparkSession, folder: str) -> DataFrame:
    return language.predicted(documents(spark, folder))


def op6_adaptive_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.joined(documents(spark, folder))


def op7_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.packed(documents(spark, folder))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )


def op8_addressable_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = token_codes.read_back(token_codes.written(documents(spark, folder)))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: a directory for each source, in it one for each language, in it one
    for each 64 neighbouring ids."""
    place = F.concat_ws(
        "/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")),
        F.floor(F.col("doc_id") / 64).cast("string"), F.col("doc_id").cast("string"),
    )
    return licenses.scanned(documents(spark, folder).select("doc_id", place.alias("path"), "text"))


def op10_pareto_mixture(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix_documents(documents(spark, folder))
    return found.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op11_spelling_grams(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.runs(documents(spark, folder), spoil=97)
    return spelling.grouped(spelling.vocabulary(words))


def op12_boosted_urls(spark: SparkSession, folder: str) -> DataFrame:
    found = urls.judged(spark.read.parquet(f"{folder}/pages.parquet"))
    return found.select("page_id", "host", "path", "rule", "verdict", "score")


def op13_phrase_index(spark: SparkSession, folder: str) -> DataFrame:
    found = phrases.top(phrases.collocations(documents(spark, folder)))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "n_left", "n_right")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_tokeniser_fertility": op1_tokeniser_fertility,
        "op2_context_tree": op2_context_tree,
        "op3_boosted_pii": op3_boosted_pii,
        "op4_projection_passes": op4_projection_passes,
        "op5_byte_network": op5_byte_network,
        "op6_adaptive_prefixes": op6_adaptive_prefixes,
        "op7_mixture_packing": op7_mixture_packing,
        "op8_addressable_codes": op8_addressable_codes,
        "op9_license_scan": op9_license_scan,
        "op10_pareto_mixture": op10_pareto_mixture,
        "op11_spelling_grams": op11_spelling_grams,
        "op12_boosted_urls": op12_boosted_urls,
        "op13_phrase_index": op13_phrase_index,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op11_spelling_grams": oracles.SPELLING,
        "op13_phrase_index": oracles.PHRASES,
    }
