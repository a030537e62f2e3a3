"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslog.llm.common import cut, documents, split_third
from obslog.llm.conversation_trie import prefix_trie, rebuilt, turn_lists
from obslog.llm.decontaminate import find_leaks
from obslog.llm.imatch import edited, fingerprint_texts, lexicon, likeness, printed, with_next
from obslog.llm.language_id import fit_language_id, identify_languages
from obslog.llm.license_scan import scan_licenses
from obslog.llm.merkle import verify_tampered
from obslog.llm.mixing import mix_sources, source_rates
from obslog.llm.near_dedup import near_duplicates
from obslog.llm.oracle import ORACLE_SQL
from obslog.llm.quality import fit_quality, score_quality
from obslog.llm.repeats import remove_repeats
from obslog.llm.sharding import shard_by_bytes
from obslog.llm.toxicity import fit_toxicity, score_toxicity
from obslog.llm.warc import round_trip


def op1_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_language_id(docs.where(split_third(F.col("doc_id")) != 1))
    held_out = F.coalesce(split_third(F.col("doc_id")) == 1, F.lit(False))
    return identify_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_by_bytes(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    terms = lexicon(docs)
    pairs = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))
    carried = ("doc_id", "next_row", "n_chars", "edited_sha256")
    both = pairs.select("bucket", "row", "doc_id", "next_row", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.inline(kinds))
    prints = cut(fingerprint_texts(both, terms, ["bucket", "row", "kind"], carried=carried))
    own = prints.where("kind = 0").drop("kind")
    after = prints.where("kind = 1").select("row", F.col("fp").alias("edited_fp"))
    follower = own.select(F.col("row").alias("next_row"), F.col("fp").alias("next_fp"))
    rows = own.join(after, "row").join(follower, "next_row")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("fp")).alias("fingerprint"), printed(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").where(split_third(F.col("doc_id")) != 1)
    model = fit_quality(known.where("quality = 1"), docs.where(split_third(F.col("doc_id")) != 1))
    held_out = F.coalesce(split_third(F.col("doc_id")) == 1, F.lit(False))
    return score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    mixed = mix_sources(docs, source_rates(docs))
    return mixed.select("doc_id", "source", "replica", "rate", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_tampered(documents(spark, sf_dir))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(turn_lists(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = fit_toxicity(spark.read.parquet(f"{sf_dir}/labels.parquet").where(fifth != 0), docs.where(fifth != 0))
    held_out = F.coalesce(fifth == 0, F.lit(False))
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_suffix_repeats": op1_suffix_repeats,
    "op2_language_id": op2_language_id,
    "op3_histogram_sort_shards": op3_histogram_sort_shards,
    "op4_imatch_fingerprints": op4_imatch_fingerprints,
    "op5_warc_round_trip": op5_warc_round_trip,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_poisson_mixing": op9_poisson_mixing,
    "op10_decontamination": op10_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_toxicity": op13_toxicity,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
