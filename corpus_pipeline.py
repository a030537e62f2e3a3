"""A training-data pipeline over `documents`: language, near-duplicates, benchmark leaks, source mix, shards.

Every stage takes (spark, docs, sf_dir), where docs is all that the stage before it kept,
and returns a DataFrame; all but the last return the columns of `documents`. No documents
give none; further columns stay as they are, but for those that the last stage adds under
names of their own; texts of any length are taken whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslog.llm.common import cut, documents, split_third
from obslog.llm.decontaminate import drop_leaking
from obslog.llm.language_id import UNDETERMINED, fit_language_id, identify_languages
from obslog.llm.mixing import mix_sources, source_rates
from obslog.llm.near_dedup import NearDedup, drop_near_duplicates
from obslog.llm.sharding import shard_by_bytes

#: A document of which the classifier is less sure than this has no one language.
LEAST_SCORE = 0.5

#: Five-word shingles, similarity 0.8 or more; a pair at 0.8 misses all bands with probability 7e-10.
NEAR = NearDedup(shingle=5, threshold_percent=80, bands=40, rows=4, sketch_floor=0.45)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows; texts without letters and mixtures go. A null text has no letter; a null id is judged, but not learned from."""
    model = fit_language_id(docs.where(split_third(F.col("doc_id")) != 1))
    found = identify_languages(docs.select(F.struct("*").alias("doc"), "text"), model)
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id. Rows of one id stay or go together; those without an id stay."""
    return drop_near_duplicates(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and wordless texts stay; null items match nothing."""
    return drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that large sources weigh less, in random order. A null source is a source; rows equal in id and text are drawn alike."""
    return mix_sources(docs, source_rates(docs), mark=False)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their place in eight shards of near-equal bytes. Null texts have the size 1; copies share a shard unless their group must be cut."""
    return shard_by_bytes(docs)


STAGES = [("language_id", language), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]

#: Neither the classifier nor the near-duplicate components can be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
