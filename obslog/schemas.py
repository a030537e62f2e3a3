"""Declared schemas and the entity specifications that the operators share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPOSITORY = ("repository_owner", "repository_name")

OBSERVATION = T.StructType(
    [
        T.StructField("repository_owner", T.StringType(), False),
        T.StructField("repository_name", T.StringType(), False),
        T.StructField("issue_id", T.LongType(), False),
        T.StructField("source_updated_at", T.TimestampType(), False),
        T.StructField("raw_json", T.StringType(), False),
        T.StructField("_run_id", T.StringType(), False),
        T.StructField("_ingested_at", T.TimestampType(), False),
        T.StructField("_page_or_batch_reference", T.StringType(), False),
        T.StructField("_request_watermark", T.TimestampType(), True),
    ]
)

_LABEL = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("color", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("default", T.BooleanType()),
    ]
)
_USER = T.StructType([T.StructField("id", T.LongType()), T.StructField("login", T.StringType()), T.StructField("type", T.StringType())])

#: Everything is nullable here; what must be there is checked by rules after parsing.
PAYLOAD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("number", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("user", _USER),
        T.StructField("labels", T.ArrayType(_LABEL, True)),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("closed_at", T.StringType()),
    ]
)


@dataclass(frozen=True)
class EntitySpec:
    """What identifies a row, what orders its versions, and which columns only say where it came from.

    `ties` order versions of the same `order` value, most significant first."""

    name: str
    keys: tuple[str, ...]
    order: str
    ties: tuple[str, ...] = ()
    lineage: tuple[str, ...] = ("source_run_id",)


_TIES = ("_ingested_at", "source_run_id", "_page_or_batch_reference", "raw_json")
ISSUES = EntitySpec("issues", (*REPOSITORY, "issue_id"), "updated_at", _TIES)
LABELS = EntitySpec("labels", (*REPOSITORY, "label_id"), "observed_at", _TIES)
USERS = EntitySpec("users", ("user_id",), "observed_at", _TIES)
RELATIONS = EntitySpec("relations", (*REPOSITORY, "issue_id", "label_id"), "observed_at", _TIES, ("source_run_id", "observed_at"))


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns that `df` lacks, sorted. Looks at the schema only."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in their order and types; nullable ones that `df` lacks are added as nulls."""
    need = [f.name for f in schema if not f.nullable]
    require_columns(df, need)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def null_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, nulls) for every column that the schema declares not null, in one pass."""
    need = [f.name for f in schema if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in need])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("nulls")) for c in need])
    return counts.select(F.inline(pairs))


def require_utc(spark) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC"):
        raise ValueError(f"spark.sql.session.timeZone is {zone}; set it to UTC")
