"""What the training-data operators share: the shared folder, lineage cuts, column handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslog.sources.folder import cut

__all__ = ["cut", "documents", "likely_among", "split_third", "without"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without the columns that an operator is about to add under these names."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def split_third(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


#: Bits of a bitmap of ids, in rows of 4096 bytes: 8 MB, whatever the number of ids.
_BITS, _ROW_BITS = 1 << 26, 1 << 15


def likely_among(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """`rows` without most of those whose `column` is none of `ids` (one column of the same name); none whose is goes.

    The ids' hashes are bits of a bitmap of a fixed size, which is broadcast: a join on the ids
    then shuffles few rows in vain, however many there are. Null ids go."""
    bit = F.pmod(F.xxhash64(F.col(column)), F.lit(_BITS))
    row, at = F.floor(bit / _ROW_BITS).cast("int"), F.pmod(bit, F.lit(_ROW_BITS))
    marks = ids.where(F.col(column).isNotNull()).groupBy(row.alias("__row")).agg(F.bitmap_construct_agg(at).alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1
    joined = rows.where(F.col(column).isNotNull()).withColumn("__row", row).join(F.broadcast(marks), "__row")  # at most 2048 rows
    return joined.where(marked).select(*[F.col(f"`{c}`") for c in rows.columns])
