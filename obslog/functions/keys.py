"""Surrogate keys and calendar keys, one formula each for every model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts: Column | str) -> Column:
    """SHA-256 of the parts as text, joined by '||'; null if any part is null."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    joined = texts[0] if len(texts) == 1 else F.concat(*[x for i, t in enumerate(texts) for x in ([F.lit("||"), t] if i else [t])])
    return F.sha2(joined, 256)


def date_key(when: Column | str) -> Column:
    """yyyyMMdd as an int; null for null."""
    return F.date_format(F.col(when) if isinstance(when, str) else when, "yyyyMMdd").cast("int")


def told(*parts: Column | str) -> Column:
    """Parts as one text that no other parts give, whatever signs they hold: `-` for a null, else the bytes' number, a colon and the text."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def told_list(part: Column | str) -> Column:
    """A list of texts in the same manner: their number, a semicolon, and each of them."""
    items = F.col(part) if isinstance(part, str) else part
    return F.coalesce(F.concat(F.size(items).cast("string"), F.lit(";"), F.array_join(F.transform(items, lambda x: told(x)), "")), F.lit("-"))
