"""I-Match fingerprints: hashes of sorted mid-frequency terms over randomised lexicon subsets, with DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslog.llm.common import cut
from obslog.llm.license_scan import folded_words


@dataclass(frozen=True)
class IMatch:
    """Parameters. The band has the terms that a share of `least_share` to `most_share` of the documents hold, and at least `least_documents` of them.

    A text with fewer than `enough` terms in the band gets as many of its least frequent
    terms above it, too: copies count, so that what very many near copies share lies above the
    band. At most (mean distinct terms of a document) / `least_share` terms can reach the
    band or lie above it, however many documents there are; beyond `broadcast_terms` the
    lexicon is joined by a shuffle. The `subsets` random orders of the lexicon each give
    nested subsets that keep one term in 4, 16, 64, ... (`levels` of them): long texts are
    compared by the sparse ones, short texts by the dense ones."""

    least_share: float = 0.001
    most_share: float = 0.01
    least_documents: int = 2
    enough: int = 16
    broadcast_terms: int = 1 << 20
    levels: int = 5
    subsets: int = 8
    seed: int = 11


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(folded_words(text), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, p: IMatch = IMatch(), text_col: str = "text") -> DataFrame:
    """(term, over): hashes of the terms within the band of document frequency, and above it with their number of documents.

    `over` is 0 within the band. All documents count, a null text as an empty one. An empty
    table has no terms; other columns are not read."""
    counts = docs.select(F.explode(_terms(F.col(text_col))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    n = docs.count()
    least, most = max(p.least_documents, p.least_share * n), max(p.least_documents, p.most_share * n)
    return cut(counts.where(F.col("n") >= least).select("term", F.when(F.col("n") > most, F.col("n")).otherwise(F.lit(0)).alias("over")))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _nested(hashes: Column, p: IMatch, level: int) -> Column:
    """The hash of what each subset from this level on holds, 0 for nothing."""
    if level > p.levels:
        return F.array().cast("array<bigint>")
    inside = F.filter(hashes, lambda h: F.pmod(h, F.lit(4**level)) == 0)
    return _let(inside, lambda held: F.concat(F.array(F.when(F.size(held) > 0, F.xxhash64(held)).otherwise(F.lit(0).cast("long"))), _nested(held, p, level + 1)))


def fingerprint(terms: Column, text_hash: Column, p: IMatch) -> Column:
    """Hashes of the sorted distinct terms: of all, then for each order of the lexicon of those in each nested subset; 0 where it holds none.

    A text without any term of the lexicon has its own hash in the first place, and so
    matches equal texts only."""

    def order(salt: int) -> Column:
        return _let(F.transform(terms, lambda t: F.xxhash64(F.lit(salt), t)), lambda hashes: _nested(hashes, p, 1))

    whole = F.when(F.size(terms) > 0, F.xxhash64(terms)).otherwise(F.xxhash64(F.lit(p.seed), text_hash))
    return F.concat(F.array(whole), *[order(p.seed * 1000 + i) for i in range(p.subsets)])


def likeness(a: Column, b: Column, p: IMatch = IMatch()) -> Column:
    """How alike two fingerprints are, from 0 to 1: 1 if all terms agree; else the share of
    equal hashes at the sparsest level at which half of the subsets hold a term of either text."""
    out = F.lit(0.0)
    for level in range(p.levels):
        at = [1 + i * p.levels + level for i in range(p.subsets)]
        used = sum(((F.get(a, F.lit(i)) != 0) | (F.get(b, F.lit(i)) != 0)).cast("int") for i in at)
        same = sum(((F.get(a, F.lit(i)) != 0) & (F.get(a, F.lit(i)) == F.get(b, F.lit(i)))).cast("int") for i in at)
        out = F.when(used * 2 >= p.subsets, same / used).otherwise(out)
    return F.when(F.get(a, F.lit(0)) == F.get(b, F.lit(0)), F.lit(1.0)).otherwise(out)


def printed(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda h: F.lower(F.hex(h))), "-")


def fingerprint_texts(texts: DataFrame, terms: DataFrame, keys: list[str], p: IMatch = IMatch(), carried: tuple[str, ...] = ()) -> DataFrame:
    """`keys`, `carried` and fp (array of hashes) for each row of `texts`, which also has `text`.

    keys name a row; rows equal in all keys count as one and share one text's hash. Where the
    texts are partitioned by some of the keys already, their terms come together again
    without an exchange. Each text keeps one place for no term at all, with what it carries,
    so that one without any is still there. A null text is an empty one. No rows give none."""
    n = terms.count()
    lex = terms.withColumnRenamed("term", "__term")
    lex = F.broadcast(lex) if n <= p.broadcast_terms else lex
    last = F.struct(F.lit(None).cast("long").alias("x"), F.struct(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), *carried).alias("own"))
    kind = texts.select(F.struct(F.xxhash64(F.lit("")).alias("h"), *carried).alias("own")).schema["own"].dataType
    words = F.transform(_terms(F.col("text")), lambda x: F.struct(x.alias("x"), F.lit(None).cast(kind).alias("own")))
    rows = texts.select(*keys, F.explode(F.concat(words, F.array(last))).alias("__t")).select(*keys, "__t.x", "__t.own")
    found = rows.join(lex, F.col("x") == F.col("__term"), "left").where("x IS NULL OR __term IS NOT NULL")
    term = F.when(F.col("__term").isNotNull(), F.struct("over", "__term"))
    grouped = found.groupBy(*keys).agg(F.max("own").alias("__own"), F.sort_array(F.collect_set(term)).alias("__all"))
    inside = F.filter("__all", lambda t: t["over"] == 0)
    above = F.filter("__all", lambda t: t["over"] > 0)
    chosen = _let(inside, lambda own: F.concat(own, F.slice(above, F.lit(1), F.greatest(F.lit(p.enough) - F.size(own), F.lit(0)))))
    sorted_terms = F.sort_array(F.transform(chosen, lambda t: t["__term"]))
    chosen_rows = grouped.select(*keys, "__own", sorted_terms.alias("__terms"))
    return chosen_rows.select(*keys, *[F.col(f"__own.{c}").alias(c) for c in carried], fingerprint(F.col("__terms"), F.col("__own.h"), p).alias("fp"))


_PARTS = 64  # of a bucket of rows that share an id, or have none
_ROWS = 1 << 32


def with_next(docs: DataFrame, rows_a_bucket: int = 200) -> DataFrame:
    """bucket, doc_id, text, row, next_text and next_row: each document with its successor in descending doc_id (after the last, the first).

    Documents are cut at exact-enough quantiles of doc_id into at most 65,536 buckets, each
    ordered on its own; the first document of a bucket is also put at the end of the bucket
    before it. Only the bucket heads, one row each, are ordered in one place. Null ids come
    last; rows that share an id are ordered by a hash of the text, descending, and an id that
    fills whole buckets, as well as none, is split by that hash. Rows equal in id and text
    stay together in any order. `row` is unique, and equal wherever it is computed. One row is
    its own successor; none give none; other columns are not read."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    ids = docs.select("doc_id")
    n, lo, hi = ids.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    coarse = max(1, min(256, n // rows_a_bucket))
    fine = max(1, min(256, n // (256 * rows_a_bucket)))
    bounds, hot = [], []
    if coarse > 1:
        found = ids.agg(F.percentile_approx("doc_id", [i / coarse for i in range(1, coarse)], 10_000)).first()[0] or []
        bounds = sorted(set(found) - {lo})
        hot = [int(x) for x in set(found) if found.count(x) > 1]
    edges = [lo or 0, *bounds, (hi or 0) + 1]
    at = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b <= F.col("doc_id"))) if bounds else F.lit(0)
    left, right = (F.element_at(F.array(*[F.lit(float(e)) for e in side]), at + 1) for side in (edges[:-1], edges[1:]))
    part = F.least(F.floor((F.col("doc_id") - left) / (right - left) * fine), F.lit(fine - 1)) if fine > 1 else F.lit(0)
    by_hash = F.shiftright("h", 58) + _PARTS // 2
    place = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(at * fine + part).cast("long") * (2 * _PARTS)
    # an id that is split comes after the other ids of its bucket, which a bound at the id makes larger ones
    split = F.when(F.col("doc_id").isNull() | F.col("doc_id").isin(hot), by_hash).otherwise(F.lit(_PARTS)) if hot else F.when(F.col("doc_id").isNull(), by_hash).otherwise(F.lit(_PARTS))
    placed = docs.withColumn("bucket", place + split)
    heads = placed.groupBy("bucket").agg(F.max(F.struct("doc_id", "h")).alias("head"))
    falling = Window.orderBy(F.desc("bucket"))
    heads = heads.select(F.col("bucket").alias("own"), "head", F.coalesce(F.lag("bucket").over(falling), F.min("bucket").over(Window.partitionBy())).alias("goes_to"))
    heads = F.broadcast(cut(heads))  # at most 65,536 and 64 for each of at most 256 ids
    copies = placed.join(heads, (F.col("bucket") == F.col("own")) & F.struct("doc_id", "h").eqNullSafe(F.col("head")))
    copies = copies.select("doc_id", "text", "h", F.col("goes_to").alias("bucket"), F.lit(1).alias("copy"), (F.col("own") * _ROWS + 1).alias("of"))
    rows = placed.select("doc_id", "text", "h", "bucket", F.lit(0).alias("copy"), F.lit(None).cast("long").alias("of")).union(copies)
    order = Window.partitionBy("bucket").orderBy("copy", F.desc_nulls_last("doc_id"), F.desc("h"), F.desc("text"))
    numbered = rows.withColumn("row", F.coalesce("of", F.col("bucket") * _ROWS + F.row_number().over(order)))
    return numbered.select("bucket", "doc_id", "text", "copy", "row", F.lead("text").over(order).alias("next_text"), F.lead("row").over(order).alias("next_row")).where("copy = 0").drop("copy")


def edited(text: Column, follower: Column) -> Column:
    """The text with its last third of code points replaced by the first as many, or all, of the follower."""
    n = F.length(text)
    m = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - m), F.substring(follower, F.lit(1), m))
