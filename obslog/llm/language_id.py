"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslog.llm.common import without
from obslog.llm.kernels import Hashes, slices

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageId:
    """Parameters. The broadcast model has languages x buckets numbers; `most_languages` bounds it.

    The language is the one of largest posterior over all n-grams. `evidence` is how many
    n-grams' worth of mean log-posterior the score rests on at most, which is that language's
    share once the posterior is tempered so; naive Bayes would otherwise answer 0 or 1 for
    every text of some length. A task holds the
    n-grams of about `slice_bytes` of text at a time, or of one document."""

    orders: tuple[int, ...] = (1, 2, 3)
    buckets: int = 8192
    smoothing: float = 0.5
    evidence: int = 60
    slice_bytes: int = 1 << 18
    most_languages: int = 1024


#: A-Z as a-z, other ASCII that is no letter as a space; bytes of other characters as they are.
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[:128] = 32
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)


def ngram_buckets(column: pa.Array, p: LanguageId) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row of each n-gram, its bucket) for runs of rows.

    N-grams are of characters and never cross documents; those of spaces only are left out."""
    for lo, hi, data, offsets in slices(column, p.slice_bytes):
        data = _LETTERS[data]
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        first = np.searchsorted(starts, offsets)
        ends = np.concatenate([starts, [len(data)]])
        row_of = np.repeat(np.arange(hi - lo), np.diff(first))
        spaces = np.concatenate([[0], np.cumsum(data[starts] == 32)])
        hashes = Hashes(data)
        rows, buckets = [], []
        for n in p.orders:
            m = max(0, len(starts) - n + 1)
            at = np.arange(m)
            at = at[(row_of[at] == row_of[at + n - 1]) & (spaces[at + n] - spaces[at] < n)] if m else at
            rows.append(row_of[at])
            buckets.append((hashes.of(starts[at], ends[at + n]) % np.uint64(p.buckets)).astype(np.int64))
        yield lo, hi, np.concatenate(rows), np.concatenate(buckets)


def _counts(p: LanguageId):
    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for lo, hi, rows, buckets in ngram_buckets(batch.column(0), p):
                names, number = np.unique(langs[lo:hi].astype(str), return_inverse=True)
                table = np.bincount(number[rows] * p.buckets + buckets, minlength=len(names) * p.buckets)
                for i, name in enumerate(names):
                    part = totals.setdefault(name, np.zeros(p.buckets + 1, np.int64))
                    part[:-1] += table[i * p.buckets : (i + 1) * p.buckets]
                    part[-1] += int((number == i).sum())
        for name, part in totals.items():
            at = np.flatnonzero(part)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(part[at], pa.int64())], ["lang", "bucket", "n"])

    return run


class Model:
    """Log probabilities of the buckets for each language, and of the languages."""

    def __init__(self, rows, p: LanguageId):
        self.p = p
        self.langs = sorted({r[0] for r in rows})
        at = {x: i for i, x in enumerate(self.langs)}
        counts = np.zeros((len(self.langs), p.buckets + 1))
        for lang, bucket, n in rows:
            counts[at[lang], bucket] = n
        docs = counts[:, -1] + p.smoothing
        grams = counts[:, :-1] + p.smoothing
        self.prior = np.log(docs / docs.sum()) if len(self.langs) else docs
        self.log_p = np.log(grams / grams.sum(axis=1, keepdims=True))

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
        for lo, hi, rows, buckets in ngram_buckets(column, self.p):
            n = np.bincount(rows, minlength=hi - lo)
            # sparse: only the n-grams that occur, summed by document for one language at a time
            likelihood = np.stack([np.bincount(rows, self.log_p[i][buckets], hi - lo) for i in range(len(self.langs))], axis=1)
            x = likelihood + self.prior
            best[lo:hi] = x.argmax(axis=1)
            x = np.exp((x - x.max(axis=1, keepdims=True)) * (np.minimum(n, self.p.evidence) / np.maximum(n, 1))[:, None])
            score[lo:hi] = np.round(1 / x.sum(axis=1), 9)
        return best, score


def fit_language_id(labelled: DataFrame, p: LanguageId = LanguageId(), text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of all rows of `labelled` whose language and text aren't null.

    Each task sums its own counts for each language and bucket; Spark adds them up, and the
    driver gets languages x buckets sums, however many rows there are."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col), F.col(lang_col).cast("string").alias(lang_col))
    sums = rows.mapInArrow(_counts(p), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n"))
    if len(rows.select(lang_col).distinct().limit(p.most_languages + 1).collect()) > p.most_languages:
        raise ValueError(f"more than {p.most_languages} languages")
    return Model([tuple(r) for r in sums.collect()], p)


def identify_languages(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and score (0 to 1), which replace columns of these names.

    A null text, one without a letter, or any text under a model that has learned nothing,
    is `und` with score 0. Equal texts get equal answers; ties go to the language that
    sorts first. Long texts are read whole; no rows give none. No row is moved."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))

    @F.arrow_udf("lang string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        m = shared.value
        if not m.langs:
            return pa.StructArray.from_arrays([pa.array([UNDETERMINED] * len(texts), pa.string()), pa.array(np.zeros(len(texts)))], ["lang", "score"])
        best, score = m.predict(texts)
        return pa.StructArray.from_arrays([pa.array(m.langs, pa.string()).take(pa.array(best)), pa.array(score)], ["lang", "score"])

    return (
        without(docs, "lang_pred", "score", "__found", "__letter")
        .withColumn("__letter", has_letter)
        .withColumn("__found", predict(F.col(text_col)))
        .withColumn("lang_pred", F.when(F.col("__letter"), F.col("__found.lang")).otherwise(F.lit(UNDETERMINED)))
        .withColumn("score", F.when(F.col("__letter"), F.col("__found.score")).otherwise(F.lit(0.0)))
        .drop("__found", "__letter")
    )
