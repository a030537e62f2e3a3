"""Quality classifier by positive-unlabelled learning: trusted positives, web text and an estimated class prior."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslog.llm.common import without
from obslog.llm.kernels import NON_SPACE, slices, word_hashes, words


@dataclass(frozen=True)
class QualityLearning:
    """Parameters. Features' means and deviations and the class prior's shares are taken over all
    rows of web text. Only the descent of the weights works on rows at the driver: at most
    about `most_positives` trusted rows and `most_unlabelled` rows of web text, chosen by a
    hash of id and text, of which rows that repeat both count once.

    `beta` is how far the estimated risk of negatives may fall below zero before a step
    undoes it; `ridge` shrinks the weights."""

    most_positives: int = 20_000
    most_unlabelled: int = 40_000
    steps: int = 300
    rate: float = 0.05
    ridge: float = 1e-4
    beta: float = 0.0
    seed: int = 5


def _byte_classes() -> np.ndarray:
    out = np.full(256, 7, np.int64)  # 7: other ASCII
    out[[ord(c) for c in ".,;:'\"!?()-"]] = 6
    out[48:58] = 2
    out[65:91] = 1
    out[97:123] = 0
    out[128:] = 3
    out[[32, 9, 11, 12]] = 4
    out[[10, 13]] = 5
    return out


_CLASS = _byte_classes()
_CLASSES = 8
FEATURES = _CLASSES + _CLASSES**2 + 8


def features(column: pa.Array) -> np.ndarray:
    """One row of features for each text: shares of byte classes and their pairs, and word and line statistics."""
    out = np.zeros((len(column), FEATURES), np.float32)
    for lo, hi, data, offsets in slices(column):
        n = hi - lo
        size = np.diff(offsets)
        row = np.repeat(np.arange(n), size)
        kind = _CLASS[data]
        out[lo:hi, :_CLASSES] = np.bincount(row * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, -1)
        if len(data) > 1:
            inside = row[1:] == row[:-1]
            pair = (row[1:] * _CLASSES + kind[:-1]) * _CLASSES + kind[1:]
            out[lo:hi, _CLASSES : _CLASSES + _CLASSES**2] = np.bincount(pair[inside], minlength=n * _CLASSES**2).reshape(n, -1)
        out[lo:hi, : _CLASSES + _CLASSES**2] /= np.maximum(size, 1)[:, None]
        starts, ends, first = words(data, offsets, NON_SPACE)
        count = np.diff(first)
        owner = np.repeat(np.arange(n), count)
        length = ends - starts
        hashes = word_hashes(data, starts, ends)
        order = np.lexsort((hashes, owner))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        per = np.maximum(count, 1)
        lines = np.bincount(row[data == 10], minlength=n) + 1
        stats = [
            np.log1p(size),
            np.log1p(count),
            np.bincount(owner, length, n) / per,
            np.sqrt(np.bincount(owner, length.astype(float) ** 2, n) / per),
            np.bincount(owner[order], new, n) / per,
            np.bincount(owner, length == 1, n) / per,
            np.log1p(lines),
            np.log1p(size / lines),
        ]
        out[lo:hi, _CLASSES + _CLASSES**2 :] = np.stack(stats, axis=1)
    return out


def standardised(x: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features in deviations from their means, and a column of ones."""
    z = np.clip((x - center) / scale, -8, 8)
    return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def reached(scores: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, int]:
    """How many scores reach each threshold, and how many there are."""
    return len(scores) - np.searchsorted(np.sort(scores), thresholds), len(scores)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


class QualityModel:
    """A logistic model of standardised features, fitted by non-negative unbiased risk.

    halves: which half (0 or 1) each positive and each unlabelled row belongs to, by default
    by turns. moments: means and deviations of the web text's features, by default those of
    the unlabelled rows. shares: of (center, scale, [(half, weights, thresholds)]) the counts
    of the web text's rows in that half that reach each threshold, and their number; by
    default those of the unlabelled rows."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray, p: QualityLearning, halves=None, moments=None, shares=None):
        self.p = p
        if not len(unlabelled):
            unlabelled = positive if len(positive) else np.zeros((1, FEATURES), np.float32)
            halves = moments = shares = None
        self.center, scale = moments or (unlabelled.mean(axis=0, dtype=np.float64), unlabelled.std(axis=0, dtype=np.float64))
        self.scale = np.maximum(scale, 1e-3)
        self.weights = np.zeros(FEATURES + 1)
        self.prior = 0.5
        if len(positive):
            pos, unl = self._ready(positive), self._ready(unlabelled)
            halves = halves or (np.arange(len(pos)) % 2, np.arange(len(unl)) % 2)
            shares = shares or (lambda center, scale, asked: [reached(unl[halves[1] == half] @ w, t) for half, w, t in asked])
            self.prior = self._class_prior(pos, unl, *halves, shares)
            self._fit(pos, unl)

    def _ready(self, x: np.ndarray) -> np.ndarray:
        return standardised(x, self.center, self.scale)

    def _class_prior(self, pos: np.ndarray, unl: np.ndarray, pos_half: np.ndarray, unl_half: np.ndarray, shares) -> float:
        """The share of positives in the unlabelled text: over regions that a positive-against-unlabelled
        model prefers, the least ratio of the unlabelled share to the positive share."""
        asked, of_positives = [], []
        for half in (0, 1):  # fitted on one half of the rows and read off the other
            p, u, other = pos[pos_half == half], unl[unl_half == half], pos[pos_half != half]
            if not len(p) or not len(u) or not len(other):
                continue
            w = self._descend(lambda w, p=p, u=u: (p.T @ (_sigmoid(p @ w) - 1) / len(p) + u.T @ _sigmoid(u @ w) / len(u)) / 2)
            a = np.sort(other @ w)
            t = a[(np.linspace(0.02, 0.8, 40) * (len(a) - 1)).astype(np.int64)]
            asked.append((1 - half, w, t))
            of_positives.append((len(a) - np.searchsorted(a, t)) / len(a))
        ratios = []
        for share_p, (counts, n) in zip(of_positives, shares(self.center, self.scale, asked) if asked else [], strict=True):
            if n:
                share_u = counts / n
                noise = np.sqrt(np.maximum(share_u * (1 - share_u), 1e-9) / n) / share_p
                ratios.append((share_u / share_p + noise).min())
        return float(np.clip(np.mean(ratios or [0.5]), 0.01, 0.99))

    def _descend(self, gradient) -> np.ndarray:
        """Adam from zero."""
        w, m, v = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
        for t in range(1, self.p.steps + 1):
            g = gradient(w) + self.p.ridge * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - self.p.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return w

    def _fit(self, pos: np.ndarray, unl: np.ndarray) -> None:
        prior = self.prior

        def gradient(w: np.ndarray) -> np.ndarray:
            zp, zu = pos @ w, unl @ w
            negative = _softplus(zu).mean() - prior * _softplus(zp).mean()
            of_negative = unl.T @ _sigmoid(zu) / len(unl) - prior * (pos.T @ _sigmoid(zp)) / len(pos)
            if negative < -self.p.beta:
                return -of_negative
            return prior * (pos.T @ (_sigmoid(zp) - 1)) / len(pos) + of_negative

        self.weights = self._descend(gradient)

    def score(self, column: pa.Array) -> np.ndarray:
        z = (self._ready(features(column)) * self.weights).sum(axis=1)  # row by row: the same in any company
        return np.round(_sigmoid(z), 9)


def fit_quality(trusted: DataFrame, web: DataFrame, p: QualityLearning = QualityLearning(), id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """A model from the ids of trusted rows (`trusted`) and the documents that may be learned from (`web`).

    Three reads of `web`: for the moments of its features, for the rows that the descent
    works on, and for the class prior's shares. Trusted ids that `web` lacks teach nothing.
    Without any, every score is 0.5. Rows with a null id teach nothing; a null text is an
    empty one."""
    place = lambda salt, *of: F.pmod(F.xxhash64(F.lit(p.seed + salt), *of), F.lit(1 << 30))
    half = F.pmod(F.xxhash64(F.lit(p.seed + 3), F.col(id_col)), F.lit(2)).cast("int").alias("half")
    rows = web.select(F.col(id_col), F.col(text_col), half).where(F.col(id_col).isNotNull())
    ids = trusted.select(F.col(id_col)).where(F.col(id_col).isNotNull()).distinct()

    def part(df: DataFrame, most: int, salt: int, *of: str) -> DataFrame:
        n = df.agg(F.approx_count_distinct(F.xxhash64(*of), 0.02)).first()[0]  # rows that repeat don't thin out the others
        return df if n <= most else df.where(place(salt, *of) < int((1 << 30) * most / n))

    def bounded(df: DataFrame, most: int, salt: int) -> DataFrame:
        once = df.withColumn("__text", F.xxhash64(text_col)).dropDuplicates([id_col, "__text"])
        return part(once, most, salt, id_col, "__text")

    chosen = F.broadcast(part(ids, p.most_positives, 1, id_col))  # a bounded number of ids
    positives = bounded(rows.join(chosen, id_col, "left_semi"), p.most_positives, 4)  # of which an id may have many texts
    unlabelled = bounded(part(rows.withColumn("__text", F.xxhash64(text_col)), p.most_unlabelled, 2, id_col, "__text"), p.most_unlabelled, 5)
    (pos_half, pos), (unl_half, unl) = _matrix(positives, text_col), _matrix(unlabelled, text_col)
    return QualityModel(pos, unl, p, (pos_half, unl_half), _moments(rows, text_col), lambda *asked: _shares(rows, text_col, *asked))


def _matrix(rows: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Halves and features of a bounded number of rows, in an order of their own."""

    def run(batches):
        for batch in batches:
            x = features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["half", "x"])

    found = sorted((bytes(r.x), r.half) for r in rows.select("half", text_col).mapInArrow(run, "half int, x binary").collect())
    return np.array([h for _, h in found], np.int64), np.frombuffer(b"".join(x for x, _ in found), np.float32).reshape(len(found), FEATURES)


_UNIT = 1 << 20


def _moments(rows: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Means and deviations of the features over all rows. Tasks' sums are added as whole numbers of 2**-20, in which order makes no difference."""

    def run(batches):
        n, first, second = 0, np.zeros(FEATURES), np.zeros(FEATURES)
        for batch in batches:
            x = features(batch.column(0)).astype(np.float64)
            n, first, second = n + len(x), first + x.sum(axis=0), second + (x * x).sum(axis=0)
        whole = lambda v: pa.array([Decimal(round(float(x) * _UNIT)) for x in v], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES), pa.int32()), pa.array(np.full(FEATURES, n)), whole(first), whole(second)], ["i", "n", "a", "b"])

    sums = rows.select(text_col).mapInArrow(run, "i int, n long, a decimal(38,0), b decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
    sums = sorted(sums, key=lambda r: r.i)
    if not sums or not sums[0].n:
        return None
    mean, square = (np.array([float(r[k]) / _UNIT / r.n for r in sums]) for k in ("a", "b"))
    return mean, np.sqrt(np.maximum(square - mean * mean, 0))


def _shares(rows: DataFrame, text_col: str, center: np.ndarray, scale: np.ndarray, asked: list) -> list[tuple[np.ndarray, int]]:
    """What `reached` tells of all rows of each asked half."""
    shared = rows.sparkSession.sparkContext.broadcast((center, scale, asked))

    def run(batches):
        center, scale, asked = shared.value
        totals = [np.zeros(len(t) + 1, np.int64) for _, _, t in asked]
        for batch in batches:
            of, x = batch.column(0).to_numpy(), standardised(features(batch.column(1)), center, scale)
            for total, (half, w, t) in zip(totals, asked, strict=True):
                counts, n = reached(x[of == half] @ w, t)
                total += np.append(counts, n)
        for i, total in enumerate(totals):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), i), pa.int32()), pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["i", "j", "n"])

    sums = {(r.i, r.j): r.n for r in rows.select("half", text_col).mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()}
    return [(np.array([sums.get((i, j), 0) for j in range(len(t))]), sums.get((i, len(t)), 0)) for i, (_, _, t) in enumerate(asked)]


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from 0.5 on), which replace columns of these names.

    A null text is scored as an empty one. Equal texts get equal scores. No rows give none.
    No row is moved."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(texts))

    return without(docs, "score", "predicted").withColumn("score", score(F.col(text_col))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
