import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obslog.llm.language_id import LanguageId, fit_language_id, identify_languages, ngram_buckets
from obslog.llm.quality import FEATURES, QualityLearning, QualityModel, _moments, features, fit_quality, score_quality

SF = "/root/testdata/sf0.01"


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_held_out_languages(spark):
    docs = docs_of(spark)
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = fit_language_id(docs.where(third != 1))
    assert model.langs == ["de", "en", "es", "fr"]
    rows = identify_languages(docs.where(third == 1), model).select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_counts_are_those_of_all_training_rows(spark, table):
    rows = [(1, "Abab", "aa", "s", 4), (2, "éé b", "bb", "s", 4), (3, "abab", "aa", "s", 4), (4, None, "aa", "s", 0), (5, "zz", None, "s", 2)]
    p = LanguageId(orders=(1, 2), smoothing=1.0)
    model = fit_language_id(table(rows).repartition(3), p)
    assert model.langs == ["aa", "bb"]
    counts = np.ones((2, p.buckets))
    for i, text in ((0, "Abab"), (0, "abab"), (1, "éé b")):
        for _, _, _, buckets in ngram_buckets(pa.array([text]), p):
            np.add.at(counts[i], buckets, 1)
    assert np.allclose(model.log_p, np.log(counts / counts.sum(axis=1, keepdims=True)))
    assert np.allclose(model.prior, np.log(np.array([3, 2]) / 5))


def letters_of(text):
    """Characters with A-Z as a-z, and other ASCII than letters as a space."""
    return "".join(c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or ord(c) > 127 else " " for c in text)


def grams_of(text, orders=(1, 2, 3)):
    t = letters_of(text)
    return [t[i : i + n] for n in orders for i in range(len(t) - n + 1) if t[i : i + n].strip(" ")]


def test_predictions_equal_naive_bayes_over_plain_ngrams(spark):
    """With so many buckets that hardly two n-grams share one, the prediction is that of counts by n-gram."""
    rows = docs_of(spark).where("text IS NOT NULL AND lang IS NOT NULL").orderBy("doc_id").limit(260).collect()
    train, test = rows[:120], [r for r in rows[120:] if any(c.isalpha() for c in r.text)]
    p = LanguageId(buckets=1 << 20)
    model = fit_language_id(spark.createDataFrame(train, "doc_id long, text string, lang string, source string, n_chars long"), p)
    counts, docs = {}, Counter(r.lang for r in train)
    for r in train:
        counts.setdefault(r.lang, Counter()).update(grams_of(r.text))
    total = {x: sum(c.values()) + p.smoothing * p.buckets for x, c in counts.items()}
    n_docs = sum(docs.values()) + p.smoothing * len(docs)

    def posterior(text, lang):
        grams = grams_of(text)
        like = sum(math.log((counts[lang][g] + p.smoothing) / total[lang]) for g in grams)
        prior = math.log((docs[lang] + p.smoothing) / n_docs)
        return like + prior, (like + prior) * min(1, p.evidence / len(grams))

    got = {r.doc_id: (r.lang_pred, r.score) for r in identify_languages(spark.createDataFrame(test, "doc_id long, text string, lang string, source string, n_chars long"), model).collect()}
    for r in test:
        both = {x: posterior(r.text, x) for x in counts}
        best = max(sorted(both), key=lambda x: both[x][0])
        top = max(t for _, t in both.values())
        assert got[r.doc_id][0] == best
        assert got[r.doc_id][1] == pytest.approx(math.exp(both[best][1] - top) / sum(math.exp(t - top) for _, t in both.values()), abs=0.02)


def test_language_edge_cases(spark, table):
    model = fit_language_id(table([(1, "the cat sat", "en", "s", 1), (2, "le chat noir", "fr", "s", 1)]))
    df = table([(1, None), (2, ""), (3, "12 345 !?"), (4, "the cat"), (4, "the cat"), (None, "le chat"), (7, "the cat " * 20000)]).withColumn("score", F.lit("old"))
    got = [(r.doc_id, r.lang_pred, r.score) for r in identify_languages(df, model).collect()]
    assert [g[1] for g in got] == ["und", "und", "und", "en", "en", "fr", "en"]
    assert [g[2] for g in got[:3]] == [0.0] * 3 and got[3] == got[4]
    assert identify_languages(table([]), model).collect() == []
    nothing = fit_language_id(table([]))
    assert [r.lang_pred for r in identify_languages(df, nothing).collect()] == ["und"] * 7
    with pytest.raises(ValueError):
        fit_language_id(table([(1, "a", "x", "s", 1), (2, "b", "y", "s", 1)]), LanguageId(most_languages=1))


def test_quality_of_held_out_rows(spark):
    docs, labels = docs_of(spark), spark.read.parquet(f"{SF}/labels.parquet")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = fit_quality(labels.where((third != 1) & (F.col("quality") == 1)), docs.where(third != 1))
    assert 0.6 < model.prior < 0.95
    rows = score_quality(docs.where(third == 1), model).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.93 * len(rows)
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert np.mean([np.mean([g > b for g in good]) for b in bad]) > 0.95


def test_risk_stays_non_negative():
    rng = np.random.default_rng(0)
    pos = rng.normal(1, 1, (400, FEATURES)).astype(np.float32)
    neg = rng.normal(-1, 1, (400, FEATURES)).astype(np.float32)
    model = QualityModel(pos[:200], np.concatenate([pos[200:], neg]), QualityLearning())
    assert abs(model.prior - 1 / 3) < 0.15
    score = lambda x: 1 / (1 + np.exp(-model._ready(x) @ model.weights))
    assert (score(pos[200:]) > 0.5).mean() > 0.9 and (score(neg) < 0.5).mean() > 0.9


def test_quality_edge_cases(spark, table):
    df = table([(1, None), (2, ""), (3, "Good words here."), (3, "Good words here."), (None, "!!! $$$"), (6, "word " * 30000)]).withColumn("predicted", F.lit("old"))
    trained = fit_quality(spark.createDataFrame([(3,), (3,), (99,), (None,)], "doc_id long"), df)
    rows = score_quality(df, trained).collect()
    assert rows[0].score == rows[1].score and rows[2].score == rows[3].score
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert score_quality(table([]), trained).collect() == []
    untrained = fit_quality(spark.createDataFrame([], "doc_id long"), table([]))
    assert {r.score for r in score_quality(df, untrained).collect()} == {0.5}


def test_features_do_not_depend_on_neighbours():
    texts = ["Some text.\nTwo lines", None, "", "ÉÉ !!", "x" * 5000]
    together = features(pa.array(texts, pa.string()))
    alone = np.concatenate([features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)


def plain_features(text):
    """The features of one text, character class by character class."""
    b = (text or "").encode()
    kind = lambda c: 0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if c > 127 else 4 if c in (32, 9, 11, 12) else 5 if c in (10, 13) else 6 if chr(c) in ".,;:'\"!?()-" else 7
    ks = [kind(c) for c in b]
    n = max(len(b), 1)
    out = [ks.count(k) / n for k in range(8)]
    pairs = Counter(zip(ks, ks[1:], strict=False))
    out += [pairs[i, j] / n for i in range(8) for j in range(8)]
    ws = [w for w in re.split(rb"[\x20\x09-\x0d]+", b) if w]
    m = max(len(ws), 1)
    fold = lambda w: bytes(c + 32 if 65 <= c <= 90 else c for c in w)
    lines = b.count(b"\n") + 1
    out += [math.log1p(len(b)), math.log1p(len(ws)), sum(map(len, ws)) / m, math.sqrt(sum(len(w) ** 2 for w in ws) / m), len(set(map(fold, ws))) / m, sum(len(w) == 1 for w in ws) / m, math.log1p(lines), math.log1p(len(b) / lines)]
    return out


def test_features_and_moments_equal_plain_ones(spark, table):
    texts = [r.text for r in docs_of(spark).orderBy("doc_id").limit(60).collect()] + [None, "", "É a A\n\tb", "\x0b\x0c!$"]
    want = np.array([plain_features(t) for t in texts])
    assert np.allclose(features(pa.array(texts, pa.string())), want, atol=1e-4)
    mean, deviation = _moments(table(list(enumerate(texts))).repartition(3), "text")
    assert np.allclose(mean, want.mean(axis=0), atol=1e-4) and np.allclose(deviation, want.std(axis=0), atol=1e-3)


def test_model_equals_a_plain_fit(spark):
    """Every number of the model again, in plain loops over the same rows."""
    docs = docs_of(spark).where("doc_id < 300")
    p = QualityLearning(steps=40)
    trusted = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND doc_id < 300").select("doc_id")
    model = fit_quality(trusted, docs, p)
    rows = docs.select("doc_id", "text", F.pmod(F.xxhash64(F.lit(p.seed + 3), "doc_id"), F.lit(2)).alias("half")).collect()
    x = features(pa.array([r.text for r in rows], pa.string())).astype(np.float64)
    good = {r.doc_id for r in trusted.collect()}
    half, is_pos = np.array([r.half for r in rows]), np.array([r.doc_id in good for r in rows])
    z = np.clip((x - x.mean(axis=0)) / np.maximum(x.std(axis=0), 1e-3), -8, 8)
    z = np.concatenate([z, np.ones((len(z), 1))], axis=1)
    sigma = lambda v: 1 / (1 + np.exp(-v))

    def descend(gradient):
        w, m, v = (np.zeros(z.shape[1]) for _ in range(3))
        for t in range(1, p.steps + 1):
            g = gradient(w) + p.ridge * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
            w = w - p.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return w

    ratios = []
    for h in (0, 1):
        a, u = z[is_pos & (half == h)], z[half == h]
        w = descend(lambda w, a=a, u=u: np.mean((sigma(a @ w) - 1)[:, None] * a, axis=0) / 2 + np.mean(sigma(u @ w)[:, None] * u, axis=0) / 2)
        sp, su = np.sort(z[is_pos & (half != h)] @ w), z[half != h] @ w
        found = []
        for q in np.linspace(0.02, 0.8, 40):
            t = sp[int(q * (len(sp) - 1))]
            share_p, share_u = np.mean(sp >= t), np.mean(su >= t)
            found.append(share_u / share_p + np.sqrt(max(share_u * (1 - share_u), 1e-9) / len(su)) / share_p)
        ratios.append(min(found))
    prior = np.mean(ratios)
    assert model.prior == pytest.approx(prior, abs=0.02)

    def risk_gradient(w):
        zp, zu = z[is_pos] @ w, z @ w
        negative = np.mean(np.log1p(np.exp(zu))) - model.prior * np.mean(np.log1p(np.exp(zp)))
        of_negative = np.mean(sigma(zu)[:, None] * z, axis=0) - model.prior * np.mean(sigma(zp)[:, None] * z[is_pos], axis=0)
        return -of_negative if negative < 0 else model.prior * np.mean((sigma(zp) - 1)[:, None] * z[is_pos], axis=0) + of_negative

    w = descend(risk_gradient)
    got = {r.doc_id: r.score for r in score_quality(docs, model).collect()}
    assert all(got[r.doc_id] == pytest.approx(s, abs=0.02) for r, s in zip(rows, sigma(z @ w), strict=True))


def test_rows_that_reach_the_driver_are_bounded_where_ids_repeat(spark, prose, monkeypatch):
    """One id on thousands of rows, of one text and of many."""
    from obslog.llm import quality

    sizes = []
    real = quality._matrix
    monkeypatch.setattr(quality, "_matrix", lambda rows, text: (lambda out: (sizes.append(len(out[0])), out)[1])(real(rows, text)))
    rows = [(1, "the same text")] * 3000 + [(2, prose(i, 4)) for i in range(3000)] + [(i, prose(i, 6)) for i in range(10, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    trusted = spark.createDataFrame([(1,), (2,), (10,), (11,)], "doc_id long")
    fit_quality(trusted, docs, QualityLearning(most_positives=10, most_unlabelled=50, steps=5))
    assert 1 <= sizes[0] <= 40 and 20 <= sizes[1] <= 120, sizes
