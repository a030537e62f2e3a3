"""Toxicity: the automaton against edit distances, and a model on invented prose with planted abuse."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obslog.llm import toxicity as T
from obslog.llm.fuzzy import DISGUISE, FuzzyTrie, edits_allowed


def distance(a, b):
    """Edits of `a` to `b`: letters added, left out, changed (free behind a disguise), or two neighbours swapped."""
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                d[i][j] = i + j
                continue
            same = a[i - 1] == b[j - 1] or DISGUISE.get(a[i - 1]) == b[j - 1] or a[i - 1] == "*"
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (not same))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[len(a)][len(b)]


def plain(terms, word):
    """(edits, the terms it may be) of a word: exact, then the longest open one, then the fewest edits."""
    exact = [k for k, (t, o) in enumerate(terms) if not o and distance(word, t) == 0]
    if exact:
        return 0, exact
    opened = [k for k, (t, o) in enumerate(terms) if o and len(word) > len(t) and all(a == b or DISGUISE.get(a) == b or a == "*" for a, b in zip(word, t, strict=False))]
    if opened:
        longest = max(len(terms[k][0]) for k in opened)
        return 0, [k for k in opened if len(terms[k][0]) == longest]
    near = [(distance(word, t), k) for k, (t, o) in enumerate(terms) if not o and distance(word, t) <= edits_allowed(t)]
    return (min(near)[0], [k for e, k in near if e == min(near)[0]]) if near else (0, [-1])


@pytest.mark.parametrize("seed", range(4))
def test_the_automaton_is_the_edit_distance(seed):
    rng = random.Random(seed)
    letters = "abcé"
    terms = sorted({("".join(rng.choice(letters) for _ in range(rng.randint(3, 11))), rng.random() < 0.25) for _ in range(12)})
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 13))) for _ in range(400)]
    for t, _ in terms:
        for _ in range(60):
            w = list(t)
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(w))
                kind = rng.randrange(5)
                if kind == 0:
                    w[i] = rng.choice(letters + "4*x")
                elif kind == 1 and len(w) > 1:
                    del w[i]
                elif kind == 2:
                    w.insert(i, rng.choice(letters))
                elif kind == 3 and i:
                    w[i - 1], w[i] = w[i], w[i - 1]
                else:
                    w.append(rng.choice(letters))
            words.append("".join(w))
    term, edits = FuzzyTrie(terms).match(words)
    for w, k, e in zip(words, term.tolist(), edits.tolist(), strict=True):
        want, which = plain(terms, w)
        assert k in which and e == want, (w, k, e, want, which, terms)


def test_an_empty_lexicon_and_no_words():
    assert FuzzyTrie([]).match(["a", ""])[0].tolist() == [-1, -1]
    assert FuzzyTrie([("abc", False)]).match([])[0].tolist() == []


ABUSE = ["gromulent", "wuzzleface", "snarfing", "blaggard", "drizzlord"]


@pytest.fixture(scope="module")
def corpus(prose):
    """(doc_id, text, toxic): every fifth document abuses; one of these has a thousand copies."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        words = prose(i, 60).split()
        if i % 5 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(ABUSE))
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    copied = rows[0][1]
    return rows + [(1000 + i, copied, 1) for i in range(1000)]


@pytest.fixture(scope="module")
def model(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus], "doc_id long, toxic int")
    return T.fit_toxicity(labels, docs)


def test_the_lexicon_is_the_planted_one(model):
    """A text with a thousand copies doesn't make its own words toxic."""
    assert {w for w, o in model.terms if not o} >= set(ABUSE)
    assert model.texts[0] == 120 and 475 <= model.texts[1] <= 480  # a few share their least run of words by chance
    assert all(any(a.startswith(w) for a in ABUSE) for w, _ in model.terms)


def test_abuse_is_told_from_clean_text_and_from_quotation(model, prose):
    rng = random.Random(1)

    def with_(put, n=2):
        out = []
        for i in range(60):
            words = prose(5000 + i, 60).split()
            for _ in range(n):
                words.insert(rng.randrange(len(words)), put(rng.choice(ABUSE)))
            out.append(" ".join(words))
        return np.array(model.score(pa.array(out)) >= 0.5).mean()

    assert with_(lambda w: w) == 1
    assert with_(lambda w: "zzz") == 0
    assert with_(lambda w: w[:2] + w[3:]) > 0.9  # a letter left out
    assert with_(lambda w: w[:2] + w[3] + w[2] + w[4:]) > 0.9  # two swapped
    assert with_(lambda w: w[:1] + "*" + w[2:]) == 1
    assert with_(lambda w: w.upper()) == 1
    assert with_(lambda w: f'they said "{w}" as a word') < 0.1
    assert with_(lambda w: f"the word “{w}” means") < 0.1


def test_rows_of_every_kind_are_scored(spark, model):
    rows = [(1, None), (1, None), (None, ""), (2, "gromulent snarfing " * 100_000), (3, "x" * 2_000_000), (4, "!!! *** @@ $"), (5, "you blaggard drizzlord")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("old")).withColumn("term", F.lit(1))
    out = T.score_toxicity(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    told = {r.doc_id: r.predicted for r in out}
    assert told[2] == 1 and told[5] == 1 and told[1] == told[3] == told[4] == told[None] == 0
    assert T.score_toxicity(docs.limit(0), model).count() == 0


def test_without_labels_everything_is_clean(spark, table):
    docs = table([(1, "a b c"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(None, 1), (1, None), (9, 1), (1, 0)], "doc_id long, toxic int")
    for labels in (none, odd):
        fitted = T.fit_toxicity(labels, docs)
        assert fitted.terms == [] and {r.predicted for r in T.score_toxicity(docs, fitted).collect()} == {0}


def test_both_labels_and_repeated_rows(spark, prose):
    rows = [(i, f"{prose(i, 30)} {'snarfing' if i % 3 == 0 else ''}") for i in range(90)]
    docs = spark.createDataFrame(rows + rows[:9], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(0, 0), (0, 1), (3, 1)], "doc_id long, toxic int")
    fitted = T.fit_toxicity(labels, docs)
    assert fitted.texts == (30, 60) and ("snarfing", False) in fitted.terms


def test_open_terms_match_what_begins_so(spark, prose):
    rng = random.Random(2)
    rows = [(i, f"{prose(i, 40)} " + (" ".join("kwex" + rng.choice(["ab", "on", "il", "ur", "em"]) + rng.choice(["to", "ra", "mi", "su"]) for _ in range(2)) if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    fitted = T.fit_toxicity(labels, docs)
    assert ("kwex", True) in fitted.terms
    assert fitted.score(pa.array(["a kwexbrandnew b kwexother c", "a b c"])).round().tolist() == [1, 0]


def test_held_out_documents_of_the_test_tables(spark):
    from obslog.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = QUERIES["op13_toxicity"](spark, sf).where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    caught = [r.predicted for r in out if r.toxic]
    clean = [r.predicted for r in out if not r.toxic]
    assert np.mean(caught) > 0.9 and np.mean(clean) < 0.01
