"""Operators 1 and 5: held-out accuracy on generated text, and what they learn from."""

import random
import zlib

import numpy as np
from edge import TEXTS, edge_docs, empty_docs, labels

from raw2clean.llm import op01_toxicity as o1
from raw2clean.llm import op05_quality as o5


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def corpus(spark, n=1500, seed=1):
    rnd = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        words = ["".join(rnd.choice("aeioustrnml") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(10, 120))]
        toxic, junk = rnd.random() < 0.15, rnd.random() < 0.15
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(["vileword", "hateword", "scornword"]) + rnd.choice([",", "", "."]))
        text = " ".join(words)
        rows.append((i, "!! ".join(words).upper() + " ## $$" if junk else text.capitalize() + "."))
        if rnd.random() < 0.6:
            marks.append((i, int(not junk), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), labels(spark, marks), marks


def outcome(df, marks, at):
    got = {r.doc_id: r for r in df.collect()}
    held = [(got[m[0]], m[at]) for m in marks if got[m[0]].held_out]
    return got, [g.predicted for g, y in held if y == 1], [g.predicted for g, y in held if y == 0]


def test_toxicity_on_held_out_documents(spark):
    docs, y, marks = corpus(spark)
    got, bad, clean = outcome(o1.classify(docs, y), marks, 2)
    assert len(got) == 1500 and np.mean(bad) >= 0.9 and np.mean(clean) <= 0.02
    assert all(g.held_out == (fold(i, 3) == 1) and g.predicted == int(g.score >= 0.7) and 0 <= g.score <= 1 for i, g in got.items())


def test_toxicity_learns_from_its_folds_only(spark):
    docs, y, marks = corpus(spark, 400)
    other = labels(spark, [(i, q, 1 - t if fold(i, 3) == 1 else t) for i, q, t in marks])
    score = lambda of: {r.doc_id: round(r.score, 9) for r in o1.classify(docs, of).collect()}
    assert score(y) == score(other)


def test_non_negative_risk_beats_its_prior():
    rng = np.random.default_rng(1)
    word = lambda k: np.unique(np.array([k], np.uint64))
    common = [np.unique(rng.integers(1000, 1100, 8).astype(np.uint64)) for _ in range(1000)]
    positive = [np.union1d(word(7), c) for c in common[:100]]
    unlabelled = [np.union1d(word(7), c) if k % 10 == 0 else c for k, c in enumerate(common[100:])]
    words = np.append(word(7), np.arange(1000, 1005).astype(np.uint64))   # what is left after telling_words, and a little noise
    m = o1.train(words, positive, unlabelled, 0.1)
    rows = lambda s: (np.repeat(np.arange(len(s)), [len(x) for x in s]), np.concatenate(s), len(s))
    assert m.score(*rows(positive)).min() > 0.7 and m.score(*rows([c for k, c in enumerate(unlabelled) if k % 10])).max() < 0.3
    assert o1.train(words, [], unlabelled, 0.1).score(np.zeros(0, int), np.zeros(0, np.uint64), 2).round(6).tolist() == [0.1, 0.1]


def test_quality_on_held_out_documents(spark):
    docs, y, marks = corpus(spark)
    got, clean, junk = outcome(o5.classify(docs, y), marks, 1)
    assert len(got) == 1500 and np.mean(clean) >= 0.98 and np.mean(junk) <= 0.02
    assert all(g.held_out == (fold(i, 5) == 0) and g.predicted == int(g.score >= 0.3) and 0 <= g.score <= 1 for i, g in got.items())


def test_quality_learns_from_its_folds_only(spark):
    docs, y, marks = corpus(spark, 400)
    other = labels(spark, [(i, 1 - q if fold(i, 5) == 0 else q, t) for i, q, t in marks])
    score = lambda of: {r.doc_id: round(r.score, 6) for r in o5.classify(docs, of).collect()}
    assert score(y) == score(other)


def test_discriminant_is_the_gaussian_one():
    rng = np.random.default_rng(2)
    x = [rng.multivariate_normal([0, 0], [[1, .5], [.5, 1]], 400), rng.multivariate_normal([2, 1], [[2, 0], [0, .5]], 600)]
    moments = lambda rows: (np.array([400, 600]), np.array([a.sum(0) for a in rows]), np.array([a.T @ a for a in rows]))
    m = o5.Discriminant.over(*moments(x), 0.0)
    m = m.fit(*moments([m.damped(a) for a in x]), 0.0)
    at = rng.normal(size=(50, 2))

    def density(a, p):
        c = np.cov(a.T, bias=True)
        d = p - a.mean(0)
        return -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.log(np.linalg.det(c)) + np.log((len(a) + 1) / 1002)
    assert np.allclose(m.score(at), 1 / (1 + np.exp(density(x[0], at) - density(x[1], at))))


def test_short_texts_are_drawn_to_the_mean():
    m = o5.Discriminant(np.zeros(3), np.ones(3), 200.0)
    z = m.damped(np.array([[np.log1p(199.0), 2.0, -4.0], [0.0, 2.0, 2.0], [np.log1p(1e6), 2.0, 1.0]]))
    assert np.allclose(z[0], [np.log1p(199.0), 1.0, -2.0]) and z[1, 1] < 0.02 and z[2, 1] > 1.999


def test_statistics_do_not_depend_on_the_batch():
    import pyarrow as pa

    from raw2clean.llm.common import text_buffer
    texts = [t or "" for _, t, _ in TEXTS]
    together = o5.statistics(*text_buffer(pa.array(texts)))
    assert np.isfinite(together).all()
    assert np.allclose(together, np.concatenate([o5.statistics(*text_buffer(pa.array([t]))) for t in texts]))


def test_odd_cases(spark):
    marks = labels(spark, [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (2, 1, 0), (99, 0, 1), (6, 5, 5)])
    for o in (o1, o5):
        out = o.classify(edge_docs(spark), marks).collect()
        assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 for r in out)
        assert len({r.score for r in out if r.doc_id in (3, 4)}) == 1
        assert o.classify(edge_docs(spark), marks.limit(0)).count() == len(TEXTS)
        assert o.classify(empty_docs(spark), marks).count() == 0
