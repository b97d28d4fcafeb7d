import zlib

import numpy as np
import pytest

from pitlane.llm import toxicity as T
from pitlane.llm.common import table
from tests.llm.cases import AWKWARD, WORDS, frame


def corpus(n=600):
    """Every fifth text has one to five of the words that make it toxic."""
    rng = np.random.default_rng(5)
    bad = ["vile", "rotten", "hateful", "nasty"]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(WORDS, rng.integers(5, 60)))
        if i % 5 == 0:
            words += list(rng.choice(bad, rng.integers(1, 6)))
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    return T.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_learns_the_telling_words(spark, model):
    rows, labels = corpus()
    got = {r.doc_id: r for r in T.toxicity(frame(spark, rows), model).collect()}
    assert all(got[i].rejected == bool(toxic) for i, _, toxic in labels)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    kept = T.drop_toxic(frame(spark, rows), model)
    assert kept.columns == frame(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, toxic in labels if not toxic]


def test_thresholds_are_ordered_and_severity_adds_up(spark, model):
    assert (np.diff(model.theta) > 0).all() and len(model.theta) == 3
    cache = T._Cache(model.index)
    mild, severe = model.reach("vile lorem ipsum", cache), model.reach("vile rotten hateful nasty", cache)
    assert (np.diff(mild) <= 0).all() and severe.sum() > mild.sum() > model.reach("lorem ipsum", cache).sum()
    r = T.toxicity(frame(spark, [(1, "vile rotten hateful nasty")]), model).first()
    assert r.severity == pytest.approx(severe.sum()) and r.p_toxic == pytest.approx(severe[0])


def test_awkward_rows(spark, model):
    got = T.toxicity(frame(spark, AWKWARD), model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in AWKWARD)
    assert not any(r.rejected for r in got)
    assert T.toxicity(frame(spark, []), model).collect() == []


def test_whole_text_is_read(spark, model):
    long = " ".join(WORDS * 5000) + " vile rotten hateful nasty"
    assert T.toxicity(frame(spark, [(1, long)]), model).first().rejected


def test_gradients_reach_the_optimum():
    """The fitted cumulative-link model has a smaller loss than perturbed ones."""
    rng = np.random.default_rng(1)
    rows = [[f for f in range(6) if rng.random() < 0.4] for _ in range(400)]
    truth, theta = np.array([2.0, -1.0, 1.0, 0.0, 0.5, 3.0]), np.array([1.0, 3.0])
    score = np.array([truth[r].sum() for r in rows]) + rng.logistic(size=400)
    grades = (score > theta[0]).astype(int) + (score > theta[1])
    w, t = T.fit(rows, grades, np.ones(400), 6, ridge=0.0, steps=3000)

    def loss(w, t):
        eta = np.array([w[r].sum() for r in rows])
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        s = lambda z: 1 / (1 + np.exp(-z))
        return -np.log(s(eta - edges[grades]) - s(eta - edges[grades + 1])).mean()

    best = loss(w, t)
    for k in range(6):
        for d in (-0.05, 0.05):
            assert loss(w + d * np.eye(6)[k], t) > best
    assert loss(w, t + [0.05, 0]) > best and loss(w, t - [0, 0.05]) > best


def test_without_labels_nothing_is_rejected(spark):
    rows, _ = corpus(20)
    for labels in ([], [(1, 1, 0), (2, 0, 0)], [(None, 1, 1), (3, 1, None)]):
        model = T.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        got = T.toxicity(frame(spark, rows), model).collect()
        assert len(got) == 20 and not any(r.rejected for r in got) and all(r.severity == 0 for r in got)


def test_held_out_accuracy_on_given_labels(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    got = T.toxicity(docs, T.train(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    clean = [r for r in got if r.toxic == 0]
    assert sum(r.rejected for r in clean) <= 0.03 * len(clean)
    assert sum(r.rejected for r in got if r.toxic) >= 0.4 * sum(r.toxic for r in got)
