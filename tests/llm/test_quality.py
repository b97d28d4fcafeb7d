import zlib
from itertools import pairwise

import numpy as np
import pytest

from pitlane.llm import quality as Q
from pitlane.llm.common import table
from tests.llm.cases import AWKWARD, frame

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


def test_held_out_accuracy(spark, given):
    docs, labels = given
    got = Q.quality(docs, Q.train(docs, labels))
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    one, zero = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in one for b in zero]) > 0.98
    assert got.count() == docs.count()


def test_held_out_labels_do_not_matter(spark, given):
    docs, labels = given
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    a, b = (Q.quality(docs, Q.train(docs, x)).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_awkward_rows(spark, given):
    model = Q.train(*given)
    got = Q.quality(frame(spark, AWKWARD), model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert Q.quality(frame(spark, []), model).collect() == []


def test_without_labels(spark, given):
    docs, labels = given
    for rows, score in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        got = Q.quality(docs, Q.train(docs, rows)).collect()
        assert len(got) == docs.count() and all(r.score == pytest.approx(score, abs=1e-3) for r in got)


def test_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = Q.fit(x, y, np.ones(500), rounds=120, pairs=2)
    assert (0, 1) in model.pairs  # the interaction, which no single statistic shows
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.85
    for row, score in zip(x[:20], model.score(x), strict=False):
        z = model.base
        for f in range(4):
            z += model.tables[f][sum(c <= row[f] for c in model.cuts[f])]
        for (a, b), t in zip(model.pairs, model.pair_tables, strict=True):
            z += t[sum(c <= row[a] for c in model.pair_cuts[a]), sum(c <= row[b] for c in model.pair_cuts[b])]
        assert score == pytest.approx(1 / (1 + np.exp(-z)))


def test_tree_takes_the_best_splits():
    g, h = np.array([5.0, 5.0, -4.0, -4.0, 9.0]), np.ones(5)
    out = Q._tree(g, h, 3)
    assert len(set(out[:2])) == len(set(out[2:4])) == 1 and len(set(out)) == 3
    best = max(
        sum(g[a:b].sum() ** 2 / (h[a:b].sum() + Q.SMOOTH) for a, b in pairwise((0, i, 5))) for i in range(1, 5)
    )
    two = Q._tree(g, h, 2)
    assert sum(g[two == v].sum() ** 2 / (h[two == v].sum() + Q.SMOOTH) for v in set(two)) == pytest.approx(best)


def test_statistics_are_of_the_whole_text():
    words = b"some plain words here " * 20_000
    assert Q.statistics(words + b"!!! " * 20_000)[4] > Q.statistics(words)[4] == 0
    assert Q.statistics(None) == Q.statistics(b" \n") == [0.0] * len(Q.STATISTICS)
