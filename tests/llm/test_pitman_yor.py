import math
import zlib
from collections import Counter

import numpy as np
import pytest

from pitlane.llm import pitman_yor as L
from pitlane.llm.common import table
from tests.llm.cases import AWKWARD, WORDS, frame

SMALL = {"anchors": 4, "frequent": 0.05, "bucket_tokens": 500, "least": 3}


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b""]


def base_of(rows):
    """n_tokens, n_known, train_tokens and base score of each row by the contract's formula."""
    train = [t for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 5 != 1]
    counts = Counter(w for t in train for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in rows:
        words = tokens_of(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((doc, len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)))
    return sorted(out, key=str)


def outline(df):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def test_counts_and_base_on_awkward_rows(spark):
    docs = frame(spark, AWKWARD)
    for sizes in ({}, SMALL):
        got = L.score(docs, L.train(docs, **sizes))
        assert outline(got) == base_of([r[:2] for r in AWKWARD])
        assert all(r.score < 0 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in got.collect())


def test_predictions_sum_to_one_in_every_context(spark):
    """With every word in the table of frequent ones, over all words and the unknown one."""
    rng = np.random.default_rng(3)
    docs = frame(spark, [(i, " ".join(rng.choice(WORDS, 30))) for i in range(200)])
    model = L.train(docs, anchors=4, frequent=1e-9, bucket_tokens=500, least=3)
    assert len(model.vocabulary.keys) == model.vocabulary.words == len(set(WORDS)) + 1 and model.log_p.shape[1] == 5
    unknown = np.mean([t.strengths * L._parent(0.0, 0.0, t) / (L.STRENGTH + t.customers) for t in model.totals.samples], axis=0)
    assert (10**model.log_p).sum(axis=0) + unknown == pytest.approx(np.ones(5))


def test_words_score_alike_where_they_are_read_and_in_buckets(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    scores = []
    for frequent in (1e-9, 0.01):
        model = L.train(docs, anchors=0, frequent=frequent, bucket_tokens=10**9, least=1)
        scores.append({r.doc_id: r.score for r in L.score(docs, model).collect()})
    assert all(scores[1][k] == pytest.approx(v, rel=1e-9) for k, v in scores[0].items())


def test_draws_follow_the_seating_distribution():
    """Table counts drawn for one restaurant against all partitions of its customers."""
    n, d, strength, parent = 5, 0.4, 2.5, 0.3
    weights = np.zeros(n + 1)

    def partitions(k, sizes):
        if k == n:
            chance = strength ** len(sizes) * parent ** len(sizes)
            for s in sizes:
                for j in range(1, s):
                    chance *= j - d
            weights[len(sizes)] += chance
            return
        for i in range(len(sizes)):
            partitions(k + 1, [*sizes[:i], sizes[i] + 1, *sizes[i + 1 :]])
        partitions(k + 1, [*sizes, 1])

    partitions(0, [])
    rng = np.random.default_rng(0)
    m = 40_000
    t = L._draw(np.full(m, n), 8, np.full(m, strength), lambda i: np.full((m, i.shape[1]), parent), d, rng)
    assert np.bincount(t, minlength=n + 1) / m == pytest.approx(weights / weights.sum(), abs=0.01)


def log_stirling(n, d):
    """log S(n, k) for k = 1..n by the plain recursion."""
    s = np.full(n + 2, -np.inf)
    s[1] = 0.0
    for m in range(1, n):
        stay = np.log(np.maximum(m - np.arange(n + 2) * d, 1e-300)) + s
        s[1:] = np.logaddexp(s[:-1], stay[1:])
        s[0] = -np.inf
    return s[1 : n + 1]


@pytest.mark.parametrize("n", [33, 200, 2000, 5000])
@pytest.mark.parametrize("d, strength", [(0.7, 0.5), (0.7, 5.0), (0.5, 5.0), (0.8, 20.0), (0.3, 200.0), (0.9, 3e4)])
def test_tables_of_many_customers_follow_the_exact_distribution(n, d, strength):
    """Also with a parent that grows with its customers."""
    k = np.arange(1, n + 1)
    exact = log_stirling(n, d)
    m = 20_000
    for weight in (lambda i: 0.0 * i + 1.0, lambda i: (3.0 + i) / 50.0):
        logs = exact + np.cumsum(np.log(strength * weight(np.arange(n))))
        chance = np.exp(logs - logs.max())
        chance /= chance.sum()
        mean = (chance * k).sum()
        sd = math.sqrt((chance * (k - mean) ** 2).sum())
        rng = np.random.default_rng(n)
        got = L._draw(np.full(m, n), 1 << 62, np.full(m, strength), lambda i: np.broadcast_to(weight(i), (m, i.shape[1])), d, rng)
        assert got.min() >= 1 and got.max() <= n
        assert abs(got.mean() - mean) < 6 * sd / math.sqrt(m) + 0.01 * sd + 0.002 * mean
        assert abs(got.std() - sd) < 0.06 * sd + 0.02
        # the whole distribution: largest distance of the two distribution functions
        seen = np.cumsum(np.bincount(got, minlength=n + 1)[1:]) / m
        assert np.abs(seen - np.cumsum(chance)).max() < 0.05


@pytest.mark.parametrize("d", [0.2, 0.5, 0.8, 0.95])
def test_ratios_of_stirling_numbers(d):
    ratios = L.Ratios(d)
    for n in (33, 50, 333, 2048, 3000, 6000):
        exact = np.diff(log_stirling(n, d))
        t = np.arange(1, n)
        number = np.array([[n]])
        got = ratios.log(number.astype(float), t[None, :].astype(float), ratios.row(number))[0]
        assert np.abs(got - exact).max() < 0.05 and np.abs(got - exact)[: n // 2].mean() < 0.005


def test_exact_and_many_agree_at_the_bound():
    """Nothing changes where the one way of drawing gives way to the other."""
    m, d, strength = 40_000, 0.6, 4.0
    means = []
    for most in (L.EXACT, 1 << 62):
        rng = np.random.default_rng(2)
        means.append(L._draw(np.full(m, L.EXACT), most, np.full(m, strength), lambda i: np.full((m, i.shape[1]), 0.5), d, rng).mean())
    assert means[0] == pytest.approx(means[1], rel=0.02)


def test_stirling_numbers():
    s = np.exp(L.stirling(0.3, 6))
    assert s[3, 1] == pytest.approx(0.7 * 1.7) and s[3, 2] == pytest.approx(0.7 + 1.4) and s[3, 3] == pytest.approx(1.0)


def test_contexts_are_the_last_anchor():
    assert L.contexts(np.array([9, 1, 9, 9, 0, 1, 9]), 2).tolist() == [2, 2, 1, 1, 1, 0, 1]


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = L.score(docs, L.train(docs))
    assert outline(got) == base_of([(r.doc_id, r.text) for r in docs.collect()])
    held = {r.held_out: r for r in L.perplexity(got).collect()}
    assert held[True].perplexity < 0.8 * held[True].base_perplexity


def test_chunks_and_partitions_do_not_matter(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    one = {r.doc_id: r.score for r in L.score(docs, L.train(docs)).collect()}
    monkeypatch.setattr(L, "CHUNK", 3000)
    other = docs.repartition(5)
    two = {r.doc_id: r.score for r in L.score(other, L.train(other)).collect()}
    assert one.keys() == two.keys() and all(two[k] == pytest.approx(v, rel=1e-9) for k, v in one.items())


def test_without_training_texts(spark):
    assert L.score(frame(spark, []), L.train(frame(spark, []))).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    docs = frame(spark, [(held, "a b c"), (held, None)])
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in L.score(docs, L.train(docs)).collect()) == [(1, 0, 0, 0.0, 0.0), (4, 0, 0, 0.0, 0.0)]


def test_large_restaurants_of_a_word_are_redrawn_one_after_another(monkeypatch):
    """Each given the others: no draw holds two restaurants of one word, nor do the parent's counts lag behind."""
    calls = []
    draw = L._draw

    def spy(n, most, strength, weight, discount, rng):
        t = draw(n, most, strength, weight, discount, rng)
        calls.append((n.tolist(), t.tolist(), weight(np.zeros((1, 1), np.int64))[:, 0].tolist()))
        return t

    monkeypatch.setattr(L, "_draw", spy)
    n, contexts = np.array([1000, 2000, 3000]), 3
    totals = L.Totals(np.full(contexts, 1e4), np.full(contexts, 1e3), 3e3, 100.0, 0.8, 0.5, 1e-3)
    L.seat(np.array([3]), np.arange(contexts, dtype=np.uint8), n, totals, [1], 0, 1)
    assert [c[0] for c in calls[:3]] == [[1000], [2000], [3000]]
    (a,), (b,), (c,) = (x[1] for x in calls[:3])
    others = np.rint(n**0.8)
    had = [others[1] + others[2], a + others[2], a + b]
    seated = np.rint(others.sum() ** 0.5)
    strength = totals.parent_strength * totals.base
    want = [(h - 0.5 * min(seated, h) + strength) / (L.STRENGTH + 3e3) for h in had]
    assert [x[2][0] for x in calls[:3]] == pytest.approx(want)
    assert calls[3][0] == [a + b + c]


def test_scores_are_means_of_predictive_probabilities(spark):
    """Every text's score in plain Python from the samples of one bucket: each sample's own seats and totals, probabilities averaged."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice([*WORDS, f"rare{i}"], 40))) for i in range(60)]
    docs = frame(spark, rows)
    model = L.train(docs, anchors=3, frequent=0.03, bucket_tokens=10**9, least=1)
    v, given = model.vocabulary, model.totals.given
    rank = {int(k): i for i, k in enumerate(v.keys[: v.anchors])}

    def pairs(text):
        last = v.anchors
        for w in tokens_of(text):
            k = L.key(w)
            yield k, last
            last = rank.get(k, last)

    counts = Counter(c for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1 for c in pairs(t))
    cells = sorted(counts)
    words = sorted({k for k, _ in cells})
    per = Counter(k for k, _ in cells)
    got = L.seat(np.array([per[k] for k in words]), np.array([u for _, u in cells], np.uint8), np.array([counts[c] for c in cells]), given, [L.SEED, L.PASSES, 0], L.BURN, L.SAMPLES)
    customers = Counter()
    for (_, u), n in counts.items():
        customers[u] += n

    def probability(k, u):
        p = []
        for s in range(L.SAMPLES):
            tables = {c: int(t) for c, t in zip(cells, got.tables[s], strict=True)}
            here = sum(t for c, t in tables.items() if c[1] == u)
            seated = {w: (int(c), int(t)) for w, c, t in zip(words, got.parent_customers[s], got.parent_tables[s], strict=True)}
            c0, t0 = (sum(x[i] for x in seated.values()) for i in (0, 1))
            assert c0 == sum(tables.values())
            c, t = seated.get(k, (0, 0))
            parent = (c - given.parent_discount * t + (L.STRENGTH + given.parent_discount * t0) / (len(words) + 1)) / (L.STRENGTH + c0)
            own = counts[k, u] - given.discount * tables.get((k, u), 0)
            p.append((own + (L.STRENGTH + given.discount * here) * parent) / (L.STRENGTH + customers[u]))
        return sum(p) / len(p)

    memo = {}
    for r in L.score(docs, model).collect():
        want = sum(math.log10(memo.setdefault(c, probability(*c))) for c in pairs(dict(rows)[r.doc_id]))
        assert r.score == pytest.approx(want, rel=1e-9)


def test_seatings_are_averaged_over_four_samples():
    assert (L.BURN, L.SAMPLES) == (2, 4)


def test_tokens_reach_their_buckets_through_groups(spark, monkeypatch):
    """Many buckets, chunks and tasks: rows of the first step number chunks x groups at most, and scores stay."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").repartition(6)
    sizes = {"anchors": 0, "frequent": 0.01, "bucket_tokens": 10**9}
    one = {r.doc_id: r.score for r in L.score(docs, L.train(docs, least=1, **sizes)).collect()}
    assert [L._width(b) for b in (1, 2, 9, 10, 48)] == [1, 2, 3, 4, 7]
    monkeypatch.setattr(L, "CHUNK", 2000)
    model = L.train(docs, least=10, **sizes)
    texts = docs.selectExpr("doc_id", "false held_out", "cast(text as binary) text")
    packed = texts.mapInArrow(L._pack(model), L._PACKED)
    rows = packed.where("docs is null").selectExpr("grp", "piece", "chunk").collect()
    assert {r.grp for r in rows} == {0, 1, 2} and len(rows) == len({(r.grp, r.chunk) for r in rows})
    dealt = packed.groupBy("grp", "piece").applyInArrow(L._deal(model.vocabulary), L._DEALT).where("docs is null").select("bucket", "grp", "piece").collect()
    assert {r.bucket for r in dealt} == set(range(10)) and all(r.bucket // 4 == r.grp for r in dealt)
    assert len(dealt) == len({(r.bucket, r.piece) for r in dealt}) < len({r.chunk for r in rows}) * 10
    # other buckets draw other seats, so scores agree but for the sampling
    two = {r.doc_id: r.score for r in L.score(docs, model).collect()}
    assert one.keys() == two.keys() and all(two[k] == pytest.approx(v, rel=0.02) for k, v in one.items())
