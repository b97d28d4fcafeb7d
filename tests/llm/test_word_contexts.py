import math
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pitlane.llm import pitman_yor as L
from pitlane.llm import queries
from pitlane.llm import word_contexts as W
from tests.llm.cases import AWKWARD, WORDS, frame
from tests.llm.test_pitman_yor import base_of, outline, tokens_of

SMALL = {"bucket_tokens": 40, "least": 3, "frequent": 0.05, "frequent_pair": 0.01}


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 1


def pairs_of(text):
    words = tokens_of(text)
    return [*zip(words, [b"", *words[:-1]], strict=True)]


def test_any_word_before_is_a_context(spark):
    """300 words, each followed by one of its own: held-out texts are much likelier in that order than shuffled."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        some = rng.integers(0, 300, 40)
        if held_out(i):
            rows += [(i, " ".join(f"a{k} b{k}" for k in some)), (i, " ".join(f"a{k} b{j}" for k, j in zip(some, np.roll(some, 1), strict=True)))]
        else:
            rows.append((i, " ".join(f"a{k} b{k}" for k in some)))
    folder = tempfile.mkdtemp(prefix="pitlane-test-")
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    scores = defaultdict(list)
    for r in queries.op7_lm_scoring(spark, folder).collect():
        if r.held_out:
            scores[r.doc_id].append((r.score, r.base_score))
    assert scores and all(len(x) == 2 for x in scores.values())
    for (a, base), (b, other) in scores.values():
        assert abs(a - b) > 40 and base == pytest.approx(other)


def test_counts_and_base_on_awkward_rows(spark):
    docs = frame(spark, AWKWARD)
    for sizes in ({}, SMALL):
        got = W.score(docs, W.train(docs, **sizes))
        assert outline(got) == base_of([r[:2] for r in AWKWARD])
        assert all(r.score < 0 and r.held_out == (r.doc_id is not None and held_out(r.doc_id)) for r in got.collect())


def test_without_training_texts(spark):
    assert W.score(frame(spark, []), W.train(frame(spark, []))).collect() == []
    held = next(i for i in range(100) if held_out(i))
    docs = frame(spark, [(held, "a b c"), (held, None)])
    assert sorted((r.n_tokens, r.n_known, r.base_score, r.score) for r in W.score(docs, W.train(docs)).collect()) == [(1, 0, 0.0, 0.0), (4, 0, 0.0, 0.0)]


@pytest.mark.parametrize("sizes", [{"least": 1, "frequent": 0.05}, {**SMALL, "bucket_tokens": 150}])
def test_scores_are_means_of_predictive_probabilities(spark, monkeypatch, sizes):
    """Every text's score in plain Python from the samples' seats; words cut into parts or not."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice([*WORDS, f"rare{i}"], 40))) for i in range(60)]
    docs = frame(spark, rows)
    steps, parents = [], []
    staged, parent_of = W.staged, W._parents
    monkeypatch.setattr(W, "staged", lambda df, name: steps.append((name, staged(df, name))) or steps[-1][1])
    monkeypatch.setattr(W, "unstage", lambda spent: None)
    monkeypatch.setattr(W, "_parents", lambda *x: parents.append((x[2], parent_of(*x))) or parents[-1][1])
    model = W.train(docs, **sizes)
    m, (given, parent) = model.words, parents[-1]
    assert (len(m.hot) > 0) == ("frequent_pair" in sizes) and len(parent.samples) == L.SAMPLES
    table = {r["bucket"]: W.Bucket.of(r.asDict()) for name, df in steps if name == "pairs" for r in df.collect()}
    asked = [df for name, df in steps if name == "asked"][-1].collect()
    own, seats, tables = {}, {}, defaultdict(lambda: np.zeros(L.SAMPLES))
    for r in asked:
        b = table[r.bucket]
        if r.part is None:
            c = W._loose(r.seats).reshape(2, L.SAMPLES, -1)
            many = iter(b.n[b.n > 1] - given.discount * W._loose(r.own) / L.SAMPLES)
            for w, u, n in zip(b.words[b.word], b.contexts[b.at], b.n, strict=True):
                own[int(w), int(u)] = next(many) if n > 1 else n * (1 - given.discount)
            for i, w in enumerate(b.words):
                seats[int(w)] = c[:, :, i]
        else:
            customers, *saved = W._loose(r.numbers).reshape(1 + L.SAMPLES, -1)
            for i, u in enumerate(W._loose(r.contexts, rising=True)):
                tables[int(u)] += [customers[i] - s[i] for s in saved]
    hot = {int(k): int(o) for k, o in zip(m.hot, m.owner, strict=True)}
    for k, o in hot.items():
        assert (parent.customers[:, o] >= seats.get(k, np.zeros((2, L.SAMPLES)))[0]).all()
    counts = Counter(p for d, t in rows if not held_out(d) for p in pairs_of(t))
    customers = Counter()
    for (_, u), n in counts.items():
        customers[u] += n
    ranks = {int(k): i for i, k in enumerate(m.vocabulary.keys)}
    words = len({w for w, _ in counts})
    every = sum(tables.values())
    assert every == pytest.approx([t.parent_customers for t in parent.samples])

    def probability(w, u):
        code = np.array([ranks.get(k, L._RARE + k) for k in (L.key(u), L.key(w))])
        k = int(W._routed(m, code)[0][1])
        c, t = (parent.customers[:, hot[k]], parent.tables[:, hot[k]]) if k in hot else seats[k]
        p = 0.0
        for s, x in enumerate(parent.samples):
            up = (c[s] - x.parent_discount * t[s] + (L.STRENGTH + x.parent_discount * x.parent_tables) / (words + 1)) / (L.STRENGTH + x.parent_customers)
            p += (L.STRENGTH + given.discount * tables[L.key(u)][s]) * up / L.SAMPLES
        return (own[k, L.key(u)] + p) / (L.STRENGTH + customers[u])

    texts = dict(rows)
    assert outline(W.score(docs, model)) == base_of(rows)
    for r in W.score(docs, model).collect():
        assert r.score == pytest.approx(sum(math.log10(probability(*p)) for p in pairs_of(texts[r.doc_id])), rel=1e-9)
    pairs = {}
    for r in model.table.collect():
        pairs |= dict(zip(W._loose(r["pairs"], rising=True).tolist(), (W._loose(r["log_p"]) / W._FINE).tolist(), strict=True))
    assert len(pairs) == len({p for _, t in rows for p in pairs_of(t)})


def test_predictions_sum_to_one_after_any_word(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(WORDS, 30))) for i in range(100)]
    held = next(i for i in range(1000, 1100) if held_out(i))
    vocabulary = [*sorted(set(WORDS)), "neverseen"]
    rows += [(held, f"{u} {w}") for u in vocabulary for w in vocabulary] + [(held, u) for u in vocabulary]
    docs = frame(spark, rows)
    model = W.train(docs, **{**SMALL, "bucket_tokens": 150})
    log_p = {}
    for r in model.table.collect():
        log_p |= dict(zip(W._loose(r["pairs"], rising=True).tolist(), (W._loose(r["log_p"]) / W._FINE).tolist(), strict=True))
    ranks = {int(k): i for i, k in enumerate(model.words.vocabulary.keys)}
    for u in vocabulary:
        total = 0.0  # over all words, the end and an unknown word
        for w in [*vocabulary, ""]:
            code = np.array([ranks.get(k, L._RARE + k) for k in (L.key(u.encode()), L.key(w.encode()))])
            total += 10 ** log_p[int(W.pair(*W._routed(model.words, code))[1])]
        assert total == pytest.approx(1, rel=1e-8)


def test_chunks_partitions_and_local_pairs_do_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(8)
    docs = frame(spark, [(i, " ".join(rng.choice([*WORDS, f"rare{i % 50}"], 40))) for i in range(150)])
    one = {r.doc_id: r.score for r in W.score(docs, W.train(docs, frequent_pair=1.0)).collect()}
    monkeypatch.setattr(L, "CHUNK", 300)
    monkeypatch.setattr(W, "HELD", 100)
    other = docs.repartition(5)
    two = {r.doc_id: r.score for r in W.score(other, W.train(other, frequent_pair=1e-9)).collect()}
    assert one.keys() == two.keys() and all(two[k] == pytest.approx(v, rel=1e-9) for k, v in one.items())
    # cut words draw other seats, so scores agree but for the sampling
    cut = W.train(docs, bucket_tokens=500, least=2, frequent=0.01)
    assert len(cut.words.hot) > 10
    three = {r.doc_id: r.score for r in W.score(docs, cut).collect()}
    assert all(three[k] == pytest.approx(v, rel=0.03) for k, v in one.items())


def test_cells_drawn_together_and_one_after_another_agree():
    """The auxiliary draw of the parent's probability leaves the distribution of the tables as it is."""
    rng = np.random.default_rng(4)
    n, per = np.tile(rng.integers(2, 30, 40), 300), np.full(300, 40)
    totals = L.Totals(np.zeros(1), np.zeros(1), 5e4, 2e4, 0.7, 0.5, 1e-3)
    means = []
    for bound in (128, 10):
        got = L.seat(per, None, n, totals, [7], 20, 10, np.full(len(n), 200.0), None, bound)
        means.append((got.tables.mean(), got.parent_customers.std(axis=1).mean()))
    assert means[0][0] == pytest.approx(means[1][0], rel=0.02)
    assert means[0][1] == pytest.approx(means[1][1], rel=0.12)


def test_keys_of_many_words_at_once():
    """Words of every size up to and beyond a stripe of XXH64, any white space, null and empty texts."""
    rng = np.random.default_rng(6)
    letters = np.frombuffer(b" \t\n\v\f\raZ\xc3\xa9\x00\x1c\x85" + b"xyQ" * 9, np.uint8)
    texts = [None, b"", b" \n", b"A", *(rng.choice(letters, k).tobytes() for k in rng.integers(0, 3000, 60)), *(b"x" * k + b" " + b"Y" * (k % 9) for k in range(80))]
    words = [L.words_of(t) for t in texts]
    keys, sizes = L.word_keys(texts)
    assert sizes.tolist() == [len(w) for w in words] and keys.tolist() == [L.key(x) for w in words for x in w]
    got = list(L.blocks(pa.array(texts * 40, pa.binary())))
    assert len(got) > 1 and np.concatenate([k for _, k, _ in got]).tolist() == keys.tolist() * 40
    assert [i for at, _, _ in got for i in range(at.start, at.stop)] == list(range(len(texts) * 40))


def test_ranks_of_frequent_words():
    rng = np.random.default_rng(7)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 56, 3000), (1 << 40) + np.arange(50), [0, (1 << 56) - 1]]))
    other = rng.integers(0, 1 << 56, 5000)
    for some in (rng.permutation(keys), keys[:1], keys[:0]):
        m = W.Words(L.Vocabulary(some, np.ones(len(some), np.int64), 0, 0, 0, 1), np.ones(len(some), np.int64), keys[:0], keys[:0], 1)
        ranks = {int(k): i for i, k in enumerate(some)}
        wanted = np.concatenate([keys, other])
        assert W._coder(m)(wanted).tolist() == [ranks.get(k, L._RARE + k) for k in wanted.tolist()]


def test_tokens_of_one_share_of_the_texts_travel_at_a_time(spark, monkeypatch):
    """The other share is done, its shuffles gone, before the last one starts; every row is scored once."""
    rng = np.random.default_rng(9)
    rows = [(i if i % 7 else None, " ".join(rng.choice(WORDS, 30))) for i in range(300)] + [(3, "a b")] * 5 + [(None, None)] * 3
    docs = frame(spark, rows)
    steps, staged = [], W.staged
    monkeypatch.setattr(W, "staged", lambda df, name: steps.append((name, staged(df, name))) or steps[-1][1])
    model = W.train(docs, **SMALL)
    got = W.score(docs, model)
    (done,) = (df for name, df in steps if name == "scores")
    assert 0.3 * len(rows) < done.count() < 0.7 * len(rows)
    assert outline(got) == base_of(rows)
