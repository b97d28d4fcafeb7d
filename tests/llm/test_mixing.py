import re
from collections import defaultdict

import pytest

from pitlane.llm import mixing as M
from pitlane.llm.common import table
from tests.llm.cases import AWKWARD, frame


def targets_of(sizes, weights=(5, 2, 1), volume=1.5, repeat=2):
    """Reshare the excess by weight until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = volume * sum(sizes.values()), set()
    while True:
        rest = total - sum(repeat * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        share = {s: repeat * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        above = {s for s in names if s not in capped and share[s] > repeat * sizes[s]}
        if not above:
            return share
        capped |= above


def check(rows, got, slack=1.0):
    sizes, longest = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        longest[source] = max(longest[source], n)
    want = targets_of(sizes)
    assert len(got) == len(rows)
    taken, by_target = defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by_target[r.source_size, round(r.target, 3)] = by_target.get((r.source_size, round(r.target, 3)), 0) + r.taken
    assert {k for k in by_target} == {(n, round(want[s], 3)) for s, n in sizes.items()}
    assert sorted(r.size for r in got) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows)
    return sizes, want, by_target


def test_awkward_rows(spark):
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "s") for r in AWKWARD]
    check(rows, M.mix(frame(spark, rows)).collect())


def test_given_documents_come_near_their_targets(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = M.mix(docs).collect()
    sizes, want, taken = check(rows, got)
    for s, n in sizes.items():
        assert taken[n, round(want[s], 3)] == pytest.approx(want[s], rel=0.01)
    again = M.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_rates_solve_the_balancing_problem(spark):
    """At the solution every source's tilted words meet its target."""
    rows = [(i, "w " * (1 + i * i % 90), f"s{i % 4}") for i in range(300)]
    docs = frame(spark, rows)
    cells = docs.select("source", M.size().alias("size")).groupBy("source", "size").count().withColumnRenamed("count", "n")
    sources = cells.groupBy("source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "docs")
    sizes = defaultdict(int)
    for _, text, s in rows:
        sizes[s] += len(text.split())
    sources = sources.join(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), "source")
    sources = M.targets(sources)
    want = {r.source: (r.target, r.source_size) for r in sources.collect()}
    for tilt in (0.0, 0.25, 1.0):
        for r in M.balance(cells, sources, tilt=tilt).collect():
            target, whole = want[r.source]
            if r.full:
                assert target == pytest.approx(2 * whole)
                continue
            total = 0.0
            for _, text, s in rows:
                n = len(text.split())
                if s == r.source:
                    total += n * min(2.0, 2.718281828459045 ** (r.multiplier * (n / max(r.mean, 1.0)) ** tilt))
            assert total == pytest.approx(target, rel=1e-6)


def test_mixed_repeats_rows(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(60)] + [(5, "w " * 6, "b")] * 3
    docs = frame(spark, rows)
    got, out = M.mix(docs).collect(), M.mixed(docs)
    assert out.columns == docs.columns
    assert sum(len(r.text.split()) for r in out.collect()) == sum(r.taken for r in got)


def test_one_class_with_many_documents_is_split_into_cells(spark):
    rows = [(i, "a b c", "x") for i in range(4000)] + [(i, "d", "y") for i in range(4000, 4100)]
    check(rows, M.mix(frame(spark, rows)).collect())


def test_empty_and_wordless_tables(spark):
    assert M.mix(frame(spark, [])).collect() == []
    assert [(r.size, r.target, r.taken) for r in M.mix(frame(spark, [(1, " ", "a"), (2, None, None)])).collect()] == [(0, 0.0, 0)] * 2


def test_a_balance_that_does_not_converge_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_STEPS", 1)
    rows = [(i, "word " * (1 + i % 7), "abc"[i % 3]) for i in range(60)]
    with pytest.raises(RuntimeError, match="after 1 steps"):
        M.mix(frame(spark, rows)).collect()
