"""The pipeline's stages against brute force, and the registered queries."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from pitlane.llm import queries as Q
from pitlane.llm.common import staged, table
from tests.llm.cases import AWKWARD, frame
from tests.llm.test_exact_dedup import digest_of
from tests.llm.test_mixing import targets_of
from tests.llm.test_packing import check as check_packing
from tests.llm.test_simhash import classes_of, fingerprint_of

SF = "/root/testdata/sf0.001"
STAGE = dict(C.STAGES)


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def stages(spark):
    """The documents and what every stage returned."""
    out = [table(spark, SF, "documents")]
    for name, stage in C.STAGES:
        out.append(staged(stage(spark, out[-1], SF), name))
    return out


def test_names_and_columns(spark, stages):
    assert [n for n, _ in C.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mixing", "packing"]
    assert all(s.dtypes == stages[0].dtypes for s in stages[1:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    before, after = ({r[0] for r in rows_of(s)} for s in stages[:2])
    assert after <= before
    clean = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in clean) >= 0.97 * len(clean)
    model = Q.toxicity.train(stages[0], table(spark, SF, "labels"))
    cache = Q.toxicity._Cache(model.index)
    assert after == {i for i, t, _ in rows_of(stages[0]) if model.reach(t, cache)[0] < 0.5}


def test_exact_and_near_duplicates(spark, stages):
    rows = rows_of(stages[1])
    first = {}
    for doc, text, _ in sorted(rows):
        first.setdefault(digest_of(text), doc)
    assert sorted(r[0] for r in rows_of(stages[2])) == sorted(first.values())
    rows = rows_of(stages[2])
    prints = {doc: fingerprint_of(text) for doc, text, _ in rows}
    roots = classes_of(prints.values())
    least = {}
    for doc in sorted(prints):
        least.setdefault(roots[prints[doc]], doc)
    assert sorted(r[0] for r in rows_of(stages[3])) == sorted(least.values())


def test_mixing_repeats_documents_towards_the_targets(spark, stages):
    rows, mixed = rows_of(stages[3]), rows_of(stages[4])
    copies = Counter(mixed)
    assert set(copies) <= set(rows) and max(copies.values()) <= 2
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[2]] += words(r[1])
        longest[r[2]] = max(longest[r[2]], words(r[1]))
        taken[r[2]] += copies[r] * words(r[1])
    for source, target in targets_of(sizes).items():
        assert abs(taken[source] - target) <= longest[source]


def test_packing_takes_every_row_of_the_mix(spark, stages):
    used, tokens = check_packing([r[:2] for r in rows_of(stages[4])], stages[5].collect())
    assert used <= math.ceil(tokens / 4096) + 1


def test_run_is_the_stages_in_turn(spark, stages):
    got = C.run(spark, SF).drop("sequence_id", "offset")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, stages[-1].drop("sequence_id", "offset").collect()))


def test_awkward_documents_pass_every_stage(spark):
    for docs in (frame(spark, AWKWARD), frame(spark, AWKWARD).limit(0)):
        for name, stage in C.STAGES:
            out = staged(stage(spark, docs, SF), name)
            if name != "packing":
                assert out.columns == docs.columns
            docs = out


def test_every_operator_is_registered():
    names = set(E.queries())
    assert {n for q in names if (n := (re.match(r"op(\d+)_", q) or [None])[0])} == {f"op{i}_" for i in range(1, 14)}
    assert "pipeline" in names and set(Q.ORACLE) <= names


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = Q.QUERIES[name](spark, SF), con.sql(Q.ORACLE[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    assert Counter(tuple(r[c] for c in order) for r in got.collect()) == Counter(
        tuple(r[want.columns.index(c)] for c in order) for r in want.fetchall()
    )
