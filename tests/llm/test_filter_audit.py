import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlane.llm import filter_audit as A
from pitlane.llm.common import table
from tests.llm.cases import AWKWARD, frame

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(rows, labels):
    """rows: (doc_id, text, source); every order applied to every document."""
    good, toxic = ({d for d, q, t in labels if (q, t)[k] == 1 and d is not None} for k in (0, 1))
    ids: dict[str, list] = {}
    for d, text, _ in rows:
        ids.setdefault(text or "", []).append(d)
    docs = []
    for d, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "".join(
            k
            for k, f in {
                "A": len(words) < 50,
                "B": 100 * len(set(words)) < 65 * len(words),
                "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                "D": bool(re.search(r"[#$%&*|]", text)),
                "E": d is not None and any(x is not None and x < d for x in ids[text]),
            }.items()
            if f
        )
        docs.append((source or "", fails, d in good, d in toxic))
    out = {}
    for part in {x[0] for x in docs}:
        own, shapley = [x[1:] for x in docs if x[0] == part], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                hit = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                out[part, order, step] = [len(left), len(hit), sum(f in x[0] for x in gone), sum(x[0] == f for x in own), sum(x[1] for x in hit), sum(x[2] for x in hit)]
                gone = gone + hit
                shapley[f] += len(hit)
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(shapley[f])
    return {k: tuple(v) for k, v in out.items()}


def result(df):
    assert df.columns == COLUMNS
    got = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got}
    assert len(out) == len(got)
    return out


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))


LABELS = [(1, 1, 0), (4, None, 1), (4, 1, None), (6, 1, 1), (9, 0, 1), (9, 0, 0), (None, 1, 1), (77, 1, 1), (102, 1, 0), (103, 0, 1)]


def made(n, seed):
    rnd = random.Random(seed)
    vocabulary = ["alpha", "beta", "Gamma", "DELTA", "e#", "über", "x|y", "z"] + [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.choice([3, 49, 50, 80]))) for _ in range(n // 2)]
    return [(100 + i, rnd.choice(texts), rnd.choice(["a", "b", "", None, "naïve"])) for i in range(n)]


def test_ranks_are_lexicographic():
    assert [A.rank(o) for o in A.ORDERS] == list(range(120))
    for length in range(1, 6):
        for prefix in map("".join, permutations("ABCDE", length)):
            assert A.rank(prefix) == min(k for k, o in enumerate(A.ORDERS) if o.startswith(prefix))


def test_intervals_cover_each_order_once():
    for mask in range(32):
        covered = np.zeros(120, int)
        for m, _, first, last in A.intervals():
            if m == mask:
                covered[first:last] += 1
        assert (covered == (mask > 0)).all()


@pytest.mark.parametrize("share", [0.001, 0.05, 1.0])
def test_as_every_order_applied(spark, share):
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "s") for r in AWKWARD] + made(150, 1) + [(i, "copy", "a") for i in range(300, 340)]
    docs = frame(spark, rows).withColumn("part", F.lit("p")).withColumn("mask", F.lit("m")).repartition(5)
    docs = docs.where(F.lit(True))
    assert result(A.filter_audit(docs, labelled(spark, LABELS), share)) == brute([(r.doc_id, r.text, r.source) for r in docs.collect()], LABELS)


def test_empty_tables(spark):
    assert A.filter_audit(frame(spark, []), labelled(spark, LABELS)).collect() == []
    rows = [(1, "a", "s"), (2, None, None)]
    assert result(A.filter_audit(frame(spark, rows), labelled(spark, []))) == brute([(1, "a", "s"), (2, None, None)], [])


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_given_documents_and_sql(spark, sf):
    d = f"/root/testdata/sf{sf}"
    got = result(A.filter_audit(table(spark, d, "documents"), table(spark, d, "labels")))
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.sql(A.SQL)
    assert want.columns == COLUMNS
    assert got == {tuple(r[:3]): tuple(r[3:]) for r in want.fetchall()}
    if sf == "0.001":
        rows = [(r.doc_id, r.text, r.source) for r in table(spark, d, "documents").collect()]
        assert got == brute(rows, [tuple(r) for r in table(spark, d, "labels").select("doc_id", "quality", "toxic").collect()])
