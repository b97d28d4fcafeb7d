import hashlib
import re
from collections import Counter, defaultdict

from pitlane.llm import exact_dedup as X
from pitlane.llm.common import table
from tests.llm.cases import AWKWARD, frame


def digest_of(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def expected(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[digest_of(text)].append(doc)
    out = Counter()
    for sha, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            out[i, ids[0], len(ids), k == 0, sha] += 1
    return out


def result(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_awkward_rows(spark):
    assert result(X.exact_dedup(frame(spark, AWKWARD))) == expected([r[:2] for r in AWKWARD])


def test_frequent_digests_are_split_off(spark):
    rows = [(i, "copy" if i % 3 else f"text {i % 50}") for i in range(900)]
    docs = frame(spark, rows).repartition(7)
    assert result(X.exact_dedup(docs, counters=31, share=0.1)) == expected(rows)
    kept = X.drop_duplicates(docs, counters=31, share=0.1)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in expected(rows) if r[3])


def test_misra_gries_misses_no_frequent_digest(spark):
    values = [bytes([i % 7]) if i % 2 else i.to_bytes(4, "big") for i in range(5000)]
    digests = spark.createDataFrame([(v,) for v in values], "digest binary").repartition(5)
    found = {bytes(r.digest) for r in X.frequent_digests(digests, counters=63, share=0.05).collect()}
    assert found >= {v for v, n in Counter(values).items() if n >= 0.05 * len(values)}
    assert len(found) <= 1 / (0.05 - 1 / 64)


def test_empty_table(spark):
    empty = frame(spark, [])
    assert X.exact_dedup(empty).collect() == [] and X.drop_duplicates(empty).collect() == []


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert result(X.exact_dedup(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])
