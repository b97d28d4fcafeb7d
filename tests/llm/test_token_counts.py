import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitlane.llm import token_counts as T
from pitlane.llm.common import table
from tests.llm.cases import AWKWARD, frame

NAME = "byte_bpe_50k.json"
PLAIN = Tokenizer.from_file(str(public_tokenizers.path(NAME)))


def plain(text):
    return len(PLAIN.encode(text or "", add_special_tokens=False).ids)


def expected(rows, limit=512):
    return Counter((i, len((t or "").encode()), plain(t), plain(t) > limit) for i, t in rows)


def result(df):
    return Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect())


SPACES = ["", " ", "  ", "\n", " \n", "\n ", "\t\t", "a  b", "a\n\nb", "a \nb ", " a\r\n b\v\f c", "a \nb", "x 　 y", " \n", "a\x1c\nb", "\x85\n\x85"]
SPECIAL = ["<|endoftext|>", "a <|endoftext|>  b", "tail  <|endoftext|>", "<|endoftext|><|endoftext|>\n x", "<|endoftext", "x\n<|endoftext|>\ny"]


def fuzz(n, seed):
    rnd = random.Random(seed)
    parts = ["the", "don't", "we'LL", "12", "3.5", "Grüße", "日本語", "🙂🏽", "é", "İ", "ß", "‍", "क़", "_", "--", "'", "'s", "ʼs", "�", "\x00", " ", " ", "<|endoftext|>", "x" * 40]
    gaps = ["", "", " ", " ", " ", "  ", "\n", "\t", " \n", "\r\n", "\n  "]
    return ["".join(rnd.choice(parts) + rnd.choice(gaps) for _ in range(rnd.randrange(1, 12))) for _ in range(n)]


def test_awkward_texts_as_the_plain_tokenizer(spark):
    rows = [r[:2] for r in AWKWARD] + list(enumerate(SPACES + SPECIAL + fuzz(3000, 1), 100))
    docs = frame(spark, rows).withColumn("n_tokens", F.lit(1)).withColumn("tag", F.lit("t")).repartition(5)
    assert result(T.token_counts(docs, NAME)) == expected(rows)
    # nothing known beforehand, or almost nothing: all or most pre-tokens go by the vocabulary
    assert result(T.token_counts(docs, NAME, limit=3, frequent=20)) == expected(rows, 3)


def test_vocabulary_counts_each_pretoken_once(spark):
    texts = ["the cat", "the cat's", "cat", None, "\n\n the"] * 3
    words = T.vocabulary(frame(spark, list(enumerate(texts))).repartition(4), NAME)
    got = {bytes(r.pretoken).decode(): (r.n, r.pieces) for r in words.collect()}
    want = Counter(t[a:b] for t in texts if t for _, (a, b) in PLAIN.pre_tokenizer.pre_tokenize_str(t))
    assert got == {p: (n, plain(p)) for p, n in want.items()}
    assert len(words.collect()) == len(got)
    # at most so many frequent ones, and none of them rarer than one left out
    for most in (0, 1, 3, 100):
        top = {bytes(r.pretoken).decode(): r.n for r in T.most_frequent(words, most).collect()}
        assert len(top) <= most and (most < 100 or top == want)
        assert min(top.values(), default=99) > max((n for p, n in want.items() if p not in top), default=0)


def test_batch_split_as_the_library():
    split = T.Splitter(NAME)
    texts = SPACES + fuzz(20_000, 3) + ["'s", "x's't're", "''s", " 's", "\n's", "'", "a'", "'l", "'r e", "don't'vex", "!'s", "1'd2"]
    texts = [t for t in texts if "<|" not in t]
    owner, codes, distinct, added = split(T.pa.array([t.encode() for t in texts], T.pa.binary()))
    got = [[] for _ in texts]
    for o, c in zip(owner.tolist(), codes.tolist()):
        got[o].append(distinct[c].as_py().decode())
    assert not added.any()
    for t, g in zip(texts, got):
        assert g == split.split(t), repr(t)


def test_broken_strings_do_not_end_the_job(spark):
    docs = spark.sql("select 1L as doc_id, cast(x'6120ff62' as string) as text union all select 2L, 'a b'")
    got = {r.doc_id: r.n_tokens for r in T.token_counts(docs, NAME).collect()}
    assert got[2] == plain("a b") and got[1] > 0


def test_empty_table(spark):
    assert T.token_counts(frame(spark, []), NAME).collect() == []


def test_other_tokenizer_splits_whole_texts(spark):
    rows = list(enumerate([t for t in fuzz(200, 2) if "<|" not in t]))
    other = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    got = T.token_counts(frame(spark, rows), "word_bpe_49k.json").collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(other.encode(t, add_special_tokens=False).ids) for i, t in rows}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_given_documents(spark, sf):
    docs = table(spark, f"/root/testdata/sf{sf}", "documents")
    assert result(T.token_counts(docs, NAME, frequent=5000)) == expected([(r.doc_id, r.text) for r in docs.collect()])
