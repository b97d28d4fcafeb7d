import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pitlane.llm import packing as P
from pitlane.llm.common import table
from tests.llm.cases import AWKWARD, frame

PATH = P.tokenizer_path()


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, got):
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for doc, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[doc, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    return len(sequences), sum(k[3] * n for k, n in want.items())


def test_awkward_rows(spark):
    check([r[:2] for r in AWKWARD], P.pack(frame(spark, AWKWARD), PATH).collect())


def test_given_documents_fill_few_sequences(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    used, tokens = check([(r.doc_id, r.text) for r in docs.collect()], P.pack(docs, PATH).collect())
    assert used <= -(-tokens // 4096) + 1


def test_word_cache_gives_the_tokenizers_ids(monkeypatch):
    texts = ["it's well-known, isn't it?", "a.b, c.. d., e.,", "x y z é ẛ̣", "ΟΔΟΣ İstanbul ﬁ", "", " \t", "###%%% $$$ 123 1a2b", "<|endoftext|> no é, é.", "A" * 50]
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    column = pa.array([x.encode() for x in ["dropped", *texts]], pa.binary()).slice(1)
    for generation in (1 << 18, 3):
        monkeypatch.setattr(P, "_WORDS", generation)
        P._ids.cache_clear()
        ids, at = P.token_ids(column, PATH)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_portions_cover_every_text(monkeypatch):
    monkeypatch.setattr(P, "_PORTION", 10)
    texts = pa.array([b"x" * n for n in (0, 3, 4, 30, 0, 0, 9, 2, 10, 1)], pa.binary())
    ranges = list(P._portions(texts))
    assert [i for a, b in ranges for i in range(a, b)] == list(range(10))
    assert all(b == a + 1 or sum(map(len, texts[a:b].to_pylist())) <= 10 for a, b in ranges)


def pack_one_by_one(lengths, capacity):
    """Best-fit decreasing, piece by piece."""
    bins = []
    scale = np.sqrt(np.array(P.Weights())) / np.array(capacity)
    for length in sorted(lengths, reverse=True):
        ask = np.array([length, 1, length * length])
        best = None
        for b in bins:
            if (b >= ask).all():
                score = (((b - ask) * scale) ** 2).sum()
                if best is None or score < best[0]:
                    best = (score, b)
        if best is None:
            best = (0, np.array(capacity))
            bins.append(best[1])
        best[1][:] -= ask
    return Counter(map(tuple, bins))


@pytest.mark.parametrize("capacity", [P.Capacity(100, 100, 10_000), P.Capacity(100, 4, 10_000), P.Capacity(100, 100, 3_000)])
def test_plan_equals_best_fit_piece_by_piece(capacity):
    rng = random.Random(3)
    lengths = [min(54, int(rng.paretovariate(0.8))) for _ in range(700)]
    for rule in ("norm", "dot"):
        places = P.plan(dict(Counter(lengths)), capacity, rule=rule)
        bins = defaultdict(list)
        for p in places:
            for i in range(p.bins * p.each):
                bins[p.bin + i // p.each].append((p.offset + i % p.each * p.length, p.length))
        assert sorted(n for b in bins.values() for _, n in b) == sorted(lengths)
        assert sorted(bins) == list(range(len(bins)))
        for b in bins.values():
            assert sum(n for _, n in b) <= capacity.tokens and len(b) <= capacity.documents and sum(n * n for _, n in b) <= capacity.cost
            ends = [0, *np.cumsum([n for _, n in sorted(b)])]
            assert [o for o, _ in sorted(b)] == ends[:-1]
        if rule == "norm":
            left = Counter((capacity.tokens - sum(n for _, n in b), capacity.documents - len(b), capacity.cost - sum(n * n for _, n in b)) for b in bins.values())
            assert left == pack_one_by_one(lengths, capacity)


def test_many_pieces_of_one_length(spark):
    rows = [(i, "same few words") for i in range(2500)]
    used, tokens = check(rows, P.pack(frame(spark, rows), PATH).collect())
    assert used == -(-tokens // 4096)


def test_empty_table(spark):
    assert P.pack(frame(spark, []), PATH).collect() == []


ADDED = ["end <|endoftext|> next", "<|startoftext|>a<|endoftext|><|endoftext|>b é.", "<|ENDOFTEXT|> x", "it's<|endoftext|>'s", "<|endoftext", "", "plain"]


def test_added_tokens_have_the_plain_tokenizers_ids(spark):
    t = Tokenizer.from_file(PATH)
    column = pa.array([x.encode() for x in ["<|endoftext|>", *ADDED]], pa.binary()).slice(1)
    ids, at = P.text_ids(column, PATH)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [t.encode(x, add_special_tokens=False).ids for x in ADDED]
    assert ids[at[0] : at[1]].tolist() == [806, 49407, 1131]
    rows = list(enumerate(ADDED))
    check(rows, P.pack(frame(spark, rows), PATH).collect())


def fuzzed(n, seed):
    """Texts of letters, marks, capitals that normalise to a letter and a mark, digits, punctuation and white space."""
    rnd = random.Random(seed)
    letters = ["a", "B", "é", "é", "İ", "ı", "ß", "ẞ", "Σ", "ς", "Å", "ﬁ", "Ǆ", "क", "क़", "क़", "ज़ा", "日", "ん", "한", "하", "ا", "̀", "ª", "Ⅷ", "²", "๑"]
    marks = list(".,!?;:'\"()-_/#$%&*|@~^`<>[]{}=+\\") + ["'s", "'RE", "’", "…", "🙂", "‍", "̇", "<|endoftext|>", "\x00", "\x1c", "\x7f"]
    gaps = [" ", "\n", "\t", "  ", "\x0b", " ", "　", " ", "\x85"]
    kinds = (letters, letters, letters, list("0123456789"), marks, marks, gaps)
    return ["".join(rnd.choice(rnd.choice(kinds)) for _ in range(rnd.randrange(1, 14))) for _ in range(n)]


def test_ids_as_the_plain_tokenizer():
    texts = ["TARİHİ.", "क़.", "ROMA'NIN TARİHİ, VE.", "xय़!"] + fuzzed(100_000, 4)
    plain = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    ids, at = P.text_ids(pa.array([x.encode() for x in texts], pa.binary()), "word_bpe_49k.json")
    wrong = [t for t, p, a, b in zip(texts, plain, at, at[1:]) if ids[a:b].tolist() != p.ids]
    assert wrong == []


def test_ranks_are_gapless_over_blocks_of_cells(spark, monkeypatch):
    monkeypatch.setattr(P, "CELL", 4)
    monkeypatch.setattr(P, "_CELLS", 3)
    rows = [(i, 0, 0, 1 + i % 3 // 2, i) for i in range(400)]
    items = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(5)
    histogram = items.groupBy("length").count().withColumnRenamed("count", "n")
    got = P.ranked(items, histogram).collect()
    for length in (1, 2):
        ranks = sorted(r["rank"] for r in got if r.length == length)
        assert ranks == list(range(len(ranks))) and len(ranks) > 100
