"""Language-model scores from a hierarchical Pitman-Yor model whose contexts are the words before.

Every word is a context: the restaurant of the word directly before a token (before a text's
first token stands the end token), all sharing the unigram restaurant as parent, whose base is uniform over the
training vocabulary and one unknown word.  The sampler, its seatings' exact conditionals and the mean of
the samples' predictive probabilities are those of ``pitman_yor``.

Contexts grow with the corpus, so nothing about them passes through the driver.  Pairs of
words, those of the held-out texts with a count of zero, lie in buckets by their second word.  Between
passes each bucket sends its contexts' customers and tables to ranges of the contexts' hash
space, where they are summed up and sent back in the order asked for.  Words too frequent for one bucket are cut into
parts by context; a part knows the parent's customers from the others as of the pass before,
like the totals.

To score, a pair's probability is found in its bucket.  Pairs with a share of at least
``FREQUENT_PAIR`` (so at most 1 / FREQUENT_PAIR) are scored where texts are read.  Texts are scored in ``ROUNDS``
shares by their hash, so that only the tokens of one share are on disk at a time.

Defined cases are those of ``pitman_yor``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm import pitman_yor as L
from pitlane.llm.common import staged, unstage
from pitlane.llm.labelled import remainder

BUCKET_TOKENS = 1_000_000  # training tokens of a bucket, about
LEAST_BUCKETS = 48
PARTS = 4  # a word with more than this share of a bucket's tokens is cut
FREQUENT_PAIR = 2.0**-20
FOLD = 1 << 19  # tokens counted together
HELD = 3 << 19  # pairs a task holds, about
ONE_BY_ONE = 16  # pairs of a word drawn one after another at most
ROUNDS = 2  # texts are scored in so many shares, one after another

_ODD = 0x9E3779B97F4A7C15
_LOW = 31  # bits of a pair that tell its context
_OFTEN = 0xFFFFFFFF  # stands for the count of a frequent word
_FINE = 2.0**30  # log probabilities are kept to whole multiples of its inverse


class Words(NamedTuple):
    """The frequent words, how the most frequent are cut, the number of buckets."""

    vocabulary: L.Vocabulary
    parts: np.ndarray  # of each frequent word
    hot: np.ndarray  # sorted keys of all parts of cut words
    owner: np.ndarray  # the cut word of each, numbered from 0
    buckets: int

    @property
    def bounds(self) -> list[int]:
        """First pair of each bucket."""
        return [-(-(b << 63) // self.buckets) for b in range(self.buckets)]

    @property
    def groups(self) -> list[int]:
        return self.bounds[:: L._width(self.buckets)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _part_keys(words: np.ndarray, part: np.ndarray) -> np.ndarray:
    mixed = _mix(words.astype(np.uint64) + (part + 1).astype(np.uint64) * np.uint64(_ODD))
    return (mixed >> np.uint64(64 - L._KEY_BITS)).astype(np.int64)


def pair(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """63-bit key of (word or part, context), the word's leading bits first."""
    h = _mix(contexts.astype(np.uint64) + words.astype(np.uint64) * np.uint64(_ODD))
    return (words >> (L._KEY_BITS - 63 + _LOW)) << _LOW | (h >> np.uint64(64 - _LOW)).astype(np.int64)


def frequent_words(texts: DataFrame, bucket_tokens: int, least: int, frequent: float) -> Words:
    """The training texts' frequent words and sizes."""
    v = L.vocabulary(texts, 0, frequent)
    buckets = max(least, math.ceil(v.tokens / bucket_tokens))
    parts = np.maximum(1, -(-v.counts * PARTS // bucket_tokens))
    cut = np.flatnonzero(parts > 1)
    owner = np.repeat(np.arange(len(cut)), parts[cut])
    part = np.concatenate([np.arange(k) for k in parts[cut]]) if len(cut) else cut
    keys = _part_keys(v.keys[cut][owner], part) if len(cut) else cut
    order = np.argsort(keys)
    return Words(v, parts, keys[order], owner[order], buckets)


def _routed(m: Words, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the tokens' words, or parts, and of their contexts; each text ends with the end token."""
    v = m.vocabulary
    if len(v.keys):
        rank = np.minimum(code, len(v.keys) - 1)
        keys, parts = np.where(code < L._RARE, v.keys[rank], code - L._RARE), np.where(code < L._RARE, m.parts[rank], 1)
    else:
        keys, parts = code - L._RARE, np.ones(len(code), np.int64)
    contexts = np.concatenate([[L.key(b"")], keys[:-1]])
    cut = np.flatnonzero(parts > 1)
    if len(cut):
        part = _mix(contexts[cut].astype(np.uint64)) % parts[cut].astype(np.uint64)
        keys[cut] = _part_keys(keys[cut], part)
    return keys, contexts


def _tight(x: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers in few bytes: differences if they rise, like bytes of all of them side by side, compressed."""
    x = np.ascontiguousarray(np.diff(x, prepend=0) if rising else x, np.int64).reshape(-1)
    each, side = x.view(np.uint8).reshape(-1, 8), np.empty((8, len(x)), np.uint8)
    for k in range(8):
        side[k] = each[:, k]
    return len(x).to_bytes(8, "little") + (pa.compress(side, "zstd", asbytes=True) if len(x) else b"")


def _loose(x: bytes, rising: bool = False) -> np.ndarray:
    size = int.from_bytes(x[:8], "little")
    if not size:
        return np.zeros(0, np.int64)
    side = np.frombuffer(pa.decompress(x[8:], 8 * size, "zstd"), np.uint8).reshape(8, size)
    x = np.empty(size, np.int64)
    each = x.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        each[:, k] = side[k]
    return np.cumsum(x) if rising else x


def _coder(m: Words):
    """What turns keys of frequent words into their rank: few candidates have a key's leading bits."""
    rank = np.argsort(m.vocabulary.keys)
    table = m.vocabulary.keys[rank]
    bits = len(table).bit_length() + 3
    shift = L._KEY_BITS - bits
    first = np.searchsorted(table, np.arange((1 << bits) + 1) << shift)
    most = int(np.diff(first).max())

    def coded(keys: np.ndarray) -> np.ndarray:
        codes = keys + L._RARE
        slot = keys >> shift
        at = first[slot]
        left = np.flatnonzero(first[slot + 1] > at)
        at, wanted = at[left], keys[left]
        for k in range(most):
            near = np.minimum(at + k, len(table) - 1)
            hit = table[near] == wanted
            codes[left[hit]] = rank[near[hit]]
        return codes

    return coded


def _decoded(m: Words, codes: np.ndarray) -> np.ndarray:
    keys = m.vocabulary.keys
    return np.where(codes < L._RARE, keys[np.minimum(codes, len(keys) - 1)], codes - L._RARE) if len(keys) else codes - L._RARE


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``table``, and whether they are there."""
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def _cuts(keys: np.ndarray, edges: list[int]) -> list[tuple[int, slice]]:
    """The places of sorted keys in each range that has some."""
    at = np.concatenate([[0], np.searchsorted(keys, np.array(edges[1:], np.int64)), [len(keys)]])
    return [(b, slice(at[b], at[b + 1])) for b in np.flatnonzero(at[1:] > at[:-1]).tolist()]


def _merged(keys, contexts, n):
    """Counts of equal pairs added up, in the order of ``pair``; the pairs."""
    pairs = pair(keys, contexts)
    order = np.argsort(pairs)
    pairs = pairs[order]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, int)
    n = np.add.reduceat(n[order], first) if len(first) else n[:0]
    return keys[order[first]], contexts[order[first]], n, pairs[first]


_COUNTS = "keys binary, contexts binary, n binary"


def _sent(coded, cells: tuple) -> tuple[bytes, bytes, bytes]:
    keys, contexts, n = cells
    return _tight(keys, rising=True), _tight(coded(contexts)), _tight(n)


def _counted(m: Words, rows: pa.Table):
    keys, contexts, n = ([_loose(x, rising=c == "keys") for x in rows.column(c).to_pylist()] for c in L._names(_COUNTS))
    return _merged(np.concatenate(keys), _decoded(m, np.concatenate(contexts)), np.concatenate(n))


def _pairs(m: Words):
    """Pairs of all texts with their training counts, packed by groups of buckets."""
    edges = m.groups

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = _coder(m)
        part, train, held, turn = [], [], 0, 0
        folded = []

        def fold():
            nonlocal part, train, held
            if part:
                keys, contexts = _routed(m, coded(np.concatenate(part)))
                folded.append(_merged(keys, contexts, np.concatenate(train))[:3])
            part, train, held = [], [], 0

        def out():
            *cells, pairs = _merged(*(np.concatenate(x) for x in zip(*folded, strict=True)))
            folded.clear()
            some = _cuts(pairs, edges)
            piece = L._piece(len(edges), turn)
            return pa.RecordBatch.from_arrays(L._arrow([(g, piece, *_sent(coded, [x[at] for x in cells])) for g, at in some], "grp int, piece long, " + _COUNTS), L._names("grp int, piece long, " + _COUNTS))

        for batch in batches:
            counts = 1 - batch.column("held_out").to_numpy(zero_copy_only=False).astype(np.int64)
            for some, keys, sizes in L.blocks(batch.column("text")):
                part.append(keys)
                train.append(np.repeat(counts[some], sizes))
                held += len(keys)
                if held >= min(FOLD, L.CHUNK):
                    fold()
                    if sum(len(x[0]) for x in folded) > HELD:
                        yield out()
                        turn += 1
        fold()
        if folded:
            yield out()

    return task


def _deal_pairs(m: Words):
    """A group's pairs from many tasks, merged and packed by bucket."""
    bounds = m.bounds

    def task(rows: pa.Table) -> pa.Table:
        coded = _coder(m)
        *cells, pairs = _counted(m, rows)
        schema = "bucket int, " + _COUNTS
        return pa.table(L._arrow([(b, *_sent(coded, [x[at] for x in cells])) for b, at in _cuts(pairs, bounds)], schema), L._names(schema))

    return task


_TABLE = "bucket int, words binary, per binary, contexts binary, at binary, n binary"


def _gather(m: Words):
    """One row per bucket: its words, how many pairs each has, its contexts, and the pairs' contexts and counts."""

    def task(rows: pa.Table) -> pa.Table:
        keys, contexts, n, _ = _counted(m, rows)
        order = np.argsort(keys, kind="stable")
        words, per = np.unique(keys, return_counts=True)
        known, at = np.unique(contexts[order], return_inverse=True)
        row = (rows.column("bucket")[0].as_py(), _tight(words, rising=True), _tight(per), _tight(known, rising=True), _tight(at), _tight(n[order]))
        return pa.table(L._arrow([row], _TABLE), L._names(_TABLE))

    return task


class Bucket(NamedTuple):
    words: np.ndarray
    word: np.ndarray  # of each pair: its word's place
    contexts: np.ndarray
    at: np.ndarray  # of each pair: its context's place
    n: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Bucket:
        words, per, contexts, at, n = (_loose(row[c], rising=c in ("words", "contexts")) for c in ("words", "per", "contexts", "at", "n"))
        return cls(words, np.repeat(np.arange(len(words)), per), contexts, at, n)

    def hot(self, m: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of the parts of cut words in the bucket, and among all parts."""
        _, here, there = np.intersect1d(self.words, m.hot, assume_unique=True, return_indices=True)
        return here, there


# rows with a part ask for its contexts; the one without has the bucket's own numbers
_ASKED = "part int, bucket int, contexts binary, numbers binary, customers array<double>, tables array<double>, ones long, twos long, hot binary, own binary, seats binary"
_ASKED_KINDS = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int64(), pa.int64(), *[pa.binary()] * 3)


def _asked(m: Words, bucket: int, b: Bucket, cells: np.ndarray, saved: np.ndarray, own: tuple) -> pa.Table:
    """The contexts' customers and what the tables of ``cells`` save of them (a row per sample), and the bucket's own row."""
    size = len(b.contexts)
    numbers = [np.bincount(b.at, b.n, size), *(np.bincount(b.at[cells], x, size) for x in saved)]
    numbers = np.array(numbers).astype(np.int64)
    rows = [(p, bucket, _tight(b.contexts[s], rising=True), _tight(numbers[:, s]), *[None] * 7) for p, s in L._cuts(b.contexts, L._bounds(m.buckets))]
    rows.append((None, bucket, None, None, *own))
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(_ASKED_KINDS)], L._names(_ASKED))


def _ask(m: Words):
    """Before the first pass: a guess of the tables."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Bucket.of(row)
                many = np.flatnonzero(b.n > 1)
                tables = np.minimum(b.n, 1)
                tables[many] = np.maximum(1, np.rint(b.n[many] ** 0.7))
                c0 = np.bincount(b.word, tables, len(b.words)).astype(np.int64)
                here, there = b.hot(m)
                own = ([float(c0.sum())], [0.0], int((b.n == 1).sum()), int((b.n == 2).sum()), np.array([there, c0[here]], np.int64).tobytes(), None, None)
                yield from _asked(m, row["bucket"], b, many, (b.n - tables)[None, many], own).to_batches()

    return task


_TOLD = "bucket int, part int, numbers binary"


def _tell(samples: int):
    """The sums over buckets of what they know of a range's contexts, to each in the order it asked."""

    def task(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        contexts, numbers = [_loose(r["contexts"], rising=True) for r in rows], [_loose(r["numbers"]).reshape(1 + samples, -1) for r in rows]
        _, at = np.unique(np.concatenate(contexts), return_inverse=True)
        sums = [np.bincount(at, x).astype(np.int64)[at] for x in np.concatenate(numbers, axis=1)]
        ends = np.cumsum([len(x) for x in contexts])
        out = [(r["bucket"], r["part"], _tight(x)) for r, x in zip(rows, np.split(np.array(sums), ends[:-1], axis=1), strict=True)]
        return pa.table(L._arrow(out, _TOLD), L._names(_TOLD))

    return task


def _heard(told: pa.Table, samples: int) -> np.ndarray:
    """Customers and each sample's tables of a bucket's contexts."""
    rows = sorted((r for r in told.select(["part", "numbers"]).to_pylist() if r["part"] is not None), key=lambda r: r["part"])
    numbers = np.concatenate([_loose(r["numbers"]).reshape(1 + samples, -1) for r in rows], axis=1)
    return np.concatenate([numbers[:1], numbers[0] - numbers[1:]])


def _sit(m: Words, totals: L.Totals, hot: np.ndarray, burn: int, samples: int, turn: int, keep: bool):
    """A pass over a bucket's words; ``hot`` has the parent's customers from each part of a cut word."""
    whole = np.bincount(m.owner, hot, m.owner.max(initial=-1) + 1).astype(np.int64)[m.owner] if len(hot) else hot

    def task(table: pa.Table, told: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        b = Bucket.of(row)
        tables = _heard(told, 1)[1]
        many = np.flatnonzero(b.n > 1)
        size = len(b.words)
        here, there = b.hot(m)
        elsewhere = np.zeros(size, np.int64)
        elsewhere[here] = (whole - hot)[there]
        fixed = elsewhere + np.bincount(b.word, b.n == 1, size).astype(np.int64)
        strengths = L.STRENGTH + totals.discount * tables[b.at[many]]
        got = L.seat(np.bincount(b.word[many], minlength=size), None, b.n[many], totals, [L.SEED, turn, row["bucket"]], burn, samples, strengths, fixed, ONE_BY_ONE)
        c0, t0 = got.parent_customers - elsewhere, got.parent_tables
        cold = np.ones(size, bool)
        cold[here] = False
        ones, twos = (int((c0[-1, cold] == k).sum()) for k in (1, 2))
        own = seats = None
        if keep:
            own, seats = _tight(got.tables.sum(axis=0)), _tight(np.array([c0, t0]))
        own = (c0.sum(axis=1).astype(float).tolist(), t0[:, cold].sum(axis=1).astype(float).tolist(), ones, twos, np.array([there, *c0[:, here]], np.int64).tobytes(), own, seats)
        return _asked(m, row["bucket"], b, many, b.n[many] - got.tables, own)

    return task


class Parent(NamedTuple):
    """Each sample's totals of the unigram restaurant, and its customers and tables of the cut words."""

    samples: list[L.Totals]
    hot: np.ndarray  # sample x part: customers
    customers: np.ndarray  # sample x cut word
    tables: np.ndarray


def _parents(m: Words, asked: DataFrame, given: L.Totals, samples: int, discount: float | None, turn: int) -> Parent:
    """A few numbers of each bucket and of the parts of cut words, summed up."""
    rows = asked.where("part is null").select("customers", "tables", "ones", "twos", "hot").collect()
    d0 = round(L._discount(sum(r["ones"] for r in rows), sum(r["twos"] for r in rows)), 4) if discount is None else discount
    hot = np.zeros((samples, len(m.hot)), np.int64)
    for r in rows:
        at, *c0 = np.frombuffer(r["hot"], np.int64).reshape(1 + samples, -1)
        hot[:, at] = c0
    words = int(m.owner.max(initial=-1)) + 1
    customers = np.array([np.bincount(m.owner, x, words) for x in hot]).astype(np.int64).reshape(samples, words)
    tables = np.minimum(customers, 1)
    rng = np.random.default_rng([L.SEED, turn, m.buckets])
    for s in range(samples):
        for most, some in L._by_size(customers[s], np.arange(words)):
            flat = np.full(len(some), L.STRENGTH + d0 * given.parent_tables)
            tables[s, some] = L._draw(customers[s, some], most, flat, lambda i, k=len(some): np.full((k, i.shape[1]), given.base), d0, rng)
    c0, t0 = (np.sum([r[c] for r in rows], axis=0) for c in ("customers", "tables"))
    totals = [given._replace(parent_customers=float(c), parent_tables=float(t), parent_discount=d0) for c, t in zip(c0, t0 + tables.sum(axis=1), strict=True)]
    return Parent(totals, hot, customers, tables)




class Model(NamedTuple):
    words: Words
    table: DataFrame | None  # pairs' probabilities by bucket
    pairs: np.ndarray  # the frequent ones, sorted, their log10 probabilities and their words' counts
    log_p: np.ndarray
    counts: np.ndarray


_CHANCES = "bucket int, pairs binary, log_p binary, counts binary, often binary, often_log_p binary, often_counts binary"


def _chances(m: Words, given: L.Totals, parent: Parent, least: float):
    """log10 of the mean of the samples' predictive probabilities of a bucket's pairs, and the rare words' counts."""
    samples = len(parent.samples)

    def task(table: pa.Table, known: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        b = Bucket.of(row)
        (seated,) = (r for r in known.select(["part", "own", "seats"]).to_pylist() if r["part"] is None)
        customers, *tables = _heard(known, samples)
        own = np.where(b.n > 0, 1 - given.discount, 0.0)
        own[b.n > 1] = b.n[b.n > 1] - given.discount * _loose(seated["own"]) / samples
        c0, t0 = _loose(seated["seats"]).reshape(2, samples, -1).copy()
        here, there = b.hot(m)
        c0[:, here], t0[:, here] = parent.customers[:, m.owner[there]], parent.tables[:, m.owner[there]]
        backed = np.zeros(len(b.n))
        for totals, t, c, k in zip(parent.samples, tables, c0, t0, strict=True):
            backed += (L.STRENGTH + given.discount * t)[b.at] * L._parent(c, k, totals)[b.word]
        logs = np.rint(np.log10((own + backed / samples) / (L.STRENGTH + customers[b.at])) * _FINE).astype(np.int64)
        counts = np.bincount(b.word, b.n, len(b.words)).astype(np.int64)
        counts[np.isin(b.words, m.vocabulary.keys)] = _OFTEN
        counts[here] = _OFTEN
        pairs = pair(b.words[b.word], b.contexts[b.at])
        order = np.argsort(pairs)
        often = b.n >= least
        blobs = (_tight(pairs[order], rising=True), _tight(logs[order]), _tight(counts[b.word[order]]), pairs[often].tobytes(), (logs[often] / _FINE).tobytes(), counts[b.word[often]].tobytes())
        return pa.table(L._arrow([(row["bucket"], *blobs)], _CHANCES), L._names(_CHANCES))

    return task


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(L.FOLDS) == L.HELD_OUT).alias("held_out"), F.col("text").cast("binary").alias("text"))


def train(docs: DataFrame, bucket_tokens: int = BUCKET_TOKENS, least: int = LEAST_BUCKETS, frequent: float = L.FREQUENT, frequent_pair: float = FREQUENT_PAIR) -> Model:
    """Model of the texts outside the held-out fold, with the probabilities of all texts' pairs."""
    texts = _texts(docs)
    m = frequent_words(texts.where("not held_out").select("text"), bucket_tokens, least, frequent)
    v = m.vocabulary
    if not v.tokens:
        return Model(m, None, np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    packed = texts.select("held_out", "text").mapInArrow(_pairs(m), "grp int, piece long, " + _COUNTS)
    packed = packed.groupBy("grp", "piece").applyInArrow(_deal_pairs(m), "bucket int, " + _COUNTS)
    table = staged(packed.groupBy("bucket").applyInArrow(_gather(m), _TABLE), "pairs")
    buckets = table.groupBy("bucket")
    asked = staged(table.mapInArrow(_ask(m), _ASKED), "asked")
    seen = asked.where("part is null").agg(F.sum("ones"), F.sum("twos"), F.sum(F.col("customers")[0])).first()
    totals = L.Totals(np.zeros(0), np.zeros(0), seen[2], float(v.words), round(L._discount(seen[0], seen[1]), 4), 0.5, 1 / (v.words + 1))
    parent = _parents(m, asked, totals, 1, 0.5, L.PASSES + 1)
    for turn in range(L.PASSES + 1):
        last = turn == L.PASSES
        told = asked.where("part is not null").groupBy("part").applyInArrow(_tell(1), _TOLD)
        burn, samples = (L.BURN, L.SAMPLES) if last else (1, 1)
        sat = buckets.cogroup(told.groupBy("bucket")).applyInArrow(_sit(m, totals, parent.hot[0], burn, samples, turn, last), _ASKED)
        spent, asked = asked, staged(sat, "asked")
        unstage(spent)
        parent = _parents(m, asked, totals, samples, totals.parent_discount if last else None, turn)
        given, totals = totals, parent.samples[0]
    told = asked.where("part is not null").groupBy("part").applyInArrow(_tell(L.SAMPLES), _TOLD)
    known = told.withColumns({"own": F.lit(None).cast("binary"), "seats": F.lit(None).cast("binary")}).unionByName(asked.where("part is null").select("bucket", "part", "numbers", "own", "seats"))
    least_pair = max(2.0, v.tokens * frequent_pair)
    chances = staged(buckets.cogroup(known.groupBy("bucket")).applyInArrow(_chances(m, given, parent, least_pair), _CHANCES), "chances")
    for spent in (asked, table):
        unstage(spent)
    often = chances.select("often", "often_log_p", "often_counts").collect()  # at most 1 / frequent_pair pairs
    pairs, log_p, counts = (np.concatenate([np.frombuffer(r[i], k) for r in often]) for i, k in enumerate((np.int64, np.float64, np.int64)))
    order = np.argsort(pairs)
    return Model(m, chances.select("bucket", "pairs", "log_p", "counts"), pairs[order], log_p[order], counts[order])


def _rare(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether words are known, and the logs of their counts; nothing for frequent ones, which are counted where they are read."""
    rare = counts < _OFTEN
    return rare & (counts > 0), np.where(rare, np.log10(counts + 0.5), 0.0)


_PACKED = "grp int, piece long, chunk long, docs binary, at binary, pairs binary"
_DEALT = "bucket int, grp int, piece long, chunk long, docs binary, chunks binary, place binary, at binary, pairs binary"


def _pack(model: Model):
    """Texts in chunks: tokens of frequent pairs scored at once, the others packed for their groups of buckets."""
    m, often, log_p = model.words, model.pairs, model.log_p
    rare, seen = _rare(model.counts)
    v, edges = m.vocabulary, m.groups
    log_n = np.append(np.log10(v.counts + 0.5), 0.0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = _coder(m)
        first = chunk = TaskContext.get().partitionId() << 32
        docs, part, held = [], [], 0

        def out():
            rows = np.zeros(len(docs), L._DOC)
            for i, c in enumerate(("id", "null", "held", "tokens")):
                rows[c] = [d[i] for d in docs]
            code, doc = coded(np.concatenate(part)), np.repeat(np.arange(len(docs)), rows["tokens"])
            rank = np.minimum(code, len(v.keys))
            pairs = pair(*_routed(m, code))
            rows["known"] = np.bincount(doc, code < L._RARE, len(docs))
            rows["base"] = np.bincount(doc, log_n[rank], len(docs))
            order = np.argsort(pairs, kind="stable")
            pairs, doc = pairs[order], doc[order]
            at, hit = _find(often, pairs)
            if hit.any():
                near, at = doc[hit], at[hit]
                rows["score"] = np.bincount(near, log_p[at], len(docs))
                rows["known"] += np.bincount(near, rare[at], len(docs)).astype(np.int64)
                rows["base"] += np.bincount(near, seen[at], len(docs))
            left, doc = pairs[~hit], doc[~hit]
            piece = L._piece(len(edges), chunk - first)
            sent = [(int(chunk % len(edges)), piece, chunk, rows.tobytes(), None, None)]
            sent += [(g, piece, chunk, None, _tight(doc[s]), _tight(left[s], rising=True)) for g, s in _cuts(left, edges)]
            return pa.RecordBatch.from_arrays(L._arrow(sent, _PACKED), L._names(_PACKED))

        for batch in batches:
            ids, folds = (batch.column(c).to_pylist() for c in ("doc_id", "held_out"))
            for some, keys, sizes in L.blocks(batch.column("text")):
                part.append(keys)
                docs += [(doc or 0, doc is None, fold, size) for doc, fold, size in zip(ids[some], folds[some], sizes.tolist(), strict=True)]
                held += len(keys)
                if held >= L.CHUNK:
                    yield out()
                    docs, part, held, chunk = [], [], 0, chunk + 1
        if docs:
            yield out()

    return task


def _deal(m: Words):
    """A group's tokens from many chunks, packed by bucket; the documents' own rows pass through."""
    bounds = m.bounds

    def task(texts: pa.Table) -> pa.Table:
        rows = texts.to_pylist()
        grp, piece = rows[0]["grp"], rows[0]["piece"]
        out = [(r["chunk"] % m.buckets, grp, piece, r["chunk"], r["docs"], *[None] * 4) for r in rows if r["docs"] is not None]
        tokens = sorted((r for r in rows if r["docs"] is None), key=lambda r: r["chunk"])
        if tokens:
            at, pairs = ([_loose(r[c], rising=c == "pairs") for r in tokens] for c in ("at", "pairs"))
            place = np.repeat(np.arange(len(tokens)), [len(x) for x in at])
            at, pairs = np.concatenate(at), np.concatenate(pairs)
            order = np.argsort(pairs, kind="stable")
            place, at, pairs = place[order], at[order], pairs[order]
            chunks = np.array([r["chunk"] for r in tokens], np.int64).tobytes()
            out += [(b, grp, piece, None, None, chunks, _tight(place[s]), _tight(at[s]), _tight(pairs[s], rising=True)) for b, s in _cuts(pairs, bounds)]
        return pa.table(L._arrow(out, _DEALT), L._names(_DEALT))

    return task


def _score(texts: pa.Table, chances: pa.Table) -> pa.Table:
    """Sums per document of a bucket's tokens; the documents' own rows pass through."""
    rows = chances.to_pylist() or [{c: _tight(np.zeros(0, np.int64)) for c in ("pairs", "log_p", "counts")}]
    table, log_p, counts = (_loose(rows[0][c], rising=c == "pairs") for c in ("pairs", "log_p", "counts"))
    log_p = log_p / _FINE
    known, seen = _rare(counts)
    out = []
    for row in texts.to_pylist():
        if row["docs"] is not None:
            out.append((row["grp"], row["piece"], row["chunk"], row["docs"], None))
            continue
        place, at, pairs = (_loose(row[c], rising=c == "pairs") for c in ("place", "at", "pairs"))
        chunks = np.frombuffer(row["chunks"], np.int64)
        cell, there = _find(table, pairs)
        assert there.all()  # the table has the pairs of all texts
        docs, to = np.unique(place << 32 | at, return_inverse=True)
        part = np.zeros(len(docs), L._PART)
        part["chunk"], part["at"], part["known"] = chunks[docs >> 32], docs & 0xFFFFFFFF, np.bincount(to, known[cell])
        part["score"], part["base"] = np.bincount(to, log_p[cell]), np.bincount(to, seen[cell])
        out.append((row["grp"], row["piece"], None, None, part.tobytes()))
    return pa.table(L._arrow(out, L._SCORED), L._names(L._SCORED))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document of the table trained on: columns and units of ``pitman_yor.score``."""
    m = model.words
    if model.table is None:
        return L.score(docs, L.Model(m.vocabulary, None, None, model.log_p))
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    done = None
    for turn in range(ROUNDS):
        packed = _texts(docs.where(share == turn)).mapInArrow(_pack(model), _PACKED).groupBy("grp", "piece").applyInArrow(_deal(m), _DEALT)
        sums = packed.groupBy("bucket").cogroup(model.table.groupBy("bucket")).applyInArrow(_score, L._SCORED)
        chunks = sums.groupBy("grp", "piece").applyInArrow(L._collect, L._CHUNKS)
        scores = chunks.groupBy("chunk").applyInArrow(L._unite(m.vocabulary.tokens, m.vocabulary.words), L._RESULT)
        scores = staged(scores, "scores") if turn < ROUNDS - 1 else scores
        done = scores if done is None else done.unionByName(scores)
    return done
