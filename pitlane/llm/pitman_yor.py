"""Language-model scores from a hierarchical Pitman-Yor model.

Tokens are lower-cased words and one end token a text.  A token's context is
the last anchor word before it, the anchors being the ``ANCHORS`` most frequent
words: one restaurant per context, all sharing the unigram restaurant as parent, whose
base is uniform over the training vocabulary and one unknown word.  Seatings are
sampled by Gibbs; a token's probability is the mean of its predictive probabilities under
the samples, each with that sample's own seats and totals.

Given the restaurants' totals (customers, tables: a few numbers per restaurant) the
seating of one word is independent of all others, in its contexts and in
the parent.  So the hash space of words is cut into buckets, each holding its words' counts per
context; buckets are sampled in parallel, and the totals are summed up
between passes.  A step redraws the number of tables of a word in one restaurant
given all others, by generalised Stirling numbers: their logs up to ``EXACT``
customers, the ratios of neighbouring ones beyond (``Ratios``).

To score, texts' tokens travel to their words' buckets in packed chunks and return as sums per
document.  Both ways, and that of the training counts, have two steps: a chunk is cut by groups of buckets,
about the root of their number, and as many chunks' cuts for a group are cut by its buckets.  So the
rows of an exchange grow as tokens times the root of the buckets, and hold many tokens each.  Tokens of frequent words (a share of at least ``FREQUENT`` each, so at most
1 / FREQUENT of them) are scored where they are read, from a table of bounded size.
Every training token counts; buckets grow in number with the corpus, not in size.

Defined cases: null and empty texts are one end token; whole texts are scored; null
ids are in fold 0; without training texts every token has probability 1; repeated
rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import staged, unstage
from pitlane.llm.labelled import remainder

FOLDS, HELD_OUT = 5, 1
ANCHORS = 64
FREQUENT = 2.0**-16
BUCKET_TOKENS = 1_500_000  # tokens of rare words a bucket holds, about
LEAST_BUCKETS = 48
CHUNK = 1_000_000  # tokens packed together
EXACT = 32
ONE_BY_ONE = 128  # cells of a word drawn one after another at most
PASSES = 2  # passes that settle the totals
BURN, SAMPLES = 2, 4  # steps over each word's restaurants in the last pass: dropped, averaged
SEED = 20
STRENGTH = 1.0

_CONTEXT_BITS = 7
_KEY_BITS = 56
_RARE = 1 << 62  # words' codes: a rank below, a key above


class Vocabulary(NamedTuple):
    """Frequent words by falling count, the anchors first; sizes of the training text."""

    keys: np.ndarray  # keys of the frequent words
    counts: np.ndarray
    anchors: int
    tokens: int
    words: int
    buckets: int

    @property
    def contexts(self) -> int:
        return self.anchors + 1


def key(word: bytes) -> int:
    """56-bit key of a word; the end token is the empty word."""
    return xxhash.xxh64_intdigest(word) >> (64 - _KEY_BITS)


class _Codes(dict):
    """Word -> rank among the frequent words, or _RARE + key."""

    def __init__(self, ranks: dict[int, int]):
        self.ranks = ranks

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        k = key(word)
        code = self[word] = self.ranks.get(k, _RARE + k)
        return code


def words_of(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), b""]


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_STRIPE = 32  # bytes from which XXH64 goes another way
_BLOCK = 1 << 20  # bytes of text whose words are hashed together


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def _hashes(text: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 of the parts of ``text`` that begin at ``at``: those of one size at once, long ones by the library."""
    eights = np.frombuffer(text + bytes(16 - len(text) % 8), "<u8")
    out = np.empty(len(at), np.uint64)
    kind = np.minimum(size, _STRIPE).astype(np.uint8)
    order = np.argsort(kind, kind="stable")
    ends = np.cumsum(np.bincount(kind, minlength=_STRIPE + 1))
    for n in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
        some = order[ends[n - 1] if n else 0 : ends[n]]
        if n == _STRIPE:
            out[some] = [xxhash.xxh64_intdigest(text[a : a + k]) for a, k in zip(at[some].tolist(), size[some].tolist(), strict=True)]
            continue
        place, by = at[some] >> 3, ((at[some] & 7) << 3).astype(np.uint64)
        back, lane = np.uint64(63) - by, eights[place]
        h = np.full(len(some), _P5 + np.uint64(n))
        for k in range(-(-n // 8)):
            following = eights[place + (k + 1)]
            eight = lane >> by | (following << np.uint64(1)) << back
            lane = following
            left = n - 8 * k
            if left >= 8:
                h = _turned(h ^ _turned(eight * _P2, 31) * _P1, 27) * _P1 + _P4
                continue
            if left >= 4:
                h = _turned(h ^ (eight & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
                eight >>= np.uint64(32)
            for _ in range(left % 4):
                h = _turned(h ^ (eight & np.uint64(0xFF)) * _P5, 11) * _P1
                eight >>= np.uint64(8)
        h = (h ^ h >> np.uint64(33)) * _P2
        h = (h ^ h >> np.uint64(29)) * _P3
        out[some] = h ^ h >> np.uint64(32)
    return out


def word_keys(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """``key`` of each word of ``words_of``, text after text, and the texts' numbers of words."""
    text = b" ".join([b"", *(t or b"" for t in texts), b""]).lower()
    data = np.frombuffer(text, np.uint8)
    inside = (data != 32) & (data - np.uint8(9) > 4)
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    at, size = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    before = np.searchsorted(at, ends)  # words up to each text's end
    per = np.diff(before, prepend=0)
    keys = np.full(len(at) + len(texts), key(b""), np.int64)
    keys[np.arange(len(at)) + np.repeat(np.arange(len(texts)), per)] = _hashes(text, at, size) >> np.uint64(64 - _KEY_BITS)
    return keys, per + 1


def blocks(texts: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Neighbouring texts of about ``_BLOCK`` bytes: their places, ``word_keys``."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(sizes):
        end = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + _BLOCK)) + 1
        some = slice(start, min(end, len(sizes)))
        yield some, *word_keys(texts[some].to_pylist())
        start = some.stop


def contexts(codes: np.ndarray, anchors: int) -> np.ndarray:
    """Rank of the last anchor before each token; ``anchors`` where there is none."""
    at = np.where(codes < anchors, np.arange(len(codes)), -1)
    last = np.concatenate([[-1], np.maximum.accumulate(at)[:-1]])
    return np.where(last < 0, anchors, codes[np.maximum(last, 0)]).astype(np.uint8)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training words counted per task."""
    part, held = [], 0
    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def fold():
        nonlocal part, held, keys, n
        if part:
            got, times = np.unique(np.concatenate(part), return_counts=True)
            keys, n = _merged(np.concatenate([keys, got]), np.concatenate([n, times]))
        part, held = [], 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["word", "n"])

    for batch in batches:
        for _, some, _ in blocks(batch.column("text")):
            part.append(some)
            held += len(some)
            if held >= CHUNK:
                fold()
                if len(keys) > 1 << 19:
                    yield out()
                    keys, n = keys[:0], n[:0]
    fold()
    yield out()


def vocabulary(texts: DataFrame, anchors: int = ANCHORS, frequent: float = FREQUENT, bucket_tokens: int = BUCKET_TOKENS, least: int = LEAST_BUCKETS):
    """Sizes and frequent words of the training texts (``text`` binary)."""
    counts = staged(texts.mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, words = total[0] or 0, total[1]
    often = counts.where(F.col("n") >= max(2.0, tokens * frequent)).collect()  # at most 1 / frequent rows
    unstage(counts)
    end = key(b"")
    often = sorted(((r["n"], r["word"]) for r in often), key=lambda x: (-x[0], x[1]))
    inner = [w for w in often if w[1] != end]
    ordered = inner[:anchors] + [w for w in often if w[1] == end] + inner[anchors:]
    keys, n = np.array([w for _, w in ordered], np.int64), np.array([n for n, _ in ordered], np.int64)
    buckets = max(least, math.ceil((tokens - int(n.sum())) / bucket_tokens))
    return Vocabulary(keys, n, min(anchors, len(inner)), tokens, words, buckets)


def _bounds(buckets: int) -> np.ndarray:
    """First key of each bucket: equal ranges of the hash space."""
    return np.array([-(-(b << _KEY_BITS) // buckets) for b in range(buckets)], np.int64)


def _width(buckets: int) -> int:
    """Buckets of a group: about as many as there are groups."""
    return math.isqrt(max(buckets, 1) - 1) + 1


def _piece(groups: int, turn: int) -> int:
    """What meets in the second step: the ``turn``-th chunks of as many neighbouring tasks as there are groups."""
    return (TaskContext.get().partitionId() // groups) << 32 | turn


def _cuts(keys: np.ndarray, edges: np.ndarray) -> list[tuple[int, slice]]:
    """The places of sorted keys that lie in each range from one edge to the next, without the empty ones."""
    at = np.searchsorted(keys, [*edges, 1 << _KEY_BITS])
    return [(b, slice(at[b], at[b + 1])) for b in np.flatnonzero(at[1:] > at[:-1]).tolist()]


def _merged(cells: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(cells)
    cells, n = cells[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, int)
    return cells[first], np.add.reduceat(n, first) if len(first) else n[:0]


def _cells(v: Vocabulary):
    """Training tokens as counts of (word key, context), packed by groups of buckets."""
    edges = _bounds(v.buckets)[:: _width(v.buckets)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes({int(k): i for i, k in enumerate(v.keys)})
        part, held, turn = [], 0, 0
        cells, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def fold():
            nonlocal part, held, cells, n
            if part:
                got, times = np.unique(np.concatenate(part), return_counts=True)
                cells, n = _merged(np.concatenate([cells, got]), np.concatenate([n, times]))
            part, held = [], 0

        def out():
            some = _cuts(cells >> _CONTEXT_BITS, edges)
            piece = _piece(len(edges), turn)
            blobs = [[x[at].tobytes() for _, at in some] for x in (cells, n)]
            columns = [pa.array([g for g, _ in some], pa.int32()), pa.array([piece] * len(some), pa.int64()), *(pa.array(x, pa.binary()) for x in blobs)]
            return pa.RecordBatch.from_arrays(columns, ["grp", "piece", "cells", "n"])

        for batch in batches:
            for text in batch.column("text"):
                words = words_of(text.as_py())
                code = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
                keys = np.where(code < _RARE, v.keys[np.minimum(code, len(v.keys) - 1)], code - _RARE) if len(v.keys) else code - _RARE
                part.append(keys << _CONTEXT_BITS | contexts(code, v.anchors))
                held += len(words)
                if held >= CHUNK:
                    fold()
                    if len(cells) > 1 << 22:
                        yield out()
                        cells, n, turn = cells[:0], n[:0], turn + 1
        fold()
        yield out()

    return task


def _deal_cells(v: Vocabulary):
    """A group's counts from many tasks, merged and packed by bucket."""
    edges = _bounds(v.buckets)

    def task(rows: pa.Table) -> pa.Table:
        cells, n = (np.concatenate([np.frombuffer(x, np.int64) for x in rows.column(c).to_pylist()]) for c in ("cells", "n"))
        cells, n = _merged(cells, n)
        some = _cuts(cells >> _CONTEXT_BITS, edges)
        blobs = [[x[at].tobytes() for _, at in some] for x in (cells, n)]
        return pa.table([pa.array([b for b, _ in some], pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)], ["bucket", "cells", "n"])

    return task


_TABLE = "bucket int, keys binary, cells binary, contexts binary, n binary, ones long, twos long, customers array<long>, guess array<double>"


def _gather(width: int):
    """One row per bucket: its words, how many contexts each has, and the cells' contexts and counts."""

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        cells, n = (np.concatenate([np.frombuffer(x, np.int64) for x in rows[c]]) for c in ("cells", "n"))
        cells, n = _merged(cells, n)
        keys, per = np.unique(cells >> _CONTEXT_BITS, return_counts=True)
        context = (cells & ((1 << _CONTEXT_BITS) - 1)).astype(np.uint8)
        seen = np.bincount(context, n, width).astype(np.int64)
        guess = np.bincount(context, n**0.7, width)
        row = (int(rows["bucket"].iloc[0]), keys.tobytes(), per.astype(np.uint8).tobytes(), context.tobytes(), n.tobytes())
        return pd.DataFrame([(*row, int((n == 1).sum()), int((n == 2).sum()), seen.tolist(), guess.tolist())], columns=[c.split()[0] for c in _TABLE.split(", ")])

    return task


class Totals(NamedTuple):
    """What couples the words: customers and tables of each context and of the parent, discounts, the base."""

    customers: np.ndarray
    tables: np.ndarray
    parent_customers: float
    parent_tables: float
    discount: float
    parent_discount: float
    base: float

    @property
    def strengths(self) -> np.ndarray:
        return STRENGTH + self.discount * self.tables

    @property
    def parent_strength(self) -> float:
        return STRENGTH + self.parent_discount * self.parent_tables


@cache
def stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Logs of the generalised Stirling numbers S(n, k), n and k up to ``most``."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[1, 1] = 0.0
    for n in range(1, most):
        for k in range(1, n + 2):
            stay = s[n, k] + math.log(n - k * discount) if k <= n and n - k * discount > 0 else -np.inf
            s[n + 1, k] = np.logaddexp(s[n, k - 1], stay)
    return s


_TOGETHER = 1 << 14
_CLASSES = (1, 2, 4, 8, 16, EXACT)  # customers up to the next bound are drawn together


class Ratios:
    """Ratios S(n, t + 1) / S(n, t) of generalised Stirling numbers for any n and t.

    Their recursion in n needs no logs and gives them exactly on rows n of a geometric grid.
    Between rows and beyond the last one: by the saddle point of their generating function
    ((1 - (1 - x)^d) / d)^t / t!, a ratio is f(t / n) / (d t) but for a small correction, read off the nearest
    row: of order n^-d and a function of t / n^d for few tables, of order 1 / n and of t / n for many.
    """

    ROWS = 2048  # customers of the last exact row

    def __init__(self, discount: float):
        self.d = d = discount
        self.log_y = -np.concatenate([np.linspace(40.0, 0.05, 3000), np.geomspace(0.05, 1e-9, 2000)[1:]])  # y = 1 - x at the saddle point, where t d y^(d-1) (1 - y) = n (1 - y^d)
        y = np.exp(self.log_y)
        f = -np.expm1(d * self.log_y)
        self.log_share, self.log_f = np.log(f) + (1 - d) * self.log_y - np.log(d * -np.expm1(self.log_y)), np.log(f)
        assert (np.diff(self.log_share) > 0).all() and y[-1] < 1
        grid = np.unique(np.rint(EXACT * 1.08 ** np.arange(1 + int(math.log(self.ROWS / EXACT) / math.log(1.08)))).astype(int))
        self.rows = np.append(grid[grid < self.ROWS], self.ROWS)
        self.corrections = np.zeros((len(self.rows), self.ROWS))
        q, k = np.zeros(self.ROWS + 1), 0  # q[t] of the present n; nothing at t = 0
        for n in range(1, self.ROWS + 1):
            if n == self.rows[k]:
                t = np.arange(1, n)
                self.corrections[k, 1:n] = np.log(q[1:n]) - self._saddle(np.log(t), math.log(n))
                self.corrections[k, n:] = self.corrections[k, n - 1]
                self.corrections[k, 0] = self.corrections[k, 1]
                k += 1
            t = np.arange(1, n + 1)
            before = np.append(np.inf, q[1:n])  # q[t - 1]: without tables there is nothing to come from
            q[1 : n + 1] = (1 + (n - (t + 1) * d) * q[1 : n + 1]) / (1 / before + n - t * d)

    def _saddle(self, log_t, log_n):
        return np.interp(log_t - log_n, self.log_share, self.log_f) - math.log(self.d) - log_t

    def row(self, n: np.ndarray) -> np.ndarray:
        """Index of the nearest exact row."""
        above = np.clip(np.searchsorted(self.rows, n), 1, len(self.rows) - 1)
        return np.where(n * n < self.rows[above - 1] * self.rows[above], above - 1, above)

    def log(self, n: np.ndarray, t: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Logs of the ratios for customers ``n`` (rows, 1) and tables ``t`` (rows, columns), 1 <= t < n."""
        last = self.rows[row]
        scale = (last / n) ** (self.d + (1 - self.d) * t / n)
        at = np.minimum(t * scale, last - 1.001)
        low = at.astype(np.int64)
        here = self.corrections[row, low]
        here = here + (at - low) * (self.corrections[row, low + 1] - here)
        return self._saddle(np.log(t), np.log(n)) + scale * here


_ratios = lru_cache(maxsize=8)(Ratios)
_COLUMNS = 48


def _draw_many(n, strength, weight, discount, rng):
    """``_draw`` for words with more than ``EXACT`` customers.

    The chances of t + 1 and of t tables differ by strength x weight(t) x ratio(n, t).  Around the
    number at which that is one, chances are summed up on an even grid of whole numbers (all of
    them if they are few) and one is drawn.
    """
    ratios = _ratios(round(discount, 6))
    n, row, more = n[:, None].astype(float), ratios.row(n)[:, None], np.log(strength)[:, None]

    def step(t):
        return more + np.log(weight(t)) + ratios.log(n, t, row)

    low, high = np.zeros_like(n), np.log(n - 1)
    for _ in range(14):
        middle = (low + high) / 2
        up = step(np.exp(middle)) > 0
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    mode = np.exp(low)
    near = np.maximum(mode, 2.0)
    a, b = np.clip(near * 0.9, 1.0, n - 1.5), np.clip(near * 1.1, 1.5, n - 1.0)
    spread = np.sqrt((b - a) / np.maximum(step(a) - step(b), 1e-9))
    spread = np.clip(spread, 0.5, np.maximum(mode, 2.0))
    first = np.maximum(np.floor(mode - 6 * spread), 1.0)
    width = np.maximum(np.ceil((np.minimum(np.ceil(mode + 6 * spread + 8), n) - first + 1) / _COLUMNS), 1.0)
    points = first + width * np.arange(_COLUMNS)
    inside = np.clip(points[:, :-1] + (width - 1) / 2, 1.0, n - 1)
    logs = np.concatenate([np.zeros_like(n), np.cumsum(width * step(inside), axis=1)], axis=1)
    logs[points > n] = -np.inf
    chance = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
    pick = (chance < rng.random(n.shape) * chance[:, -1:]).sum(axis=1)
    width = width[:, 0]
    jitter = np.rint((rng.random(len(width)) - 0.5) * width)
    return np.clip(points[np.arange(len(pick)), pick] + jitter, 1, n[:, 0]).astype(np.int64)


def _draw(n, most, strength, weight, discount, rng):
    """Tables of words with ``n`` customers in a restaurant, ``most`` at most.

    ``weight(i)``, i an array, has the parent's probability of the word once it
    has i more customers: a row per word and a column per i.
    """
    if most > EXACT:
        return _draw_many(n, strength, weight, discount, rng)
    logs = np.cumsum(np.log(strength[:, None] * weight(np.arange(most)[None, :])), axis=1)
    logs += stirling(discount)[n, 1 : most + 1]  # minus infinity beyond n tables
    logs -= logs.max(axis=1, keepdims=True)
    chance = np.cumsum(np.exp(logs, out=logs), axis=1, out=logs)
    return 1 + (chance < rng.random((len(n), 1)) * chance[:, -1:]).sum(axis=1)


def _by_size(n: np.ndarray, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(most customers, rows) of the classes of ``rows`` with more than one customer, at most _TOGETHER rows at once."""
    kind = np.searchsorted(_CLASSES, n[rows])
    bounds = (*_CLASSES, 1 << 62)
    classes = ((bounds[k], rows[kind == k]) for k in range(1, len(bounds)))
    return [(most, some[i : i + _TOGETHER]) for most, some in classes for i in range(0, len(some), _TOGETHER)]


class Seating(NamedTuple):
    """Samples of a bucket's seats, one row each."""

    tables: np.ndarray  # of each cell
    parent_customers: np.ndarray  # of each word
    parent_tables: np.ndarray


def seat(per: np.ndarray, context: np.ndarray | None, n: np.ndarray, totals: Totals, seed: list[int], burn: int, samples: int, strengths=None, fixed=None, one_by_one: int = ONE_BY_ONE) -> Seating:
    """Gibbs over one bucket's words: the ``samples`` steps after ``burn``.

    ``strengths`` has those of the cells if they are not in ``totals``, ``fixed`` the parent's customers of each word from other
    cells.  The cells of a word are drawn one after another.  Those of a word with more than ``one_by_one`` are drawn together, given a draw of the
    parent's probability: the product of its predictive probabilities, a rising factorial, is the mean of its powers under a gamma distribution.
    """
    rng = np.random.default_rng(seed)
    word = np.repeat(np.arange(len(per)), per)
    start = np.concatenate([[0], np.cumsum(per)[:-1]]).astype(np.int64)
    rank = np.arange(len(word)) - start[word]
    rank[per[word] > one_by_one] = one_by_one
    # one cell of a word at a time, cells of like size together
    ranks = np.split(np.argsort(rank, kind="stable"), np.cumsum(np.bincount(rank))[:-1]) if len(rank) else []
    strengths, base = totals.strengths[context] if strengths is None else strengths, totals.parent_strength * totals.base
    turns = [(most, cells, word[cells], strengths[cells]) for r in ranks[:one_by_one] for most, cells in _by_size(n, r)]
    crowd = [(most, cells, word[cells], strengths[cells]) for r in ranks[one_by_one:] for most, cells in _by_size(n, r)]
    crowded = np.flatnonzero(per > one_by_one)
    scale = STRENGTH + totals.parent_customers
    d0 = totals.parent_discount
    t = np.maximum(1, np.rint(n**totals.discount)).astype(np.int64)
    fixed = np.zeros(len(per), np.int64) if fixed is None else fixed

    def customers():
        return fixed + np.bincount(word, t, len(per)).astype(np.int64)

    c0 = customers()
    t0 = np.maximum(1, np.rint(c0**d0)).astype(np.int64)
    kept = []
    for step in range(burn + samples):
        for most, cells, w, strength in turns:
            others = c0[w] - t[cells]
            seated = np.minimum(t0[w], others)[:, None]
            had = others[:, None]

            def weight(i, had=had, seated=seated):
                tables = np.where(had > 0, seated, np.minimum(i, 1))
                return (had + i - d0 * tables + base) / scale

            t[cells] = _draw(n[cells], most, strength, weight, totals.discount, rng)
            c0[w] = others + t[cells]
        if len(crowded):
            chance = np.zeros(len(per))
            chance[crowded] = rng.gamma(c0[crowded] - d0 * np.minimum(t0, c0)[crowded] + base) / scale
            for most, cells, w, strength in crowd:
                t[cells] = _draw(n[cells], most, strength, lambda i, g=chance[w][:, None]: np.broadcast_to(g, (len(g), i.shape[1])), totals.discount, rng)
            c0 = customers()
        t0 = np.minimum(c0, 1)
        for most, rows in _by_size(c0, np.arange(len(c0))):
            flat = np.full(len(rows), totals.parent_strength)
            t0[rows] = _draw(c0[rows], most, flat, lambda i, m=len(rows): np.full((m, i.shape[1]), totals.base), d0, rng)
        if step >= burn:
            kept.append((t.copy(), c0.copy(), t0))
    return Seating(*(np.array(x) for x in zip(*kept, strict=True)))


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    kinds = (("keys", np.int64), ("cells", np.uint8), ("contexts", np.uint8), ("n", np.int64))
    keys, per, context, n = (np.frombuffer(row[c], k) for c, k in kinds)
    return keys, per.astype(np.int64), context, n


_SUMS = "tables array<double>, parent_customers array<double>, parent_tables array<double>, ones long, twos long, words binary, seats binary, often binary"
_OFTEN = np.dtype([("word", "<u4"), ("context", "u1"), ("own", "<f8")])  # word: its place among the bucket's frequent ones


def _pass(totals: Totals, often: np.ndarray | None, burn: int, samples: int, turn: int):
    """Totals of each bucket's samples; words and cells of the frequent words, if ``often`` has their sorted keys."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                keys, per, context, n = _unpack(row)
                got = seat(per, context, n, totals, [SEED, turn, row["bucket"]], burn, samples)
                tables = np.concatenate([np.bincount(context, t, len(totals.tables)) for t in got.tables])
                c0, t0 = got.parent_customers, got.parent_tables
                words = seats = picked = b""
                if often is not None:
                    chosen = np.isin(keys, often)
                    word = np.repeat(np.arange(len(per)), per)
                    cells = np.flatnonzero(chosen[word])
                    rows = np.zeros(len(cells), _OFTEN)
                    rows["word"], rows["context"] = (np.cumsum(chosen) - 1)[word[cells]], context[cells]
                    rows["own"] = n[cells] - totals.discount * got.tables[:, cells].mean(axis=0)
                    words, picked = keys[chosen].tobytes(), rows.tobytes()
                    seats = np.array([c0[:, chosen], t0[:, chosen]], np.int64).tobytes()
                ones, twos = (int((c0[-1] == k).sum()) for k in (1, 2))
                out.append((tables.tolist(), c0.sum(axis=1).astype(float).tolist(), t0.sum(axis=1).astype(float).tolist(), ones, twos, words, seats, picked))
            numbers = pa.list_(pa.float64())
            kinds = (numbers, numbers, numbers, pa.int64(), pa.int64(), *[pa.binary()] * 3)
            names = [c.split()[0] for c in _SUMS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return task


def _discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


class Model(NamedTuple):
    vocabulary: Vocabulary
    totals: Sampled
    table: DataFrame | None
    log_p: np.ndarray  # frequent word x context: log10 of the predictive probability


def _totals(rows, discount: float | None, given: Totals) -> list[Totals]:
    """The totals of each sample, summed over buckets (whole numbers, in any order)."""
    d0 = round(_discount(sum(r["ones"] for r in rows), sum(r["twos"] for r in rows)), 4) if discount is None else discount
    c0, t0, tables = (np.sum([r[c] for r in rows], axis=0) for c in ("parent_customers", "parent_tables", "tables"))
    return [
        given._replace(tables=t, parent_customers=float(c), parent_tables=float(p), parent_discount=d0)
        for c, p, t in zip(c0, t0, tables.reshape(len(c0), -1), strict=True)
    ]


def train(docs: DataFrame, **sizes) -> Model:
    """Model of the texts outside the held-out fold."""
    texts = docs.where(remainder(FOLDS) != HELD_OUT).select(F.col("text").cast("binary").alias("text"))
    v = vocabulary(texts, **sizes)
    if not v.tokens:
        return Model(v, Sampled(Totals(np.zeros(1), np.zeros(1), 0.0, 0.0, 0.5, 0.5, 1.0), []), None, np.zeros((0, 1)))
    packed = texts.mapInArrow(_cells(v), "grp int, piece long, cells binary, n binary")
    packed = packed.groupBy("grp", "piece").applyInArrow(_deal_cells(v), "bucket int, cells binary, n binary")
    table = staged(packed.groupBy("bucket").applyInPandas(_gather(v.contexts), _TABLE), "restaurants")
    rows = table.select("ones", "twos", "customers", "guess").collect()  # a few numbers per bucket and context
    customers, guess = (np.sum([r[c] for r in rows], axis=0) for c in ("customers", "guess"))
    totals = Totals(
        customers.astype(float), guess, float(guess.sum()), float(v.words),
        round(_discount(sum(r["ones"] for r in rows), sum(r["twos"] for r in rows)), 4), 0.5, 1 / (v.words + 1),
    )
    cells = table.select("bucket", "keys", "cells", "contexts", "n")
    for turn in range(PASSES):
        (totals,) = _totals(cells.mapInArrow(_pass(totals, None, 1, 1, turn), _SUMS).collect(), None, totals)
    sums = cells.mapInArrow(_pass(totals, np.sort(v.keys), BURN, SAMPLES, PASSES), _SUMS).collect()
    sampled = Sampled(totals, _totals(sums, totals.parent_discount, totals))
    own, seats = np.zeros((len(v.keys), v.contexts)), np.zeros((2, SAMPLES, len(v.keys)))
    place = np.argsort(v.keys)
    for r in sums:
        index = place[np.searchsorted(v.keys[place], np.frombuffer(r["words"], np.int64))]
        seats[:, :, index] = np.frombuffer(r["seats"], np.int64).reshape(2, SAMPLES, -1)
        often = np.frombuffer(r["often"], _OFTEN)
        own[index[often["word"]], often["context"]] = often["own"]
    backed = sampled.parents(*seats).T @ sampled.strengths / SAMPLES
    return Model(v, sampled, cells, np.log10((own + backed) / (STRENGTH + totals.customers)))


class Sampled(NamedTuple):
    """Totals the last pass was sampled with, and those of each of its samples."""

    given: Totals
    samples: list[Totals]

    @property
    def strengths(self) -> np.ndarray:
        """Of each sample's contexts."""
        return np.array([t.strengths for t in self.samples])

    def parents(self, customers, tables) -> np.ndarray:
        """The unigram restaurant's predictive probabilities under each sample, a row of words each."""
        return np.array([_parent(c, t, totals) for c, t, totals in zip(customers, tables, self.samples, strict=True)])


def _parent(customers, tables, totals: Totals):
    """The unigram restaurant's predictive probability."""
    return (customers - totals.parent_discount * tables + totals.parent_strength * totals.base) / (STRENGTH + totals.parent_customers)


_DOC = np.dtype([("id", "<i8"), ("null", "?"), ("held", "?"), ("tokens", "<i8"), ("known", "<i8"), ("score", "<f8"), ("base", "<f8")])
_PART = np.dtype([("chunk", "<i8"), ("at", "<u4"), ("known", "<u4"), ("score", "<f8"), ("base", "<f8")])
_TOKENS = (("at", np.uint32), ("keys", np.int64), ("contexts", np.uint8))
_PACKED = "grp int, piece long, chunk long, docs binary, at binary, keys binary, contexts binary"
_DEALT = "bucket int, grp int, piece long, chunk long, docs binary, chunks binary, place binary, at binary, keys binary, contexts binary"
_SCORED = "grp int, piece long, chunk long, docs binary, parts binary"


def _arrow(rows: list[tuple], schema: str) -> list[pa.Array]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return [pa.array([r[i] for r in rows], kinds[c.split()[1]]) for i, c in enumerate(schema.split(", "))]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _pack(model: Model):
    """Texts in chunks: frequent tokens scored at once, the others packed for their groups of buckets."""
    v, log_p = model.vocabulary, model.log_p
    edges = _bounds(v.buckets)[:: _width(v.buckets)]
    log_n = np.log10(v.counts + 0.5)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes({int(k): i for i, k in enumerate(v.keys)})
        first = chunk = TaskContext.get().partitionId() << 32
        docs, rare, held = [], [], 0

        def out():
            at, keys, context = (np.concatenate([r[i] for r in rare]) for i in range(3))
            order = np.argsort(keys, kind="stable")
            at, keys, context = at[order], keys[order], context[order]
            piece = _piece(len(edges), chunk - first)
            rows = [(int(chunk % len(edges)), piece, chunk, np.array(docs, _DOC).tobytes(), None, None, None)]
            rows += [(g, piece, chunk, None, at[s].tobytes(), keys[s].tobytes(), context[s].tobytes()) for g, s in _cuts(keys, edges)]
            return pa.RecordBatch.from_arrays(_arrow(rows, _PACKED), _names(_PACKED))

        for batch in batches:
            for doc, fold, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text"), strict=True):
                words = words_of(text.as_py())
                code = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
                context = contexts(code, v.anchors)
                often = code < _RARE
                f = code[often]
                docs.append((doc or 0, doc is None, fold, len(words), len(f), log_p[f, context[often]].sum(), log_n[f].sum()))
                left = code[~often] - _RARE
                rare.append((np.full(len(left), len(docs) - 1, np.uint32), left, context[~often]))
                held += len(words)
                if held >= CHUNK:
                    yield out()
                    docs, rare, held, chunk = [], [], 0, chunk + 1
        if docs:
            yield out()

    return task


def _deal(v: Vocabulary):
    """A group's tokens from many chunks, packed by bucket; the documents' own rows pass through."""
    edges = _bounds(v.buckets)

    def task(texts: pa.Table) -> pa.Table:
        rows = texts.to_pylist()
        grp, piece = rows[0]["grp"], rows[0]["piece"]
        out = [(r["chunk"] % v.buckets, grp, piece, r["chunk"], r["docs"], *[None] * 5) for r in rows if r["docs"] is not None]
        tokens = sorted((r for r in rows if r["docs"] is None), key=lambda r: r["chunk"])
        if tokens:
            at, keys, context = (np.concatenate([np.frombuffer(r[c], k) for r in tokens]) for c, k in _TOKENS)
            place = np.repeat(np.arange(len(tokens), dtype=np.uint32), [len(r["at"]) // 4 for r in tokens])
            order = np.argsort(keys, kind="stable")
            place, at, keys, context = place[order], at[order], keys[order], context[order]
            chunks = np.array([r["chunk"] for r in tokens], np.int64).tobytes()
            out += [(b, grp, piece, None, None, chunks, *(x[s].tobytes() for x in (place, at, keys, context))) for b, s in _cuts(keys, edges)]
        return pa.table(_arrow(out, _DEALT), _names(_DEALT))

    return task


def _score(model: Model):
    """Sums per document of a bucket's tokens; the documents' own rows pass through."""
    sampled = model.totals
    given, strengths = sampled.given, sampled.strengths
    nobody = np.zeros((SAMPLES, 1))

    def find(table, wanted):
        """Places of ``wanted`` in the sorted ``table``; its length for what is not there."""
        if not len(table):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.searchsorted(table, wanted)
        hit = table[np.minimum(at, len(table) - 1)] == wanted
        return np.where(hit, at, len(table)), hit

    def task(texts: pa.Table, words: pa.Table) -> pa.Table:
        rows = words.to_pylist()
        if rows:
            keys, per, context, n = _unpack(rows[0])
            got = seat(per, context, n, given, [SEED, PASSES, rows[0]["bucket"]], BURN, SAMPLES)
            cells = np.repeat(keys, per) << _CONTEXT_BITS | context
            own = np.append(n - given.discount * got.tables.mean(axis=0), 0.0)
            count = np.append(np.add.reduceat(n, np.concatenate([[0], np.cumsum(per)[:-1]])), 0)
            seats = (np.concatenate([x, nobody], axis=1) for x in (got.parent_customers, got.parent_tables))
        else:
            keys = cells = np.zeros(0, np.int64)
            own, count, seats = np.zeros(1), np.zeros(1, np.int64), (nobody, nobody)
        parents = sampled.parents(*seats)

        out = []
        for row in texts.to_pylist():
            if row["docs"] is not None:
                out.append((row["grp"], row["piece"], row["chunk"], row["docs"], None))
                continue
            at, key_, u = (np.frombuffer(row[c], k) for c, k in _TOKENS)
            chunks, place = np.frombuffer(row["chunks"], np.int64), np.frombuffer(row["place"], np.uint32)
            word, known = find(keys, key_)
            cell, _ = find(cells, key_ << _CONTEXT_BITS | u)
            backed = sum(s[u] * p[word] for s, p in zip(strengths, parents, strict=True)) / SAMPLES
            logs = np.log10((own[cell] + backed) / (STRENGTH + given.customers[u]))
            seen = np.log10(count[word] + 0.5)
            docs, to = np.unique(place.astype(np.int64) << 32 | at, return_inverse=True)
            part = np.zeros(len(docs), _PART)
            part["chunk"], part["at"], part["known"] = chunks[docs >> 32], docs & 0xFFFFFFFF, np.bincount(to, known)
            part["score"], part["base"] = np.bincount(to, logs), np.bincount(to, seen)
            out.append((row["grp"], row["piece"], None, None, part.tobytes()))
        return pa.table(_arrow(out, _SCORED), _names(_SCORED))

    return task


def _ordered(parts: np.ndarray) -> np.ndarray:
    """By chunk and document, and such that reruns add up in one order."""
    return parts[np.lexsort((parts["base"], parts["score"], parts["at"], parts["chunk"]))]


def _collect(rows: pa.Table) -> pa.Table:
    """The sums of a group's buckets, added up and cut by chunk; the documents' own rows pass through."""
    rows = rows.to_pylist()
    out = [(r["chunk"], r["docs"], None) for r in rows if r["docs"] is not None]
    parts = [np.frombuffer(r["parts"], _PART) for r in rows if r["parts"] is not None]
    if parts:
        parts = _ordered(np.concatenate(parts))
        new = (parts["chunk"][1:] != parts["chunk"][:-1]) | (parts["at"][1:] != parts["at"][:-1])
        first = np.flatnonzero(np.concatenate([[True], new]))
        sums = parts[first]
        for c in ("known", "score", "base"):
            sums[c] = np.add.reduceat(parts[c], first)
        cut = np.flatnonzero(sums["chunk"][1:] != sums["chunk"][:-1]) + 1
        out += [(int(x["chunk"][0]), None, x.tobytes()) for x in np.split(sums, cut)]
    return pa.table(_arrow(out, _CHUNKS), _names(_CHUNKS))


_CHUNKS = "chunk long, docs binary, parts binary"
_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _unite(tokens: int, words: int):
    """The documents of one chunk with their groups' sums."""
    norm = math.log10(tokens + 0.5 * (words + 1))

    def task(rows: pa.Table) -> pa.Table:
        docs = np.concatenate([np.frombuffer(x, _DOC) for x in rows.column("docs").to_pylist() if x is not None]).copy()
        parts = [np.frombuffer(x, _PART) for x in rows.column("parts").to_pylist() if x is not None]
        if parts:
            parts = _ordered(np.concatenate(parts))
            for c in ("known", "score", "base"):
                docs[c] += np.bincount(parts["at"], parts[c], len(docs)).astype(docs[c].dtype)
        ids = pa.array(docs["id"], mask=docs["null"])
        columns = [ids, pa.array(docs["held"]), pa.array(docs["tokens"]), pa.array(docs["known"]), pa.array(np.full(len(docs), tokens, np.int64))]
        columns += [pa.array(docs["base"] - docs["tokens"] * norm), pa.array(docs["score"])]
        return pa.table(columns, [c.split()[0] for c in _RESULT.split(", ")])

    return task


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    v = model.vocabulary
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("binary").alias("text"))
    if model.table is None:
        counted = texts.select("doc_id", "held_out", (F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")).alias("n"))
        n = F.coalesce("n", F.lit(0)) + 1
        zero = F.lit(0).cast("long")
        return counted.select("doc_id", "held_out", n.alias("n_tokens"), zero.alias("n_known"), zero.alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    packed = texts.mapInArrow(_pack(model), _PACKED).groupBy("grp", "piece").applyInArrow(_deal(v), _DEALT)
    sums = packed.groupBy("bucket").cogroup(model.table.groupBy("bucket")).applyInArrow(_score(model), _SCORED)
    chunks = sums.groupBy("grp", "piece").applyInArrow(_collect, _CHUNKS)
    return chunks.groupBy("chunk").applyInArrow(_unite(v.tokens, v.words), _RESULT)


def perplexity(scores: DataFrame) -> DataFrame:
    """Perplexity per token by fold, of the model and of the base."""
    def of(c):
        return F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))

    return scores.groupBy("held_out").agg(of("score").alias("perplexity"), of("base_score").alias("base_perplexity"))
