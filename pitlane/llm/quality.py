"""Quality by a generalised additive model with pairwise interactions.

A text is measured by a few statistics; each is cut into bins, and the model is
one lookup table per statistic plus one per chosen pair of statistics.  The tables
are learned by cyclic boosting: round after round, a tree of at most ``LEAVES``
leaves over one statistic's bins is fitted to what the others leave, and a small part
of it is added to that statistic's table; then the pairs with the largest gain
over the remaining error get tables the same way.  A score is the logistic of
a sum of table entries, read for a whole batch at once.

Only labels of rows outside fold ``HELD_OUT`` of crc32(doc_id) mod 4 are used, a
bounded sample of about ``SAMPLE`` per class, weighted to the class sizes.
Inputs are statistics of the text alone.

Defined cases: null text counts as empty, whose statistics are 0; whole texts are
measured; without labels of both classes the score is their share (0.5 without
any); null ids are in fold 0; repeated rows are scored each; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import staged
from pitlane.llm.labelled import remainder, sampled_labels, with_labels

SAMPLE = 12_000
HELD_OUT = 2
ACCEPT = 0.7
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 250
LEAVES = 3
RATE = 0.08
SMOOTH = 1.0

STATISTICS = (
    "words word_length upper_words symbols marks pipes distinct_words same_as_before repeated_bigrams repeated_5grams "
    "repeated_lines top_word digits sentence_ends words_a_line short_words letters_beyond_ascii"
).split()
_ALNUM = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123))
_SYMBOLS = b"#$%&*+<=>@\\^_`{}~"
_MARKS = b"!?"
_DIGITS = b"0123456789"
_HIGH = bytes(range(128, 256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _repeated(keys: np.ndarray) -> float:
    """Share of the keys that came before."""
    return 1 - len(np.unique(keys)) / len(keys) if len(keys) else 0.0


def statistics(text: bytes | None) -> list[float]:
    """STATISTICS of a text in UTF-8."""
    text = text or b""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    share = lambda these: (size - len(text.translate(None, these))) / size
    keys = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    with np.errstate(over="ignore"):
        pairs = keys[:-1] * _MIX + keys[1:]
        fives = keys[4:].copy()
        for i in range(4):
            fives = fives * _MIX + keys[i : n - 4 + i] if n > 4 else keys[:0]
    _, counts = np.unique(keys, return_counts=True)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        np.log1p(n),
        sum(map(len, words)) / n,
        sum(w.isupper() for w in words) / n,
        share(_SYMBOLS),
        share(_MARKS),
        share(b"|"),
        len(counts) / n,
        float((keys[1:] == keys[:-1]).mean()) if n > 1 else 0.0,
        _repeated(pairs),
        _repeated(fives),
        1 - len(set(lines)) / len(lines),
        counts.max() / n,
        share(_DIGITS),
        sum(w.endswith((b".", b"!", b"?")) for w in words) / n,
        np.log1p(n / len(lines)),
        sum(len(w) < 3 for w in words) / n,
        share(_HIGH),
    ]


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges of at most ``bins`` bins of about equal size."""
    levels = np.unique(values)
    if len(levels) <= bins:
        return (levels[1:] + levels[:-1]) / 2
    edges = np.unique(np.quantile(values, np.arange(1, bins) / bins, method="lower"))
    return edges[edges < levels[-1]] + 1e-12


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf value of each bin: the best splits first, up to ``leaves`` leaves."""
    parts, out = [(0, len(g))], np.zeros(len(g))
    gc, hc = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain_of = lambda a, b: (gc[b] - gc[a]) ** 2 / (hc[b] - hc[a] + SMOOTH)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a > 1:
                at = np.arange(a + 1, b)
                gains = gain_of(a, at) + gain_of(at, b) - gain_of(a, b)
                k = int(np.argmax(gains))
                best = max(best, (float(gains[k]), (a, b), int(at[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    for a, b in parts:
        out[a:b] = (gc[b] - gc[a]) / (hc[b] - hc[a] + SMOOTH)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best split of a pair's grid into four quarters."""
    gs, hs = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    gt, ht = gs[-1, -1], hs[-1, -1]
    best = (-1.0, np.zeros_like(g))
    for i in range(1, g.shape[0]):
        a, b = gs[i, 1:-1], hs[i, 1:-1]
        ga = np.stack([a, gs[i, -1] - a, gs[-1, 1:-1] - a, gt - gs[i, -1] - gs[-1, 1:-1] + a])
        ha = np.stack([b, hs[i, -1] - b, hs[-1, 1:-1] - b, ht - hs[i, -1] - hs[-1, 1:-1] + b])
        if not ga.shape[1]:
            continue
        gains = (ga**2 / (ha + SMOOTH)).sum(axis=0)
        j = int(np.argmax(gains))
        if gains[j] > best[0]:
            value, (v0, v1, v2, v3) = np.zeros_like(g), (ga / (ha + SMOOTH))[:, j]
            value[:i, : j + 1], value[:i, j + 1 :], value[i:, : j + 1], value[i:, j + 1 :] = v0, v1, v2, v3
            best = (float(gains[j]), value)
    return best


class Model:
    """Bin edges and tables: a few thousand numbers."""

    def __init__(self, base: float, cuts=(), tables=(), pairs=(), pair_cuts=(), pair_tables=()):
        self.base, self.cuts, self.tables = base, cuts, tables
        self.pairs, self.pair_cuts, self.pair_tables = pairs, pair_cuts, pair_tables

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            z += table[np.searchsorted(cuts, x[:, f], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            z += table[tuple(np.searchsorted(self.pair_cuts[f], x[:, f], side="right") for f in (a, b))]
        return 0.5 * (1 + np.tanh(0.5 * z))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> Model:
    """Cyclic boosting of the tables over a (bounded) sample."""
    if not len(y):
        return Model(0.0)
    weight = weight / weight.mean()
    mean = float((weight * y).sum() / weight.sum())
    base = float(np.log((mean + 1e-6) / (1 - mean + 1e-6)))
    if y.min() == y.max():
        return Model(base)
    z = np.full(len(y), base)
    sigmoid = lambda z: 0.5 * (1 + np.tanh(0.5 * z))
    cuts = [_cuts(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    for _ in range(rounds):
        for f, table in enumerate(tables):
            p = sigmoid(z)
            g, h = (np.bincount(bins[f], v, len(table)) for v in (weight * (y - p), weight * p * (1 - p)))
            step = RATE * _tree(g, h, LEAVES)
            table += step
            z += step[bins[f]]
    pair_cuts = [_cuts(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(pair_cuts)]

    def grids(a: int, b: int):
        p, shape = sigmoid(z), (len(pair_cuts[a]) + 1, len(pair_cuts[b]) + 1)
        cell = coarse[a] * shape[1] + coarse[b]
        return (np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (weight * (y - p), weight * p * (1 - p)))

    able = [f for f, c in enumerate(pair_cuts) if len(c)]
    gains = sorted(((-_quarters(*grids(a, b))[0], a, b) for a, b in combinations(able, 2)))
    chosen = [(a, b) for _, a, b in gains[:pairs]]
    pair_tables = [np.zeros((len(pair_cuts[a]) + 1, len(pair_cuts[b]) + 1)) for a, b in chosen]
    for _ in range(rounds // 4):
        for (a, b), table in zip(chosen, pair_tables, strict=True):
            step = RATE * _quarters(*grids(a, b))[1]
            table += step
            z += step[coarse[a], coarse[b]]
    return Model(base, cuts, tables, chosen, pair_cuts, pair_tables)


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"x": [statistics(t) for t in batch["text"]], "label": batch["label"], "weight": batch["weight"]})


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Model fitted on a bounded sample of ``labels`` (doc_id and a 0/1 column), held-out fold left out."""
    chosen = staged(sampled_labels(labels, label, remainder(4) != HELD_OUT, sample), "sample")
    rows = with_labels(docs.withColumn("text", F.col("text").cast("binary")), chosen, "text")
    # about ``sample`` rows of each class, each a few numbers
    data = rows.select("text", "label", "weight").mapInPandas(_measure, "x array<double>, label int, weight double").toPandas()
    x = np.array(data["x"].tolist(), float).reshape(-1, len(STATISTICS))
    y, weight = data["label"].to_numpy(float), data["weight"].to_numpy(float)
    order = np.lexsort((*x.T, weight, y))  # reruns read rows in any order
    return fit(x[order], y[order], weight[order])


def _score(model: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column("text")], float).reshape(-1, len(STATISTICS))
            score = model.score(x)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= ACCEPT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    return task


def quality(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted."""
    texts = docs.select(F.col("doc_id").cast("long"), (remainder(4) == HELD_OUT).alias("held_out"), F.col("text").cast("binary"))
    return texts.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")
