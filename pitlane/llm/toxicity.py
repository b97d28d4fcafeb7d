"""Toxicity by cumulative-link ordinal regression on sparse text features.

A text's features are its distinct words and word beginnings.  The model gives
the odds of reaching each grade as P(grade >= k) = sigmoid(w . x - theta_k) with one
weight vector for all grades and ordered thresholds; the expected severity is
the sum of these probabilities, and a document is rejected when reaching grade 1
is likelier than not.

Labels may hold any grades 0..K.  Binary labels are graded by how many different
telling words a labelled text has (terciles give grades 1 to 3).  The model is
fitted on a bounded sample: about ``SAMPLE`` labelled rows of each class,
weighted to the class sizes; features are chosen among all of the sample's.
Training leaves out fold ``HELD_OUT`` of crc32(doc_id) mod 4.

Defined cases: null and empty texts have no features and take the base rate;
whole texts are scored whatever their length; without labelled rows nothing is
rejected and severities are 0; null ids are scored like others; repeated rows
are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import staged
from pitlane.llm.labelled import remainder, sampled_labels, with_labels

SAMPLE = 12_000  # labelled rows of each class the model is fitted on, at most
FEATURES = 4096  # features of the model, at most
SUPPORT = 4  # labelled toxic texts a feature occurs in, at least
CHI2 = 24.0  # least evidence of a feature
PREFIXES = (4, 5, 6, 7)
HELD_OUT = 2
RIDGE = 2e-6  # on the mean loss
STEPS = 2000
_TOKENS = 1 << 17  # tokens whose features a task remembers
_LETTERS = re.compile(r"[^\W\d_]+")
_EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[]^_|"


def _features(token: str) -> tuple[int, ...]:
    """Keys of a token's words and their beginnings."""
    keys = []
    for word in _LETTERS.findall(token.lower()):
        keys.append(xxhash.xxh64_intdigest("w" + word) >> 1)
        keys += [xxhash.xxh64_intdigest(f"{n}{word[:n]}") >> 1 for n in PREFIXES if len(word) >= n]
    return tuple(keys)


class _Cache(dict):
    """Token -> the model's indices of its features."""

    def __init__(self, index: dict[int, int] | None = None):
        self.index = index

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= _TOKENS:
            self.clear()
        keys = _features(token)
        found = keys if self.index is None else tuple(self.index[k] for k in keys if k in self.index)
        self[token] = found
        return found


def _present(text: str | None, cache: _Cache) -> set[int]:
    out: set[int] = set()
    for token in set((text or "").split()):
        if found := cache[token]:
            out.update(found)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each feature, by whether the text is toxic; summed up per task."""
    cache, counts = _Cache(), (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
            counts[label > 0].update(_present(text.as_py(), cache))
    for toxic, found in enumerate(counts):
        keys, n = np.array(list(found), np.int64), np.array(list(found.values()), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n * (toxic == 0)), pa.array(n * (toxic == 1))], ["key", "clean", "toxic"])


def choose_features(sample: DataFrame, most: int = FEATURES) -> list[tuple[int, float]]:
    """(key, lift) of the features that speak for toxicity, strongest first; at most ``most``."""
    sizes = {r["t"]: r["n"] for r in sample.groupBy((F.col("label") > 0).alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return []
    n0, n1 = sizes[False], sizes[True]
    counts = sample.select("text", "label").mapInArrow(_count, "key long, clean long, toxic long")
    counts = counts.groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= SUPPORT)
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    chi2 = (n0 + n1) * F.pow(a * (n0 - b) - b * (n1 - a), F.lit(2)) / ((a + b) * (n0 + n1 - a - b + 1e-9) * n0 * n1)
    lift = F.ln((a + 0.5) / (n1 + 1)) - F.ln((b + 0.5) / (n0 + 1))
    strong = counts.select("key", lift.alias("lift"), chi2.alias("chi2")).where((F.col("lift") > 1) & (F.col("chi2") >= CHI2))
    return [(r["key"], r["lift"]) for r in strong.orderBy(F.desc("chi2"), "key").limit(most).collect()]  # bounded by the model's size


def fit(rows: list[list[int]], grades: np.ndarray, weights: np.ndarray, features: int, ridge: float = RIDGE, steps: int = STEPS):
    """(w, theta) of the cumulative-link model, by Adam on the whole (bounded) sample."""
    top = int(grades.max()) if len(grades) else 0
    if not top:
        return np.zeros(features), np.array([np.inf])
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.array([f for r in rows for f in r], np.int64)
    weights = weights / weights.sum()
    reach = np.array([weights[grades >= k].sum() for k in range(1, top + 1)]).clip(1e-6, 1 - 1e-6)
    theta0 = np.log(1 / reach - 1)
    gaps = np.log(np.maximum(np.diff(theta0), 1e-2))
    p = np.concatenate([np.zeros(features), theta0[:1], gaps])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda z: 0.5 * (1 + np.tanh(0.5 * z))
    for step in range(1, steps + 1):
        w, theta = p[:features], np.cumsum(np.concatenate([p[features : features + 1], np.exp(p[features + 1 :])]))
        score = np.bincount(of, w[feature], len(rows)) if len(feature) else np.zeros(len(rows))
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        above, below = sigmoid(score - edges[grades]), sigmoid(score - edges[grades + 1])
        chance = np.maximum(above - below, 1e-12)
        slope_above, slope_below = above * (1 - above), below * (1 - below)
        toward = -weights * (slope_above - slope_below) / chance
        g = np.zeros_like(p)
        g[:features] = np.bincount(feature, toward[of], features) + ridge * w if len(feature) else 0
        g_theta = np.bincount(grades, weights * slope_above / chance, top + 2)[1 : top + 1] - np.bincount(grades + 1, weights * slope_below / chance, top + 2)[1 : top + 1]
        g[features] = g_theta.sum()
        later = np.cumsum(g_theta[::-1])[::-1]
        g[features + 1 :] = later[1:] * np.exp(p[features + 1 :])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.1 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-12)
    return p[:features], np.cumsum(np.concatenate([p[features : features + 1], np.exp(p[features + 1 :])]))


def _encode(index: dict[int, int], telling: set[int]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Cache(index)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            found = [sorted(_present(t, cache)) for t in texts]
            words = [len({w.lower().strip(_EDGES) for w in set(t.split()) if not telling.isdisjoint(cache[w])}) for t in texts]
            columns = [pa.array(found, pa.list_(pa.int32())), pa.array(words, pa.int32()), batch.column("label"), batch.column("weight")]
            yield pa.RecordBatch.from_arrays(columns, ["features", "telling", "label", "weight"])

    return task


class Model:
    """Feature index, weights and thresholds; a few thousand numbers."""

    def __init__(self, index: dict[int, int], weights: np.ndarray, theta: np.ndarray):
        self.index, self.weights, self.theta = index, weights, theta

    def reach(self, text: str | None, cache: _Cache) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        score = sum(self.weights[i] for i in sorted(_present(text, cache)))
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.theta - score))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Model fitted on a bounded sample of ``labels`` (doc_id and the grade column), held-out fold left out."""
    chosen = staged(sampled_labels(labels, label, remainder(4) != HELD_OUT, sample), "sample")
    rows = staged(with_labels(docs, chosen, "text"), "labelled")
    features = choose_features(rows)
    index = {k: i for i, (k, _) in enumerate(features)}
    telling = {i for i, (_, lift) in enumerate(features) if lift > 2}
    # about ``sample`` rows of each class, each a short list of feature numbers
    encoded = rows.select("text", "label", "weight").mapInArrow(_encode(index, telling), "features array<int>, telling int, label int, weight double")
    data = sorted((r["label"], r["telling"], r["weight"], tuple(r["features"])) for r in encoded.collect())
    grades, many, given = (np.array([r[i] for r in data], k) for i, k in enumerate((np.int64, np.int64, float)))
    if len(grades) and grades.max() == 1:
        cuts = np.quantile(many[grades == 1], [1 / 3, 2 / 3])
        grades = np.where(grades == 1, 1 + (many > cuts[0]) + (many > cuts[1]), 0)
        _, grades = np.unique(grades, return_inverse=True)  # equal cuts leave a grade empty
    weights, theta = fit([r[3] for r in data], grades, given, len(index))
    return Model(index, weights, theta)


def _score(model: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Cache(model.index)
        for batch in batches:
            reach = np.array([model.reach(t.as_py(), cache) for t in batch.column("text")]).reshape(batch.num_rows, -1)
            scored = [pa.array(reach.sum(axis=1)), pa.array(reach[:, 0]), pa.array((reach >= 0.5).sum(axis=1).astype(np.int32)), pa.array(reach[:, 0] >= 0.5)]
            others = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), *scored], [*others, "severity", "p_toxic", "grade", "rejected"])

    return task


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, severity (expected grade), p_toxic, grade, rejected."""
    texts = docs.select(F.col("doc_id").cast("long"), (remainder(4) == HELD_OUT).alias("held_out"), F.col("text").cast("string"))
    return texts.mapInArrow(_score(model), "doc_id long, held_out boolean, severity double, p_toxic double, grade int, rejected boolean")


def _accept(model: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Cache(model.index)
        for batch in batches:
            clean = [bool(model.reach(t.as_py(), cache)[0] < 0.5) for t in batch.column("text")]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return task


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rejected rows, all columns kept."""
    return docs.mapInArrow(_accept(model), docs.schema)
