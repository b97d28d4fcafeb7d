"""What each of five quality filters removes, in every order in which they can be applied.

A document's failures are a mask of five bits, so an audit needs only how many
documents of a part have which mask.  A filter order is a permutation; its place
among the 120 in lexicographic order (its Lehmer code) is its rank.  A document with a mask is
removed at step s by the first filter of the order that it fails: the orders that begin with
s-1 filters it passes and then that filter are one interval of ranks.  The audit adds the
mask's counts at the interval's first rank, takes them away behind its last, and a
running sum over the ranks gives the removals of every order at once.

Filters, over whole texts with ``[^\\x20\\x09-\\x0D]+`` as words: A under 50 words; B distinct
words under 65 %; C capitals A-Z over 5 % of the code points; D holds one of ``#$%&*|``; E the same text as
a row with a smaller doc_id.

E needs the smallest doc_id of every text: one aggregate with partial sums by digest.  Digests
with SHARE of the rows or more (at most 1 / SHARE of them) come back as a broadcast, the others by a
join in which no key is that frequent; texts that occur once are not joined at all.

Defined cases: null text counts as empty, null source as the empty string; a null doc_id is
neither smaller nor larger than any and has no label; repeated rows with one doc_id count each,
and none of them is a duplicate of another; if a doc_id is labelled several times, one label 1 is
enough; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import WORD, staged

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]  # in lexicographic order: the rank is the index
MASKS = 1 << len(FILTERS)
SHARE = 1 / 1024  # a text with this share of the rows is frequent
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COUNTS = ("n", "good", "toxic")


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def rank(prefix: str) -> int:
    """Rank of the first order that begins with ``prefix``: its Lehmer digits times factorials."""
    left, out = FILTERS, 0
    for letter in prefix:
        out = (out + left.index(letter)) * max(len(left) - 1, 1)
        left = left.replace(letter, "")
    for k in range(1, len(left)):
        out *= k
    return out


def intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step from 0, first rank, rank behind the last) of every removal."""
    out = []
    for length in range(1, len(FILTERS) + 1):
        for prefix in permutations(FILTERS, length):
            first = rank("".join(prefix))
            width = int(np.prod(range(1, len(FILTERS) - length + 1), dtype=int))
            passed = sum(map(bit, prefix[:-1]))
            out += [(m, length - 1, first, first + width) for m in range(MASKS) if m & bit(prefix[-1]) and not m & passed]
    return out


def removals(counts: np.ndarray) -> np.ndarray:
    """From (parts, masks) to (parts, steps, ranks): documents removed there."""
    ends = np.zeros((len(counts), len(FILTERS), len(ORDERS) + 1), np.int64)
    for mask, step, first, last in intervals():
        ends[:, step, first] += counts[:, mask]
        ends[:, step, last] -= counts[:, mask]
    return ends.cumsum(axis=2)[:, :, :-1]


def totals(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """From (parts, masks) counts of documents, good and toxic ones to (parts, ranks, steps) totals."""
    removed, good, toxic = (removals(counts[k]).swapaxes(1, 2) for k in _COUNTS)
    n = counts["n"]
    letter = np.array([[FILTERS.index(c) for c in order] for order in ORDERS])
    failing = np.stack([n[:, [m for m in range(MASKS) if m >> f & 1]].sum(axis=1) for f in range(len(FILTERS))], axis=1)
    alone = n[:, [1 << f for f in range(len(FILTERS))]]
    shapley = np.stack([removed[:, letter == f].sum(axis=1) for f in range(len(FILTERS))], axis=1)
    return {
        "kept": n.sum(axis=1)[:, None, None] - removed.cumsum(axis=2),
        "removed": removed,
        "redundant": failing[:, letter] - removed,
        "unique_fails": alone[:, letter],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": shapley[:, letter],
    }


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: one row per part (counts by mask) in, one row per part, order and step out."""
    steps = len(FILTERS)
    for batch in batches:
        for start in range(0, len(batch), 256):
            rows = batch.slice(start, 256)
            counts = {k: np.array(rows.column(k).to_pylist(), np.int64).reshape(len(rows), MASKS) for k in _COUNTS}
            shape = (len(rows), len(ORDERS), steps)
            part = rows.column("part").take(pa.array(np.repeat(np.arange(len(rows)), len(ORDERS) * steps)))
            order = pa.array(ORDERS).take(pa.array(np.broadcast_to(np.arange(len(ORDERS))[None, :, None], shape).ravel()))
            step = pa.array(np.broadcast_to(np.arange(1, steps + 1, dtype=np.int32), shape).ravel())
            columns = {"part": part, "filter_order": order, "step": step} | {k: pa.array(v.ravel()) for k, v in totals(counts).items()}
            yield pa.RecordBatch.from_pydict(columns)


SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def text_mask(text: Column) -> Column:
    """Bits of the filters that look at the text alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    rules = {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * (F.length(text) - F.length(F.translate(text, _CAPITALS, ""))) > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }
    return sum((F.when(rule, bit(k)).otherwise(0) for k, rule in rules.items()), F.lit(0))


def masks(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per document: doc_id, part, mask."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = staged(
        docs.select(
            F.col("doc_id").cast("long"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
            text_mask(text).alias("mask"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "masks",
    )
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("smallest"), F.count(F.lit(1)).alias("rows"))
    texts = staged(texts.where("rows > 1"), "texts")
    many = F.col("rows") >= F.lit(rows.count() * share)
    heavy = F.broadcast(texts.where(many))  # at most 1 / share rows
    light = texts.where(~many).select("digest", F.col("smallest").alias("least"))
    rows = rows.join(heavy, "digest", "left")
    known = rows.where(F.col("rows").isNotNull()).select("doc_id", "part", "mask", "smallest")
    rest = rows.where(F.col("rows").isNull()).select("doc_id", "part", "mask", "digest").join(light, "digest", "left")
    every = known.unionByName(rest.select("doc_id", "part", "mask", F.col("least").alias("smallest")))
    again = F.coalesce(F.col("doc_id") > F.col("smallest"), F.lit(False))
    return every.select("doc_id", "part", (F.col("mask") + F.when(again, bit("E")).otherwise(0)).alias("mask"))


def mask_counts(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones by part and mask.

    Rows are counted by part and mask before the labels come in; only rows with a
    label 1 meet that table.
    """
    one = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    one = one.where("doc_id is not null and (good = 1 or toxic = 1)")
    by = ["part", "mask"]
    zero = F.lit(0).cast("long")
    every = masked.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).select(*by, "n", zero.alias("good"), zero.alias("toxic"))
    marked = masked.where("doc_id is not null").join(one, "doc_id").groupBy(*by).agg(F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return every.unionByName(marked.select(*by, zero.alias("n"), "good", "toxic")).groupBy(*by).agg(*[F.sum(c).alias(c) for c in _COUNTS])


def filter_audit(docs: DataFrame, labels: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per part, filter order and step with the documents kept, removed and so on."""
    counts = mask_counts(staged(masks(docs, share), "masked"), labels)
    wide = [F.array(*[F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)) for m in range(MASKS)]).alias(c) for c in _COUNTS]
    return counts.groupBy("part").agg(*wide).mapInArrow(_emit, SCHEMA)


SQL = """
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {
      'A': len(words) < 50,
      'B': 100 * len(list_distinct(words)) < 65 * len(words),
      'C': 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
      'D': regexp_matches(text, '[#$%&*|]'),
      'E': coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)
    } AS fails
  FROM t LEFT JOIN l ON t.doc_id = l.doc_id
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), g AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, fails
), failed AS (
  SELECT part, n, good, toxic,
         (CASE WHEN fails.A THEN 'A' ELSE '' END) || (CASE WHEN fails.B THEN 'B' ELSE '' END) || (CASE WHEN fails.C THEN 'C' ELSE '' END)
         || (CASE WHEN fails.D THEN 'D' ELSE '' END) || (CASE WHEN fails.E THEN 'E' ELSE '' END) AS failed
  FROM g
), s AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS f,
         n, good, toxic, failed,
         contains(failed, filter_order[step]) AS here,
         regexp_matches(filter_order[1:step - 1], CASE WHEN failed = '' THEN '-' ELSE '[' || failed || ']' END) AS before
  FROM failed, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), totals AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT before AND NOT here THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT before AND here THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN before AND here THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT before AND here THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT before AND here THEN toxic ELSE 0 END) AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM totals
"""
