"""Mixing sources to target weights by entropy balancing.

Every document gets a rate (how often its words are taken); rates stay as close as
possible, in relative entropy over words, to 1 while each source's words meet
its target and no rate exceeds ``REPEAT``.  The convex dual has one multiplier per
source and the solution is the exponentially tilted rate min(REPEAT, exp(lambda * x)),
x being the document's size over its source's mean size to the power ``tilt`` (0: one
rate for a whole source; larger: long documents give way, or gain, more).  Newton steps for all
sources run as Spark aggregates over the histogram (source, size, documents), which
is all the dual depends on: a hot source is pre-aggregated to one row per
distinct size.  Sums are in fixed point, so reruns agree bit for bit.

Rates become whole copies by error diffusion from the longest to the shortest
documents of a source, so what a source takes ends within half of its shortest
documents of the target where rates allow it; the copies of a (source, size) class
go to its documents in hash order, in cells of bounded size.

Defined cases: null text has size 0; a null source is a source, ordered last;
documents of size 0 take 0; a table without words has targets 0; repeated rows
are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitlane.llm.common import WORD, row_hash, staged, take_rows

WEIGHTS = (5, 2, 1)
VOLUME = 1.5  # words of the mix over words of the corpus
REPEAT = 2  # most copies of a document, and most words of a source over its size
TILT = 0.25
TOLERANCE = 1e-6  # of a target; sums are rounded to a millionth of a word per cell
MAX_STEPS = 60
CELL = 128  # documents of a class ranked together
_UNIT = 1_000_000  # fixed point of the sums


def size() -> Column:
    """Words of a text, split at ASCII white space."""
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, volume: float = VOLUME, repeat: float = REPEAT) -> DataFrame:
    """Adds weight and target to one row per source (source, source_size).

    Resharing the excess of capped sources until none is above its cap ends at
    min(cap, level * weight); the level follows from sums over the sources ordered
    by cap over weight.  One row per source is all that meets in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # Spark compares UTF-8 bytes: code point order
    ranked = sources.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ).withColumn("_cap", F.col("source_size") * float(repeat))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * float(volume) - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))) / F.sum("weight").over(onward)
    leveled = ranked.withColumn("_level", level)
    # the level of the first source (by cap over weight) that stays below its cap holds for all, and
    # is the largest such level, as later ones count sources as capped that are not; none: all are capped
    below = F.when(F.col("_level") <= F.col("_cap") / F.col("weight"), F.col("_level"))
    leveled = leveled.withColumn("_level", F.max(below).over(everything))
    return leveled.withColumn("target", F.least("_cap", F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap")))).drop("_cap", "_level")


def _fixed(value: Column) -> Column:
    return F.sum(F.round(value * _UNIT).cast("decimal(38,0)")).cast("double") / _UNIT


def _tilted(repeat: float) -> Column:
    """exp(lambda * x) below the cap; a full multiplier means the cap."""
    return F.when(F.col("full"), F.lit(float(repeat))).otherwise(F.least(F.lit(float(repeat)), F.exp(F.col("multiplier") * F.col("x"))))


def balance(histogram: DataFrame, sources: DataFrame, repeat: float = REPEAT, tilt: float = TILT) -> DataFrame:
    """(source, multiplier, full) solving the dual by safeguarded Newton steps.

    ``histogram``: source, size, n; ``sources``: source, source_size, target, docs.
    A source whose target is its cap has no finite multiplier: ``full``.
    """
    mean = F.try_divide("source_size", "docs")
    state = sources.select(
        "source", "target", mean.alias("mean"), (F.col("target") >= repeat * F.col("source_size") * (1 - 1e-12)).alias("full"),
        F.coalesce(F.ln(F.try_divide("target", "source_size")), F.lit(0.0)).alias("multiplier"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), F.lit(1.0).alias("gap"),
    )
    state = staged(state, "state")
    for _ in range(MAX_STEPS):
        x = F.pow(F.col("size") / F.greatest("mean", F.lit(1.0)), F.lit(float(tilt)))
        cells = histogram.where("size > 0").join(state.where("not full").withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        cells = cells.withColumn("x", x).withColumn("rate", _tilted(repeat)).withColumn("words", F.col("n") * F.col("size"))
        sums = cells.groupBy("source").agg(
            _fixed(F.col("words") * F.col("rate")).alias("taken"),
            _fixed(F.when(F.col("rate") < repeat, F.col("words") * F.col("rate") * F.col("x")).otherwise(F.lit(0.0))).alias("slope"),
        )
        old = state.withColumnRenamed("source", "_s")
        joined = old.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left")
        off = F.coalesce(F.col("taken") - F.col("target"), F.lit(0.0))
        low = F.when(off < 0, F.greatest("low", "multiplier")).otherwise(F.col("low"))
        high = F.when(off > 0, F.least("high", "multiplier")).otherwise(F.col("high"))
        joined = joined.withColumn("low", low).withColumn("high", high).withColumn("off", off)
        newton = F.when(F.col("slope") > 0, F.col("multiplier") - F.col("off") / F.col("slope"))
        halved = F.when(F.col("low") == float("-inf"), F.col("high") - 1).when(F.col("high") == float("inf"), F.col("low") + 1).otherwise((F.col("low") + F.col("high")) / 2)
        gap = F.abs("off") / F.greatest("target", F.lit(1.0))
        step = F.when(F.col("off") == 0, F.col("multiplier")).when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise(halved)
        state = staged(joined.select(F.col("_s").alias("source"), "target", "mean", "full", step.alias("multiplier"), "low", "high", gap.alias("gap")), "state")
        gap = state.where("not full").agg(F.max("gap")).first()[0] or 0.0
        if gap <= TOLERANCE:
            return state.select("source", "multiplier", "full", "mean")
    raise RuntimeError(f"a source is {gap:.2g} of its target away after {MAX_STEPS} steps")


def _diffuse(repeat: int):
    """Copies of each (source, size) class of one source, longest first, errors carried on.

    One row per distinct size of the source, so at most as many as its longest
    document has words, however many documents there are.
    """

    def task(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending")])
        owed, copies = 0.0, []
        for words, n, rate in zip(*(group.column(c).to_pylist() for c in ("size", "n", "rate")), strict=True):
            owed += words * n * rate
            m = min(n * repeat, max(0, math.floor(owed / words + 0.5))) if words else 0
            owed -= m * words
            copies.append(m)
        return group.select(["source", "size", "n"]).append_column("copies", pa.array(copies, pa.int64()))

    return task


def copies(docs: DataFrame, weights: tuple = WEIGHTS, volume: float = VOLUME, repeat: int = REPEAT, tilt: float = TILT) -> DataFrame:
    """One row per document: doc_id, _hash, source, size, source_size, target, copies."""
    rows = staged(docs.select("doc_id", "source", size().alias("size"), row_hash(docs).alias("_hash")), "sizes")
    histogram = staged(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    sources = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    sources = staged(targets(sources, weights, volume, repeat), "sources")
    solved = balance(histogram, sources, repeat, tilt)
    rated = histogram.join(solved.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    rated = rated.withColumn("x", F.pow(F.col("size") / F.greatest("mean", F.lit(1.0)), F.lit(float(tilt)))).withColumn("rate", _tilted(repeat))
    whole = rated.select("source", "size", "n", "rate").groupBy("source").applyInArrow(_diffuse(repeat), "source string, size long, n long, copies long")
    plan = whole.join(sources.select(F.col("source").alias("_s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_s")))
    plan = staged(plan.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "n", "copies", "source_size", "target"), "plan")
    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).drop("_s", "_z")
    # a class's extra copies go to its documents in hash order, in cells of about CELL documents;
    # a cell's share is rounded with an offset that spreads evenly over the cells
    cells = F.ceil(F.col("n") / CELL)
    planned = planned.withColumn("cell", F.pmod(F.xxhash64("doc_id", "_hash"), cells)).withColumn("extra", F.col("copies") % F.col("n"))
    cell = Window.partitionBy("source", "size", "cell")
    spread = (F.col("cell") * F.lit(0.6180339887498949)) % 1
    share = F.floor(F.col("extra") * F.count(F.lit(1)).over(cell) / F.col("n") + F.when(cells == 1, F.lit(0.5)).otherwise(spread))
    ranked = planned.withColumn("_share", share).withColumn("_rank", F.row_number().over(cell.orderBy("_hash", "doc_id")))
    got = F.floor(F.col("copies") / F.col("n")) + F.when(F.col("_rank") <= F.col("_share"), 1).otherwise(0)
    return ranked.select("doc_id", "_hash", "source", "size", "source_size", "target", got.cast("long").alias("copies"))


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (its words in the mix, repeats counted)."""
    return copies(docs, **parameters).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with every row as often as the mix takes it."""
    decided = copies(docs, **parameters).groupBy(F.col("doc_id").alias("_id"), "_hash").agg(F.sum("copies").alias("_copies"))
    return take_rows(docs, staged(decided, "copies"))
