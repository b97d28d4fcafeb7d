"""Exact de-duplication with a heavy-hitter split.

Digests that make up a large share of all rows are found with Misra-Gries
summaries (one pass, fixed memory per task, mergeable), verified by exact counts, and
their winners are broadcast: rows of a frequent digest are decided where they
are read, without a shuffle.  The remaining digests, each below ``share`` of
the rows, go through an ordinary shuffle.

Defined cases: a null text counts as empty; of rows with equal text the
smallest ``doc_id`` stays (null ids last), and of repeated rows with that id
exactly one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitlane.llm.common import SPACE, staged

COUNTERS = 1023  # Misra-Gries counters per task: undercounts by at most rows / 1024
SHARE = 1 / 256  # a digest with this share of all rows is frequent

# frequent digests are at most 1 / (SHARE - 1 / (COUNTERS + 1)) = 342: the bound of every broadcast below


def normalised(text: Column | str = "text") -> Column:
    """Text with every run of ASCII white space replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), SPACE, " ")


def digest(text: Column | str = "text") -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def misra_gries(counters: int = COUNTERS):
    """Task function: digests in, at most ``counters`` (digest, undercount) pairs out."""

    def shrink(counts: Counter) -> Counter:
        if len(counts) <= counters:
            return counts
        cut = sorted(counts.values(), reverse=True)[counters]
        return Counter({k: v - cut for k, v in counts.items() if v > cut})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts.update(batch.column(0).to_pylist())
            counts = shrink(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["digest", "seen"]
        )

    return task


def frequent_digests(digests: DataFrame, counters: int = COUNTERS, share: float = SHARE) -> DataFrame:
    """Every digest with at least ``share`` of the rows (none missed; a few below it may come along).

    The summaries undercount a digest by at most rows / (counters + 1) altogether, so
    the cut is that much below ``share``; undercounts sum to at most the row
    count, which bounds the result by 1 / (share - 1 / (counters + 1)) rows.
    """
    if share <= 1 / (counters + 1):
        raise ValueError("share must exceed 1 / (counters + 1)")
    least = digests.count() * (share - 1 / (counters + 1))
    return (
        digests.select("digest")
        .mapInArrow(misra_gries(counters), "digest binary, seen long")
        .groupBy("digest")
        .agg(F.sum("seen").alias("seen"))
        .where((F.col("seen") >= F.lit(least)) & (F.col("seen") > 1))
        .select("digest")
    )


def _best() -> list[Column]:
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag"))
    return [first.alias("first"), F.count(F.lit(1)).alias("group_size")]


def exact_dedup(docs: DataFrame, counters: int = COUNTERS, share: float = SHARE) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = staged(
        docs.select("doc_id", digest().alias("digest")).withColumn("tag", F.monotonically_increasing_id()), "digests"
    )
    frequent = frequent_digests(rows, counters, share)
    # exact counts and winners of the candidates: at most 342 rows, so the broadcasts are bounded
    winners = staged(rows.join(F.broadcast(frequent), "digest", "left_semi").groupBy("digest").agg(*_best()), "winners")
    heavy = rows.join(F.broadcast(winners), "digest")
    light = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    light = light.join(light.groupBy("digest").agg(*_best()), "digest")
    return heavy.unionByName(light).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("tag") == F.col("first.tag")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, counters: int = COUNTERS, share: float = SHARE) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, all columns kept.

    Rows of frequent digests other than the winner's go where they are read;
    the rest, no digest above ``share``, is ranked within its digest (Spark
    limits each task's rows to the first of a digest before the shuffle too).
    """
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    rows = docs.select(*columns, digest().alias("_digest"))
    digests = staged(docs.select("doc_id", digest().alias("digest")).withColumn("tag", F.lit(0)), "digests")
    frequent = frequent_digests(digests, counters, share)
    winners = staged(
        digests.join(F.broadcast(frequent), "digest", "left_semi").groupBy("digest").agg(*_best()), "winners"
    ).select(F.col("digest").alias("_digest"), F.col("first.doc_id").alias("_winner"))
    rows = rows.join(F.broadcast(winners), "_digest", "left").where(
        F.col("_winner").isNull() | (F.col("doc_id") == F.col("_winner"))
    )
    first = Window.partitionBy("_digest").orderBy(F.col("doc_id").asc_nulls_last())
    return rows.withColumn("_row", F.row_number().over(first)).where("_row = 1").select(*columns)


SQL = """
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) AS r
  FROM d
)
SELECT doc_id, keep_id, group_size, r = 1 AS kept, text_sha256 FROM g
"""
