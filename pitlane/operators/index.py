"""Gapless numbers over a global order, without a window over all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.session import staging_path

_LOCAL_BITS = 33  # of ``monotonically_increasing_id``: the row's place in its partition


def global_index(df: DataFrame, *order: Column | str, name: str = "row_index") -> DataFrame:
    """``df`` with ``name``, the row's place from 1 in the order of ``order``.

    Two passes: rows are dealt by ranges of the order, sorted and numbered within their
    partition, and written to the shared folder (which fixes the ranges, and which a lost executor does not take
    along); then every partition's number of rows, one number each, gives the base
    that is added to its rows.  Rows that agree in ``order`` are numbered in any order; of such
    rows many go to one task, so add columns that tell them apart when a value is frequent.
    """
    spark, tag = df.sparkSession, "_pl_place"
    path = staging_path(spark, "index")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(tag, F.monotonically_increasing_id())
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    part = F.shiftright(F.col(tag), _LOCAL_BITS)
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy(part.alias("part")).count().collect())  # one row per partition
    bases = [0, *accumulate(n for _, n in sizes)]
    known = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, bases)], "_pl_part bigint, _pl_base bigint")
    local = F.col(tag).bitwiseAND((1 << _LOCAL_BITS) - 1)
    rows = placed.withColumn("_pl_part", part).join(F.broadcast(known), "_pl_part")
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c != name]
    return rows.select(*kept, (F.col("_pl_base") + local + 1).alias(name))
