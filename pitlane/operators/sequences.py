"""Chunks as fixed-length training sequences: one row per chunk with ordered, padded arrays."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.functions.roles import CHUNK_SIZE, ORDER_KEY, SERIES_KEYS


def _named(c: str):
    return F.col("`" + c.replace("`", "``") + "`")


def chunk_sequences(
    chunked: DataFrame,
    features: Iterable[str],
    size: int = CHUNK_SIZE,
    keys: Iterable[str] = (*SERIES_KEYS, "chunk_id"),
    order: Iterable[str] = ("row_num", ORDER_KEY),
    pad: float | None = None,
) -> DataFrame:
    """One row per chunk: the keys, ``length``, ``mask`` and one ``array<double>`` of ``size`` values per feature.

    Values stand in the order of ``order``; behind the chunk's last row they are ``pad`` and ``mask`` is
    false.  A null value inside the chunk stays null.  A chunk's rows (at most ``size``; more are an error) meet once, in
    the exchange by its key, and the rows that come out lie as that exchange dealt them: writing them needs no other.
    """
    keys, features = list(keys), list(features)
    order = [c for c in order if c in chunked.columns]
    ranks = [_named(c).alias(f"o{i}") for i, c in enumerate(order)]
    values = [_named(c).cast("double").alias(f"v{i}") for i, c in enumerate(features)]
    rows = chunked.groupBy(*map(_named, keys)).agg(F.sort_array(F.collect_list(F.struct(*ranks, *values))).alias("_rows"))
    n, rest = F.size("_rows"), F.lit(size) - F.size("_rows")
    too_long = F.raise_error(F.concat(F.lit(f"a chunk has more than {size} rows: "), n.cast("string"))).cast("int")
    rest = F.when(rest < 0, too_long).otherwise(rest)

    def padded(i: int):
        return F.concat(F.transform("_rows", lambda r: r[f"v{i}"]), F.array_repeat(F.lit(pad).cast("double"), rest))

    return rows.select(
        *map(_named, keys),
        n.alias("length"),
        F.concat(F.array_repeat(F.lit(True), n), F.array_repeat(F.lit(False), rest)).alias("mask"),
        *[padded(i).alias(c) for i, c in enumerate(features)],
    )


def sequence_rows(sequences: DataFrame, features: Iterable[str], keys: Iterable[str] = (*SERIES_KEYS, "chunk_id")) -> DataFrame:
    """Sequences taken apart again: one row per place, ``position`` from 0, ``real`` false for padding."""
    features = list(features)
    places = F.arrays_zip(_named("mask").alias("real"), *map(_named, features))
    return sequences.select(*map(_named, keys), F.posexplode(places).alias("position", "_at")).select(
        *map(_named, keys), "position", F.col("_at.real").alias("real"), *[F.col("_at")[c].alias(c) for c in features]
    )
