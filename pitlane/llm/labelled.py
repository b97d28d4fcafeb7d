"""Bounded samples of labelled documents, from which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 30


def remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``: the folds of the classifiers; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus, F.lit(0))


def sampled_labels(labels: DataFrame, label: str, train: Column, most: int) -> DataFrame:
    """(doc_id, label, weight): about ``most`` labelled rows of each class at most, chosen by hash of doc_id.

    ``weight`` is the number of labelled rows a sampled row stands for.  Rows
    without id or label are left out; of repeated ids the larger label counts.
    """
    known = labels.where(train & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"))  # one row per class
    kept = F.least(F.lit(1.0), F.lit(float(most)) / F.col("n"))
    sample = known.join(F.broadcast(sizes), "label").withColumn("weight", 1 / kept)
    return sample.where(F.pmod(F.xxhash64("doc_id"), F.lit(_STEPS)) < kept * _STEPS).select("doc_id", "label", "weight")


def with_labels(docs: DataFrame, sample: DataFrame, *columns: str) -> DataFrame:
    """The sampled documents; ``sample`` is bounded by its documented size, so it is broadcast."""
    return docs.select("doc_id", *columns).join(F.broadcast(sample), "doc_id")
