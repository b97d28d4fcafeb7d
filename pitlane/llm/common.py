"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType
from pyspark.sql.window import Window

from pitlane.session import remove_path, staging_path

# words and white space as the operators' contracts define them (ASCII white space only)
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, whose Python may not have it on its path.

    Once a session, what ``--py-files`` does: Spark serves the driver's zip to every executor.
    """
    sc, package = spark.sparkContext, Path(__file__).parent.parent
    if getattr(sc, "_pitlane_shipped", False) or not package.is_dir():  # the package is in a shipped zip itself
        return
    path = Path(tempfile.mkdtemp(prefix="pitlane-ship-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    sc._pitlane_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a re-run, and values
    that only hold within one run (generated row tags) become fixed.  The
    shuffle files of the finished write are released at once.
    """
    spark = df.sparkSession
    ship(spark)
    path = staging_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def unstage(spent: DataFrame) -> None:
    """Delete a table that ``staged`` returned and nothing will read again."""
    for path in {f.rsplit("/", 1)[0] for f in spent.inputFiles()}:
        remove_path(spent.sparkSession, path)


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of every column of a row; rows that agree on ``doc_id`` and this count as identical."""
    columns = [(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType) for f in df.schema.fields]
    # maps have no hash of their own
    return F.xxhash64(*[F.array_sort(F.map_entries(c)) if isinstance(t, MapType) else c for c, t in columns])


def take_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as ``decisions`` says, with the columns of ``docs``.

    ``decisions`` has ``_id``, ``_hash`` (``doc_id`` and ``row_hash`` of a
    row) and ``_copies``, unique by the first two.  Of identical rows the first
    stands for all.  Both sides meet once on (``_id``, ``_hash``), and the window
    that numbers identical rows reuses that distribution.
    """
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    keyed = docs.select(*columns, F.coalesce(F.col("doc_id"), F.lit(-1)).alias("_id"), row_hash(docs).alias("_hash"))
    wanted = decisions.where("_copies > 0").select(F.coalesce(F.col("_id"), F.lit(-1)).alias("_id"), "_hash", "_copies")
    same = Window.partitionBy("_id", "_hash").orderBy("_hash")
    return (
        keyed.join(wanted, ["_id", "_hash"])
        .withColumn("_row", F.row_number().over(same))
        .where("_row = 1")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .select(*columns)
    )
