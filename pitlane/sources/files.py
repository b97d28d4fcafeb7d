"""Per-race CSV files: telemetry, participants, sessions.

A dataset folder holds one file per race and kind, named like
``TelemetryData_<raceId>.csv``, ``ParticipantData_<raceId>.csv`` and
``SessionData_<raceId>.csv`` (a name may also be a Spark output folder with
part files inside).  All files of a kind are read by one scan per distinct
header and stacked by column name; the race id comes from the file path, so it
is a column of every row.

Fields are read as text and cast tolerantly to the declared types: ``7.0`` is
the integer 7, and a non-empty field that has no value of its type becomes
null and is counted (``rejected_fields``).

Only the file listing and the distinct header lines pass through the driver
(``headers="first"``: one name and one header); rows never do.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    FractionalType,
    IntegerType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from pitlane.functions.columns import race_id_from_name
from pitlane.functions.roles import COMPOUND, FORWARD_SCALARS, MEAN_SCALARS, ORDER_KEY, SERIES_KEYS
from pitlane.operators.union import union_all
from pitlane.sources.infer import infer_types

# --- fixed values: file kinds and the race-id pattern ------------------------
TELEMETRY = "Telemetry"
PARTICIPANTS = "ParticipantData"
SESSIONS = "SessionData"
RACE_ID_PATTERN = r"_(\d+)"
# ---------------------------------------------------------------------------

# Declared types of the telemetry columns; any other column stays a string
# unless the caller declares it.
TELEMETRY_TYPES: dict[str, DataType] = {
    SERIES_KEYS[1]: IntegerType(),
    ORDER_KEY: LongType(),
    **{c: IntegerType() for c in FORWARD_SCALARS if c != COMPOUND},
    **{c: DoubleType() for c in MEAN_SCALARS},
}
PARTICIPANT_TYPES: dict[str, DataType] = {SERIES_KEYS[1]: IntegerType()}
SESSION_TYPES: dict[str, DataType] = {}

_RACE_RE = re.compile(RACE_ID_PATTERN)


@dataclass(frozen=True)
class DataFile:
    path: str
    entry: str  # name of the entry directly below the root (file or folder)
    kind: str
    race_id: str


def _hadoop(spark: SparkSession):
    jvm = spark.sparkContext._jvm
    return jvm, spark.sparkContext._jsc.hadoopConfiguration()


def _hidden(name: str) -> bool:
    return name.startswith("_") or name.startswith(".")


def list_files(spark: SparkSession, root: str, kind: str, threads: int = 16) -> list[DataFile]:
    """Data files of one kind below ``root`` whose entry name carries a race id.

    An entry is a file or a folder directly below ``root`` whose name
    contains ``kind``; a folder contributes every visible file inside it
    (folders are listed concurrently).  Entries without ``_<digits>`` in the
    name are skipped.
    """
    return _list(spark, root, kind, threads)[0]


def _list(spark: SparkSession, root: str, kind: str, threads: int = 16) -> tuple[list[DataFile], int]:
    """``list_files`` plus the number of entries skipped for having no race id."""
    jvm, conf = _hadoop(spark)
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    statuses = fs.globStatus(jvm.org.apache.hadoop.fs.Path(base, f"*{kind}*")) or []

    def expand(st) -> list[DataFile]:
        entry = st.getPath().getName()
        m = _RACE_RE.search(entry)
        if _hidden(entry) or not m:
            return []
        if not st.isDirectory():
            return [DataFile(st.getPath().toString(), entry, kind, m.group(1))]
        found = []
        top = st.getPath().toUri().getPath()
        it = fs.listFiles(st.getPath(), True)
        while it.hasNext():
            f = it.next().getPath()
            rel = f.toUri().getPath()[len(top) :]
            if not any(_hidden(part) for part in rel.split("/") if part):
                found.append(DataFile(f.toString(), entry, kind, m.group(1)))
        return found

    statuses = list(statuses)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        found = [f for group in pool.map(expand, statuses) for f in group]
    named = sum(1 for st in statuses if _RACE_RE.search(st.getPath().getName()) and not _hidden(st.getPath().getName()))
    return found, len(statuses) - named


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line of a CSV file as they stand there (one line is read)."""
    jvm, conf = _hadoop(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine() or ""
    finally:
        stream.close()
    return next(csv.reader([line.lstrip("\ufeff")])) if line else []


_ONE_FILE = str(1 << 40)  # bytes; a cost of opening this high gives every file a task of its own


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: the first row only; what follows is not asked for."""
    for batch in batches:
        if len(batch):
            yield batch.slice(0, 1)
            return


def header_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path`` and first ``line`` of every file that is not empty, read by one task per file.

    A task stops after its first line, so of a file of any size one buffer is read.  The
    settings for this hold in a session of its own.
    """
    apart = spark.newSession()
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        apart.conf.set(setting, _ONE_FILE)
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = apart.read.option("recursiveFileLookup", True).text(paths)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return lines.select(path.alias("path"), F.col("value").alias("line")).mapInArrow(_first_row, "path string, line string")


def header_groups(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each distinct header, grouped in the executors.

    The driver gets every distinct header line once, and the paths, which it needs to name each group's files.
    """
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for r in header_lines(spark, paths).groupBy("line").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect():
        groups[tuple(next(csv.reader([r.line.lstrip("\ufeff")]), []))] += r.paths
    return dict(groups)


def _entry(root: str) -> Column:
    """Name of the entry below ``root`` a row came from; a row from elsewhere is an error.

    ``root`` is qualified and, like ``_metadata.file_path``, URI-encoded; an
    empty authority may be written ``file:/`` or ``file:///`` on either side.
    """
    path, root = F.col("_metadata.file_path"), root.rstrip("/") + "/"
    short = re.sub(r"^([a-z][a-z0-9+.-]*):///", r"\1:/", root)
    long = re.sub(r"^([a-z][a-z0-9+.-]*):/(?!/)", r"\1:///", short)
    below = F.when(path.startswith(short), F.substring(path, len(short) + 1, 1 << 30))
    if long != short:
        below = below.when(path.startswith(long), F.substring(path, len(long) + 1, 1 << 30))
    below = below.otherwise(F.raise_error(F.concat(F.lit(f"not below {short}: "), path)).cast("string"))
    return F.url_decode(F.replace(F.element_at(F.split(below, "/"), 1), F.lit("+"), F.lit("%2B")))


def race_id_column(root: str | None = None, pattern: str = RACE_ID_PATTERN) -> Column:
    """Race id of a row: first ``_<digits>`` of the entry below ``root`` it came from.

    The entry is the file itself for a file directly below ``root``, or the
    top folder for files inside a folder -- the same rule the listing uses, so
    a file without an id never picks one up from a folder above it.  Without
    ``root`` the file name, then its folder, is used.
    """
    if root:
        return race_id_from_name(_entry(root), pattern)
    # split, not an anchored regex: ``([^/]+)$`` backtracks over the whole path
    parts = F.split(F.col("_metadata.file_path"), "/")
    return F.coalesce(
        race_id_from_name(F.element_at(parts, -1), pattern),
        race_id_from_name(F.element_at(parts, -2), pattern),
    )


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` as the file system writes it into ``_metadata.file_path`` (URI-encoded)."""
    jvm, conf = _hadoop(spark)
    p = jvm.org.apache.hadoop.fs.Path(root)
    return p.getFileSystem(conf).makeQualified(p).toUri().toString()


def tolerant(c: Column, dtype: DataType) -> Column:
    """``c`` (text) as ``dtype``; null where it has no such value.

    An integer may be written as a number with an integral value (``7.0``),
    as exports of columns with gaps do.
    """
    text = F.trim(c)
    if isinstance(dtype, IntegralType):
        number = text.try_cast("double")
        return F.coalesce(text.try_cast(dtype), F.when(number == F.floor(number), number.try_cast(dtype)))
    if isinstance(dtype, FractionalType):
        return text.try_cast(dtype)
    return c if isinstance(dtype, StringType) else text.try_cast(dtype)


def _quoted(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def typed(raw: DataFrame, types: Mapping[str, DataType]) -> DataFrame:
    """A text scan with its declared columns cast, in the same column order."""
    return raw.select(*[tolerant(_quoted(c), types[c]).alias(c) if c in types else _quoted(c) for c in raw.columns])


def rejects(raw: DataFrame, types: Mapping[str, DataType]) -> dict[str, Column]:
    """Per declared column, an aggregate counting non-empty fields without a value of its type."""
    return {
        c: F.count_if((F.trim(_quoted(c)) != "") & tolerant(_quoted(c), t).isNull())
        for c, t in types.items()
        if c in raw.columns and not isinstance(t, StringType)
    }


def rejected_fields(raw: DataFrame, types: Mapping[str, DataType], by: Iterable[str] = ("raceId",)) -> DataFrame:
    """One row per group and declared column of a text scan: ``column``, ``rejected``."""
    by = list(by)
    counts = rejects(raw, types)
    names = list(counts)
    grouped = raw.groupBy(*map(_quoted, by)).agg(*[counts[c].alias(f"n{i}") for i, c in enumerate(names)])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("rejected")) for i, c in enumerate(names)]
    return grouped.select(*map(_quoted, by), F.inline(F.array(*pairs)))


def _reader(spark: SparkSession, schema: StructType, options: Mapping[str, str] | None):
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # every file's header is checked against the schema
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True)  # no partition columns from folder names
    )
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader


def _scan(spark: SparkSession, header: Iterable[str], paths, options: Mapping[str, str] | None) -> DataFrame:
    """Text scan of files with one header; names are stripped after Spark has checked them as they stand."""
    header = list(header)
    frame = _reader(spark, StructType([StructField(h, StringType(), True) for h in header]), options).csv(paths)
    return frame.withColumnsRenamed({h: h.strip() for h in header if h != h.strip()})


def scan_csv(
    spark: SparkSession,
    files: list[DataFile],
    options: Mapping[str, str] | None = None,
    root: str | None = None,
    glob: str | None = None,
) -> DataFrame:
    """One text scan per distinct header, stacked by column name, plus ``raceId``.

    Each scan validates headers (``enforceSchema=false``), so a file whose
    columns are reordered can never be read by position.
    """
    if not files:
        raise FileNotFoundError("no data files")
    groups: dict = header_groups(spark, [f.path for f in files])
    if not groups:  # all files are empty
        return spark.createDataFrame([], "raceId string")
    if glob and len(groups) == 1:
        # one header for every file: one path string instead of one per file
        groups = {header: glob for header in groups}
    race = race_id_column(root)
    return union_all([_scan(spark, h, paths, options).withColumn("raceId", race) for h, paths in groups.items()], allow_missing=True)


def first_file(spark: SparkSession, root: str, kind: str) -> DataFile | None:
    """One data file of a kind; the listing stops at the first."""
    jvm, conf = _hadoop(spark)
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(base, f"*{kind}*")) or []:
        entry = st.getPath().getName()
        m = _RACE_RE.search(entry)
        if _hidden(entry) or not m:
            continue
        if not st.isDirectory():
            return DataFile(st.getPath().toString(), entry, kind, m.group(1))
        top, it = st.getPath().toUri().getPath(), fs.listFiles(st.getPath(), True)
        while it.hasNext():
            f = it.next().getPath()
            if not any(_hidden(part) for part in f.toUri().getPath()[len(top) :].split("/") if part):
                return DataFile(f.toString(), entry, kind, m.group(1))
    return None


def scan_uniform(spark: SparkSession, root: str, kind: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """All files of a kind in one text scan, for datasets whose files share one header.

    The driver finds a first file, reads its header and hands Spark one glob;
    Spark lists the rest, checks the header of every file in the executors and
    fails the job on a file that differs (never reading it by position).  Rows
    of entries without a race id in their name are dropped.
    """
    found = first_file(spark, root, kind)
    if not found:
        raise FileNotFoundError(f"no {kind} files below {root}")
    frame = _scan(spark, read_header(spark, found.path), root.rstrip("/") + f"/*{kind}*", options)
    return frame.withColumn("raceId", race_id_column(qualified(spark, root))).where(F.col("raceId").isNotNull())


def raw_files(
    spark: SparkSession, root: str, kind: str, headers: str = "all", options: Mapping[str, str] | None = None
) -> DataFrame:
    """All files of a kind as text columns with ``raceId``.

    ``headers="all"`` reads every file's header and scans each header group
    (files may differ); ``headers="first"`` is the one-glob scan of
    ``scan_uniform`` for large uniform datasets.
    """
    if headers not in ("all", "first"):
        raise ValueError('headers must be "all" or "first"')
    if headers == "first":
        return scan_uniform(spark, root, kind, options)
    files, skipped = _list(spark, root, kind)
    glob = None if skipped else root.rstrip("/") + f"/*{kind}*"
    return scan_csv(spark, files, options, root=qualified(spark, root), glob=glob)


def telemetry(
    spark: SparkSession,
    root: str,
    types: Mapping[str, DataType] = TELEMETRY_TYPES,
    headers: str = "all",
    options: Mapping[str, str] | None = None,
    infer: bool = False,
) -> DataFrame:
    """All telemetry files below ``root`` as one typed frame with ``raceId``.

    ``infer`` also types the columns that ``types`` does not name, from one more pass over the text;
    without it they stay text.
    """
    return _typed(raw_files(spark, root, TELEMETRY, headers, options), types, infer)


def _typed(raw: DataFrame, types: Mapping[str, DataType], infer: bool) -> DataFrame:
    return typed(raw, infer_types(raw, types) if infer else types)


def participants(
    spark: SparkSession, root: str, types: Mapping[str, DataType] = PARTICIPANT_TYPES, infer: bool = False
) -> DataFrame:
    """Driver table of every race, stacked by name, with ``raceId``."""
    return _typed(raw_files(spark, root, PARTICIPANTS), types, infer)


def sessions(spark: SparkSession, root: str, types: Mapping[str, DataType] = SESSION_TYPES, infer: bool = False) -> DataFrame:
    """Session table of every race (read from the session files), with ``raceId``."""
    return _typed(raw_files(spark, root, SESSIONS), types, infer)


KINDS = (TELEMETRY, PARTICIPANTS, SESSIONS)


def data_files(spark: SparkSession, root: str, kinds: Iterable[str] = KINDS) -> DataFrame:
    """Files below ``root`` that belong to a race: raceId, kind, entry, file, bytes, modified.

    Spark lists the files; no file is opened.
    """
    base = qualified(spark, root)
    jvm, conf = _hadoop(spark)
    frames = []
    for kind in kinds:
        pattern = jvm.org.apache.hadoop.fs.Path(root, f"*{kind}*")
        if not pattern.getFileSystem(conf).globStatus(pattern):
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern.toString())
        entry = _entry(base)
        frames.append(
            files.select(
                race_id_from_name(entry, RACE_ID_PATTERN).alias("raceId"),
                F.lit(kind).alias("kind"),
                entry.alias("entry"),
                F.col("path").alias("file"),
                F.col("length").alias("bytes"),
                F.col("modificationTime").alias("modified"),
            )
        )
    if not frames:
        return spark.createDataFrame([], "raceId string, kind string, entry string, file string, bytes bigint, modified timestamp")
    return union_all(frames).where(F.col("raceId").isNotNull())


def catalogue(spark: SparkSession, root: str, kinds=KINDS) -> DataFrame:
    """Races found below ``root``: one row per race with a flag per file kind."""
    return data_files(spark, root, kinds).groupBy("raceId").agg(
        *[F.max(F.col("kind") == F.lit(k)).alias(f"has_{k}") for k in kinds],
        F.count_distinct("entry").alias("entries"),
    )


def catalogue_files(files: DataFrame) -> DataFrame:
    """One row per race of ``data_files``: its entries, and a map from kind to that kind's files with size and time, by name."""
    each = files.groupBy("raceId", "kind").agg(
        F.sort_array(F.collect_list(F.struct("file", "bytes", "modified"))).alias("files"), F.collect_set("entry").alias("entries")
    )
    return each.groupBy("raceId").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("entries")))).alias("entries"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "files")))).alias("files"),
    )


def catalogue_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Entries of two ``data_files`` snapshots that are ``new``, ``changed`` or ``gone``, with their sizes.

    An entry has changed when its files' number, bytes or latest time differ.  A snapshot to
    compare with later must be written: ``data_files`` lists anew whenever it is read.
    """
    sides = [
        df.groupBy("raceId", "kind", "entry").agg(
            F.count(F.lit(1)).alias(f"{name}_files"), F.sum("bytes").alias(f"{name}_bytes"), F.max("modified").alias(f"{name}_modified")
        )
        for name, df in (("before", before), ("after", after))
    ]
    both = sides[0].join(sides[1], ["raceId", "kind", "entry"], "full_outer")
    differ = F.lit(False)
    for c in ("files", "bytes", "modified"):
        differ = differ | ~F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}"))
    status = F.when(F.col("before_files").isNull(), "new").when(F.col("after_files").isNull(), "gone").when(differ, "changed")
    return both.withColumn("status", status).where(F.col("status").isNotNull())


def chunks(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Read a chunked dataset back with its declared schema.

    The schema also types the partition columns (``raceId`` stays a string
    even when it is a 20-digit number).
    """
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)
