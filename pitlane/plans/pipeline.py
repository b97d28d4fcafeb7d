"""The full preparation pipeline over a folder of race files.

raw files ─scan─► typed, clean ─► staged once (the CSV is parsed once)
                                    │
              rows without a key ◄──┴──► fills + row numbers ─► chunk ids
                                                                   │
                                    staged when two sinks read it  │
             ┌─────────────────────────────────────────────────────┴┐
   relational table (JDBC or Parquet)        chunked training set (Parquet/CSV)
participant / session files ─► stacked tables with raceId ─► their own sinks

One plan for all races; no per-race loop runs on the driver.  What a run
rejects (fields without a value of their type, rows without a key, frames that
occur twice) is counted while the rows pass, not by passes of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from pitlane.functions.roles import CHUNK_SIZE, DEFAULT_ROLES, Roles
from pitlane.operators.clean import clean
from pitlane.operators.impute import imputed_chunks
from pitlane.operators.keys import keyed_rows, keyless, rejected_rows
from pitlane.operators.series import DEFAULT_SERIES, Series
from pitlane.session import ensure_checkpoint_dir, remove_path, staging_path
from pitlane.sinks.files import CHUNK_LAYOUT, write_chunks, write_flat, write_jdbc
from pitlane.sinks.manifest import verify
from pitlane.sinks.replace import replace_partitions
from pitlane.sources import files as src
from pitlane.sources.infer import infer_types


@dataclass(frozen=True)
class PipelineConf:
    """Where the raw files are and where each output goes (None: skip it)."""

    source: str
    chunks_path: str | None = None
    chunks_format: str = "parquet"
    chunks_layout: tuple[str, ...] = CHUNK_LAYOUT
    chunk_size: int = CHUNK_SIZE
    table_path: str | None = None  # relational table as Parquet
    jdbc_url: str | None = None  # relational table over JDBC
    jdbc_table: str = "telemetry"
    jdbc_properties: Mapping[str, str] = field(default_factory=dict)
    jdbc_num_partitions: int = 16  # bound of concurrent connections
    jdbc_truncate: bool = False
    jdbc_batch_size: int = 10_000
    participants_path: str | None = None
    sessions_path: str | None = None
    rejects_path: str | None = None  # rows without a race, car or frame
    roles: Roles | None = None
    series: Series = DEFAULT_SERIES
    dynamic_overwrite: bool = False  # replace only the races present in the input, in every output
    duplicate_frames: str = "report"  # "error": fail before any sink when a series has a frame twice
    headers: str = "all"  # "first": one header, one glob, headers checked by Spark (uniform files)
    types: Mapping[str, DataType] = field(default_factory=dict)  # types of further telemetry columns
    participant_types: Mapping[str, DataType] = field(default_factory=dict)
    session_types: Mapping[str, DataType] = field(default_factory=dict)
    reader_options: Mapping[str, str] = field(default_factory=dict)
    infer_telemetry: bool = False  # types of telemetry columns without a declared one: one more pass over the text
    verify_chunks: bool = False  # read the written chunks' keys back and fail unless they are the planned ones
    infer_dimensions: bool = True  # the same for the participant and session tables, which are small

    def __post_init__(self) -> None:
        if self.dynamic_overwrite and self.jdbc_url:
            raise ValueError("a JDBC table cannot replace single races: no dynamic_overwrite with jdbc_url")
        if self.dynamic_overwrite and self.chunks_layout[0] != "raceId":
            raise ValueError("dynamic_overwrite needs a chunk layout that starts with raceId")
        if self.duplicate_frames not in ("report", "error"):
            raise ValueError('duplicate_frames must be "report" or "error"')


class Written(dict):
    """``{output: location}`` of a run; ``counts`` has what it rejected and reported."""

    def __init__(self) -> None:
        super().__init__()
        self.counts: dict[str, int | dict[str, int]] = {}


_PREVIOUS = "_pl_previous_frame"


def cleaned_telemetry(spark: SparkSession, conf: PipelineConf, seen: Observation | None = None) -> DataFrame:
    """Typed and cleaned rows of all telemetry files; ``seen`` counts rejected fields and rows without a key."""
    types = {**src.TELEMETRY_TYPES, **conf.types}
    raw = src.raw_files(spark, conf.source, src.TELEMETRY, conf.headers, conf.reader_options)
    if conf.infer_telemetry:
        roles = conf.roles or DEFAULT_ROLES  # what cleaning reads as text stays text
        types = infer_types(raw, types, skip=["raceId", *roles.consumed, *[c for c in [roles.compound] if c]])
    if seen is not None:
        key_types = {c: types[c] for c in (*conf.series.keys, conf.series.order) if c in types and c in raw.columns}
        no_key = keyless(conf.series) if set(conf.series.keys) | {conf.series.order} <= set(raw.columns) else F.lit(True)
        for c, t in key_types.items():
            no_key = no_key | src.tolerant(F.col(c), t).isNull()
        counts = [n.alias(f"rejected {c}") for c, n in src.rejects(raw, types).items()]
        raw = raw.observe(seen, F.count_if(no_key).alias("no key"), *counts)
    return clean(src.typed(raw, types), conf.roles)


def prepared_telemetry(cleaned: DataFrame, conf: PipelineConf, seen: Observation | None = None) -> DataFrame:
    """Filled, numbered and chunked rows of the series; ``seen`` counts frames that occur twice."""
    rows = keyed_rows(cleaned, conf.series)
    if seen is None:
        return imputed_chunks(rows, conf.roles, conf.series, conf.chunk_size)
    # equal frames are neighbours in their series: one more lag in the same window finds them
    out = imputed_chunks(rows, conf.roles, conf.series, conf.chunk_size, previous={_PREVIOUS: conf.series.order})
    twice = F.count_if(F.col(_PREVIOUS) == F.col(conf.series.order)).alias("twice")
    return out.observe(seen, twice).drop(_PREVIOUS)


def _staged(spark: SparkSession, df: DataFrame, name: str, stages: list[str]) -> DataFrame:
    stages.append(staging_path(spark, name))
    df.write.parquet(stages[-1])
    return spark.read.schema(df.schema).parquet(stages[-1])


def run(spark: SparkSession, conf: PipelineConf) -> Written:
    """Run the pipeline; returns where each output was written.

    Asking for an output whose files are missing is an error, raised before
    anything is written.  Staging tables lie below ``spark.checkpoint.dir``
    and are removed at the end.
    """
    ensure_checkpoint_dir(spark)
    written = Written()
    dimensions = list(dimension_tables(spark, conf))
    stages: list[str] = []
    try:
        if conf.chunks_path or conf.table_path or conf.jdbc_url or conf.rejects_path:
            _write_telemetry(spark, conf, written, stages)
        for name, path, table in dimensions:
            _write_table(table, path, conf)
            written[name] = path
    finally:
        for path in stages:
            remove_path(spark, path)
    return written


def _write_table(table: DataFrame, path: str, conf: PipelineConf) -> None:
    """A table of many races: flat, or by race so that single races can be replaced."""
    if conf.dynamic_overwrite:
        replace_partitions(table.sparkSession, path, lambda new: write_flat(table, new, by=("raceId",)))
    else:
        write_flat(table, path)


def _write_telemetry(spark: SparkSession, conf: PipelineConf, written: Written, stages: list[str]) -> None:
    fields, frames = Observation(), Observation()
    # the only pass over the CSV text; the block summary and the rows both read columns of this
    cleaned = _staged(spark, cleaned_telemetry(spark, conf, fields), "cleaned", stages)
    seen = fields.get
    written.counts["rows_without_key"] = seen["no key"]
    written.counts["rejected_fields"] = {c.removeprefix("rejected "): n for c, n in seen.items() if c.startswith("rejected ") and n}
    if conf.rejects_path:
        _write_table(rejected_rows(cleaned, conf.series), conf.rejects_path, conf)
        written["rejects"] = conf.rejects_path
    sinks = [conf.chunks_path, conf.table_path, conf.jdbc_url]
    if not any(sinks):
        return
    prepared = prepared_telemetry(cleaned, conf, frames)
    if sum(s is not None for s in sinks) > 1 or conf.jdbc_url or conf.verify_chunks or conf.duplicate_frames == "error":
        # several sinks read the same rows, or one that takes few tasks: compute them once, with all tasks, into the shared folder
        prepared = _staged(spark, prepared, "prepared", stages)
        written.counts["duplicate_frames"] = frames.get["twice"]
        if conf.duplicate_frames == "error" and frames.get["twice"]:
            raise ValueError(f"{frames.get['twice']} frames occur twice in their series; set Series.tiebreak or remove them")
    relational = prepared.drop("row_num", "chunk_id")
    if conf.chunks_path:
        def chunks_to(path: str) -> None:
            write_chunks(prepared, path, conf.chunks_format, conf.chunks_layout)

        if conf.dynamic_overwrite:
            replace_partitions(spark, conf.chunks_path, chunks_to)
        else:
            chunks_to(conf.chunks_path)
        if conf.verify_chunks:
            verify(spark, prepared, conf.chunks_path, conf.chunks_format)
        written["chunks"] = conf.chunks_path
    if conf.table_path:
        _write_table(relational, conf.table_path, conf)
        written["table"] = conf.table_path
    if conf.jdbc_url:
        write_jdbc(
            relational, conf.jdbc_url, conf.jdbc_table, properties=conf.jdbc_properties,
            num_partitions=conf.jdbc_num_partitions, truncate=conf.jdbc_truncate, batch_size=conf.jdbc_batch_size,
        )
        written["jdbc"] = f"{conf.jdbc_url}#{conf.jdbc_table}"
    written.counts.setdefault("duplicate_frames", frames.get["twice"])


def dimension_tables(spark: SparkSession, conf: PipelineConf) -> Iterable[tuple[str, str, DataFrame]]:
    """(name, path, table) of the participant and session tables asked for; missing files are an error."""
    for name, path, reader, types in (
        ("participants", conf.participants_path, src.participants, {**src.PARTICIPANT_TYPES, **conf.participant_types}),
        ("sessions", conf.sessions_path, src.sessions, {**src.SESSION_TYPES, **conf.session_types}),
    ):
        if path:
            yield name, path, reader(spark, conf.source, types, conf.infer_dimensions)


def main(argv: list[str] | None = None) -> None:
    """``python -m pitlane --source DIR [--chunks DIR] [--table DIR] ...``"""
    import argparse
    import json

    from pitlane.session import build_session

    ap = argparse.ArgumentParser(prog="pitlane", description="Prepare racing telemetry files.")
    ap.add_argument("--source", required=True, help="folder of <Kind>_<raceId>.csv files")
    ap.add_argument("--chunks", help="chunked training set output")
    ap.add_argument("--chunks-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--per-chunk-folders", action="store_true", help="raceId=/pilot_index=/chunk_id= layout")
    ap.add_argument("--chunk-size", type=int, default=CHUNK_SIZE)
    ap.add_argument("--table", help="relational table as flat Parquet")
    ap.add_argument("--jdbc-url", help="relational table over JDBC (credentials from the environment)")
    ap.add_argument("--jdbc-table", default="telemetry")
    ap.add_argument("--participants", help="stacked participant table output")
    ap.add_argument("--sessions", help="stacked session table output")
    ap.add_argument("--rejects", help="output for rows without a race, car or frame")
    ap.add_argument("--type", action="append", default=[], metavar="COLUMN=TYPE", help="type of a further telemetry column, e.g. lapDistance=double")
    ap.add_argument("--verify-chunks", action="store_true", help="read the written chunks' keys back and compare")
    ap.add_argument("--infer-types", action="store_true", help="type further telemetry columns from their fields")
    ap.add_argument("--reader-option", action="append", default=[], metavar="NAME=VALUE", help="option of the CSV reader")
    ap.add_argument("--replace-races", action="store_true", help="replace only the races present in the input")
    ap.add_argument("--fail-on-duplicate-frames", action="store_true")
    ap.add_argument("--jdbc-connections", type=int, default=16)
    ap.add_argument("--uniform-headers", action="store_true", help="all files share one header: one glob scan")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    args = ap.parse_args(argv)

    from pitlane.sinks.files import CHUNK_LAYOUT_PER_CHUNK

    if args.master:
        spark = build_session(args.master)
    else:
        spark = SparkSession.builder.appName("pitlane").getOrCreate()
        ensure_checkpoint_dir(spark)
    conf = PipelineConf(
        source=args.source,
        chunks_path=args.chunks,
        chunks_format=args.chunks_format,
        chunks_layout=CHUNK_LAYOUT_PER_CHUNK if args.per_chunk_folders else CHUNK_LAYOUT,
        chunk_size=args.chunk_size,
        table_path=args.table,
        jdbc_url=args.jdbc_url,
        jdbc_table=args.jdbc_table,
        participants_path=args.participants,
        sessions_path=args.sessions,
        rejects_path=args.rejects,
        dynamic_overwrite=args.replace_races,
        duplicate_frames="error" if args.fail_on_duplicate_frames else "report",
        jdbc_num_partitions=args.jdbc_connections,
        types={c: DataType.fromDDL(t) for c, t in (x.split("=", 1) for x in args.type)},
        reader_options=dict(x.split("=", 1) for x in args.reader_option),
        headers="first" if args.uniform_headers else "all",
        infer_telemetry=args.infer_types,
        verify_chunks=args.verify_chunks,
    )
    written = run(spark, conf)
    print(json.dumps({"written": written, "counts": written.counts}))
