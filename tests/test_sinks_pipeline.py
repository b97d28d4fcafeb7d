"""Sinks and the whole pipeline, on files derived from view T."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from conftest import SF_SMALL
from pitlane.operators.impute import prepare
from pitlane.plans.fixtures import write_kind, write_race_files
from pitlane.plans.pipeline import PipelineConf, run
from pitlane.plans.telemetry_view import T_SERIES, load_t
from pitlane.session import ensure_checkpoint_dir
from pitlane.sinks.files import CHUNK_LAYOUT, CHUNK_LAYOUT_PER_CHUNK, with_chunk_key, write_chunks, write_flat, write_keyed_chunks
from pitlane.sources.files import chunks


def test_chunk_layouts_and_pruning(spark, workdir):
    prepared = prepare(load_t(spark, SF_SMALL), series=T_SERIES)
    path = os.path.join(workdir, "chunks")
    write_chunks(prepared, path, layout=CHUNK_LAYOUT_PER_CHUNK)
    back = chunks(spark, path, prepared.schema)
    assert back.count() == prepared.count()
    one = back.where((F.col("pilot_index") == 1) & (F.col("chunk_id") == 0) & (F.col("raceId") == "view"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionFilters" in plan.lower()
    assert one.count() == prepared.where("pilot_index = 1 AND chunk_id = 0 AND raceId = 'view'").count()
    assert os.path.isdir(os.path.join(path, "raceId=view", "pilot_index=1", "chunk_id=0"))


def test_chunk_key_is_unique_per_chunk(spark):
    prepared = with_chunk_key(prepare(load_t(spark, SF_SMALL), series=T_SERIES))
    keys = prepared.groupBy("chunk_key").agg(F.countDistinct("raceId", "pilot_index", "chunk_id").alias("n"))
    assert keys.where("n <> 1").count() == 0


def test_pipeline_run(spark, workdir):
    t = load_t(spark, SF_SMALL)
    root = write_race_files(spark, t)
    conf = PipelineConf(
        source=root,
        chunks_path=os.path.join(workdir, "chunks"),
        table_path=os.path.join(workdir, "table"),
        participants_path=os.path.join(workdir, "participants"),
        sessions_path=os.path.join(workdir, "sessions"),
        series=T_SERIES,
    )
    written = run(spark, conf)
    assert set(written) == {"chunks", "table", "participants", "sessions"}
    assert written.counts == {"rows_without_key": 0, "rejected_fields": {}, "duplicate_frames": 0}
    table = spark.read.parquet(conf.table_path)
    assert table.count() == t.count()
    assert "row_num" not in table.columns and "raceId" in table.columns
    assert table.select("raceId").distinct().count() == t.select("raceId").distinct().count()
    assert spark.read.parquet(conf.participants_path).count() == t.select("raceId", "pilot_index").distinct().count()
    assert spark.read.parquet(conf.sessions_path).count() == t.select("raceId").distinct().count()
    ch = spark.read.parquet(conf.chunks_path)
    gaps = ch.groupBy("raceId", "pilot_index").agg((F.max("chunk_id") + 1 - F.countDistinct("chunk_id")).alias("gap"))
    assert gaps.where("gap <> 0").count() == 0


def test_chunk_key_keeps_null_parts(spark):
    df = spark.createDataFrame([("r", None, 3), ("r", 3, None)], "raceId string, pilot_index int, chunk_id bigint")
    assert sorted(r.chunk_key for r in with_chunk_key(df).collect()) == ["r_3_", "r__3"]


def test_missing_dimension_files_are_an_error(spark, workdir):
    root = os.path.join(workdir, "races")
    write_kind(load_t(spark, SF_SMALL), root, "Telemetry", mode="overwrite")
    chunks_path = os.path.join(workdir, "chunks")
    with pytest.raises(FileNotFoundError):
        run(spark, PipelineConf(source=root, chunks_path=chunks_path, participants_path=os.path.join(workdir, "p"), series=T_SERIES))
    assert not os.path.exists(chunks_path)  # nothing was written before the error
    assert set(run(spark, PipelineConf(source=root, chunks_path=chunks_path, series=T_SERIES))) == {"chunks"}
    assert spark.read.parquet(chunks_path).count() == load_t(spark, SF_SMALL).count()


def staging_folders(spark):
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:") + "/pitlane"
    return {d for d in os.listdir(base) if d.startswith(("cleaned", "prepared"))} if os.path.isdir(base) else set()


def race_csv(root, race, pilots, frames):
    os.makedirs(root, exist_ok=True)
    rows = "".join(f"{p},{f},{race}{p}.5\n" for p in pilots for f in frames)
    for kind, text in (
        ("TelemetryData", "pilot_index,frameIdentifier,speed\n" + rows),
        ("ParticipantData", "pilot_index,name\n" + "".join(f"{p},x\n" for p in pilots)),
        ("SessionData", "trackId\n7\n"),
    ):
        with open(os.path.join(root, f"{kind}_{race}.csv"), "w") as f:
            f.write(text)


@pytest.mark.parametrize("layout", [CHUNK_LAYOUT, CHUNK_LAYOUT_PER_CHUNK])
def test_replacing_one_race_keeps_the_others_in_every_output(spark, workdir, layout):
    outputs = {f"{k}_path": os.path.join(workdir, k) for k in ("chunks", "table", "participants", "sessions")}
    common = {"chunk_size": 5, "chunks_layout": layout, "dynamic_overwrite": True, "session_types": {"trackId": IntegerType()}, **outputs}
    race_csv(os.path.join(workdir, "first"), 1, (0, 1), range(20))
    race_csv(os.path.join(workdir, "first"), 2, (0, 1), range(20))
    race_csv(os.path.join(workdir, "second"), 2, (0,), range(8))
    for name in ("first", "second"):
        written = run(spark, PipelineConf(source=os.path.join(workdir, name), **common))
        assert set(written) == {"chunks", "table", "participants", "sessions"}
    counts = {"chunks": {"1": 40, "2": 8}, "table": {"1": 40, "2": 8}, "participants": {"1": 2, "2": 1}, "sessions": {"1": 1, "2": 1}}
    for name, want in counts.items():
        rows = spark.read.parquet(outputs[f"{name}_path"]).groupBy("raceId").count().collect()
        assert {str(r.raceId): r["count"] for r in rows} == want, name
    assert not staging_folders(spark)


def test_dynamic_overwrite_and_jdbc_exclude_each_other():
    with pytest.raises(ValueError):
        PipelineConf(source="x", jdbc_url="jdbc:x", dynamic_overwrite=True)


def test_rejected_rows_and_fields_are_counted(spark, workdir):
    root = os.path.join(workdir, "races")
    os.makedirs(root)
    with open(os.path.join(root, "TelemetryData_3.csv"), "w") as f:
        f.write("pilot_index,frameIdentifier,gear,speed\n1,1,7.0,1.0\n1,1,3,2.0\n,2,1,3.0\n1,,1,4.0\nx,3,bad,5.0\n1,4,2,\n")
    conf = PipelineConf(source=root, table_path=os.path.join(workdir, "t"), rejects_path=os.path.join(workdir, "r"))
    written = run(spark, conf)
    assert written.counts == {"rows_without_key": 3, "rejected_fields": {"pilot_index": 1, "gear": 1}, "duplicate_frames": 1}
    assert sorted(r.speed for r in spark.read.parquet(conf.rejects_path).collect()) == [3.0, 4.0, 5.0]
    assert spark.read.parquet(conf.table_path).count() == 3
    with pytest.raises(ValueError, match="occur twice"):
        run(spark, replace(conf, duplicate_frames="error", table_path=os.path.join(workdir, "t2")))
    assert not os.path.exists(os.path.join(workdir, "t2")) and not staging_folders(spark)


def test_every_chunk_is_in_one_file(spark, workdir):
    prepared = prepare(load_t(spark, SF_SMALL), series=T_SERIES, chunk_size=20)
    layouts = {"per_chunk": {"layout": CHUNK_LAYOUT_PER_CHUNK}, "runs": {"chunks_per_file": 3}}
    for name, options in layouts.items():
        write_chunks(prepared, os.path.join(workdir, name), **options)
    write_keyed_chunks(prepared, os.path.join(workdir, "keyed"))
    for name in ("per_chunk", "keyed"):
        for folder, _, names in os.walk(os.path.join(workdir, name)):
            assert sum(n.endswith(".parquet") for n in names) <= 1, folder
    for name in ("per_chunk", "runs", "keyed"):
        rows = spark.read.parquet(os.path.join(workdir, name))
        keys = ["chunk_key"] if name == "keyed" else ["raceId", "pilot_index", "chunk_id"]
        files = rows.withColumn("f", F.col("_metadata.file_path")).groupBy(*keys).agg(F.countDistinct("f").alias("n"))
        assert files.where("n <> 1").count() == 0 and rows.count() == prepared.count()


def test_flat_extract_by_race(spark, workdir):
    t = load_t(spark, SF_SMALL)
    path = os.path.join(workdir, "flat")
    write_flat(t, path, by=("raceId",))
    write_flat(t.where("raceId = 'click' AND pilot_index = 0"), path, by=("raceId",), dynamic=True)
    want = t.where("raceId <> 'click' OR pilot_index = 0").groupBy("raceId").count()
    got = spark.read.parquet(path).groupBy("raceId").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_jdbc_connections_are_bounded(spark, workdir, monkeypatch):
    from pitlane.plans import pipeline

    calls = []
    monkeypatch.setattr(pipeline, "write_jdbc", lambda df, url, table, **o: calls.append((df.count(), url, table, o)))
    root = os.path.join(workdir, "races")
    race_csv(root, 1, (0,), range(5))
    run(spark, PipelineConf(source=root, jdbc_url="jdbc:x", table_path=os.path.join(workdir, "t")))
    (rows, url, table, options), = calls
    assert (rows, url, table) == (5, "jdbc:x", "telemetry")
    assert options == {"properties": {}, "num_partitions": 16, "truncate": False, "batch_size": 10_000}


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_command_line(spark, workdir, capsys):
    import json

    from pitlane.plans.pipeline import main

    root = write_race_files(spark, load_t(spark, SF_SMALL))
    out = os.path.join(workdir, "cli")
    main(["--master", "local[2]", "--source", root, "--chunks", f"{out}/chunks", "--chunks-format", "csv",
          "--per-chunk-folders", "--sessions", f"{out}/sessions", "--uniform-headers"])
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(printed["written"]) == {"chunks", "sessions"} and printed["counts"]["rows_without_key"] == 0
    assert any(d.startswith("raceId=") for d in os.listdir(f"{out}/chunks"))
    assert spark.read.parquet(f"{out}/sessions").count() == 5


def test_flat_extract_bounds_file_size(spark, workdir):
    t = load_t(spark, SF_SMALL)
    path = os.path.join(workdir, "flat")
    write_flat(t, path, max_records_per_file=100)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) >= t.count() // 100
    assert not any(os.path.isdir(os.path.join(path, f)) for f in os.listdir(path))  # no key=value folders
    assert spark.read.parquet(path).count() == t.count()
