"""Padded chunk sequences, the global index, and manifests of what was written."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pitlane.operators.impute import prepare
from pitlane.operators.index import global_index
from pitlane.operators.sequences import chunk_sequences, sequence_rows
from pitlane.plans import pipeline
from pitlane.plans.fixtures import write_race_files
from pitlane.plans.pipeline import PipelineConf, run
from pitlane.plans.telemetry_view import T_SERIES, load_t
from pitlane.sinks.files import write_chunks
from pitlane.sinks.manifest import differences, files_written, verify, written_manifest
from pitlane.sources import files as src
from pitlane.sources.files import chunks

CHUNK = "raceId string, pilot_index int, chunk_id bigint, row_num bigint, frameIdentifier bigint, speed double, `g.x` int"


def test_sequences_are_ordered_and_padded(spark):
    rows = [("a", 1, 0, k, 10 * k, float(k) if k != 2 else None, k % 2) for k in (3, 1, 2, 4)] + [("a", 1, 1, 5, 50, 5.0, None)]
    got = chunk_sequences(spark.createDataFrame(rows, CHUNK).repartition(3), ["speed", "g.x"], size=4).orderBy("chunk_id").collect()
    assert [tuple(r) for r in got] == [
        ("a", 1, 0, 4, [True] * 4, [1.0, None, 3.0, 4.0], [1.0, 0.0, 1.0, 0.0]),
        ("a", 1, 1, 1, [True, False, False, False], [5.0, None, None, None], [None] * 4),
    ]
    padded = chunk_sequences(spark.createDataFrame(rows, CHUNK), ["speed"], size=4, pad=-1.0).where("chunk_id = 1").first()
    assert padded.speed == [5.0, -1.0, -1.0, -1.0]
    with pytest.raises(Exception, match="more than 3 rows"):
        chunk_sequences(spark.createDataFrame(rows, CHUNK), ["speed"], size=3).collect()


def test_sequences_taken_apart_are_the_chunks(spark):
    prepared = prepare(load_t(spark, SF_SMALL), series=T_SERIES, chunk_size=30)
    back = sequence_rows(chunk_sequences(prepared, ["speed"], size=30), ["speed"])
    real = back.where("real").select("raceId", "pilot_index", (F.col("chunk_id") * 30 + F.col("position") + 1).alias("row_num"), "speed")
    want = prepared.select("raceId", "pilot_index", "row_num", "speed")
    assert real.exceptAll(want).count() == want.exceptAll(real).count() == 0
    assert back.where("not real and speed is not null").count() == 0


def test_writing_sequences_needs_one_exchange(spark, workdir):
    """One exchange by chunk after the rows, none for writing them by race."""
    path = os.path.join(workdir, "chunks")
    prepared = prepare(load_t(spark, SF_SMALL), series=T_SERIES)
    write_chunks(prepared, path)
    rows = chunks(spark, path, prepared.schema)
    plan = chunk_sequences(rows, ["speed", "FL_surfaceType"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_collect_list" in plan


def test_global_index(spark):
    rows = [(i * 7919 % 1000, None if i % 50 == 0 else f"v{i % 13}") for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    got = global_index(df, F.col("b").asc_nulls_last(), "a", name="place").collect()
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[0]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(1, 1001))
    assert global_index(df.limit(0), "a").collect() == []


def test_global_index_has_no_single_task(spark):
    df = spark.range(0, 20_000, 1, 6).select((F.col("id") * 7919 % 20_000).alias("k"))
    out = global_index(df, "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    assert out.where("row_index <> k + 1").count() == 0


@pytest.fixture()
def written(spark, workdir):
    prepared = prepare(load_t(spark, SF_SMALL), series=T_SERIES, chunk_size=20)
    path = os.path.join(workdir, "chunks")
    write_chunks(prepared, path)
    return prepared, path


def test_manifest_of_written_files(spark, written):
    prepared, path = written
    back = chunks(spark, path, prepared.schema)
    each = written_manifest(back).collect()
    assert sum(r.frames for r in each) == prepared.count()
    assert len(each) == prepared.select("raceId", "pilot_index", "chunk_id").distinct().count()  # no chunk in two files
    assert all(r.last_row - r.first_row + 1 == r.frames for r in each)
    for f in files_written(back).collect():
        assert f.rows == spark.read.parquet(f.file).count() and f.bytes == os.path.getsize("/" + f.file.removeprefix("file:").lstrip("/"))
    verify(spark, prepared, path)


def test_short_and_double_writes_are_seen(spark, written):
    prepared, path = written
    back = chunks(spark, path, prepared.schema)
    assert differences(prepared, back).collect() == []
    file = files_written(back).orderBy("file").first().file
    short = back.where(F.col("_metadata.file_path") != file)
    missing = differences(prepared, short).collect()
    assert missing and all(r.written_frames is None and r.planned_frames > 0 for r in missing)
    write_chunks(prepared.where("raceId = 'view'"), path, mode="append")
    with pytest.raises(OSError, match="planned chunks"):
        verify(spark, prepared, path)
    verify(spark, prepared.where("raceId = 'click'"), path)  # the other races are in order


def test_run_that_writes_too_little_fails(spark, workdir, monkeypatch):
    conf = PipelineConf(source=write_race_files(spark, load_t(spark, SF_SMALL)), chunks_path=os.path.join(workdir, "c"), series=T_SERIES, verify_chunks=True)
    assert set(run(spark, conf)) == {"chunks"}
    run(spark, replace(conf, chunks_path=os.path.join(workdir, "csv"), chunks_format="csv"))
    monkeypatch.setattr(pipeline, "write_chunks", lambda df, *a, **o: write_chunks(df.where("pilot_index <> 1"), *a, **o))
    with pytest.raises(OSError, match="planned chunks"):
        run(spark, replace(conf, chunks_path=os.path.join(workdir, "d")))


def test_catalogue_of_files_and_changes(spark, workdir):
    def put(name, text):
        with open(os.path.join(workdir, name), "w") as f:
            f.write(text)

    put("TelemetryData_1.csv", "a\n1\n")
    put("SessionData_1.csv", "b\n")
    put("TelemetryData_2.csv", "a\n")
    put("TelemetryData_x.csv", "no race\n")
    files = src.data_files(spark, workdir)
    got = {r.raceId: r for r in src.catalogue_files(files).collect()}
    assert set(got) == {"1", "2"} and got["1"].entries == ["SessionData_1.csv", "TelemetryData_1.csv"]
    assert [(f.file.rsplit("/", 1)[-1], f.bytes) for f in got["1"]["files"]["Telemetry"]] == [("TelemetryData_1.csv", 4)]
    assert set(got["1"]["files"]) == {"Telemetry", "SessionData"} and got["2"]["files"]["Telemetry"][0].modified is not None
    before = spark.createDataFrame(files.collect(), files.schema)
    assert src.catalogue_changes(before, src.data_files(spark, workdir)).collect() == []
    put("TelemetryData_1.csv", "a\n1\n2\n")
    put("ParticipantData_2.csv", "c\n")
    os.remove(os.path.join(workdir, "TelemetryData_2.csv"))
    changes = src.catalogue_changes(before, src.data_files(spark, workdir)).collect()
    assert {(r.raceId, r.kind, r.status) for r in changes} == {("1", "Telemetry", "changed"), ("2", "ParticipantData", "new"), ("2", "Telemetry", "gone")}
    assert src.data_files(spark, os.path.join(workdir, "none")).collect() == []
