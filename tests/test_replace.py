"""Replacing races: whatever fails, no race is lost."""

import os

import pytest
from pyspark.sql import functions as F

from pitlane.plans import pipeline
from pitlane.plans.pipeline import PipelineConf, run
from pitlane.sinks import replace as R
from pitlane.sinks.files import write_chunks, write_flat


def rows(spark, races, n, tag):
    return spark.range(n).select(F.explode(F.array(*map(F.lit, races))).alias("raceId"), F.col("id"), F.lit(tag).alias("tag"))


def table(spark, path):
    return {(str(r.raceId), r.tag): r["count"] for r in spark.read.parquet(path).groupBy("raceId", "tag").count().collect()}


def write(df):
    return lambda path: write_flat(df, path, by=("raceId",))


@pytest.fixture()
def path(spark, workdir):
    path = os.path.join(workdir, "table")
    assert R.replace_partitions(spark, path, write(rows(spark, ["1", "2"], 10, "old"))) == ["raceId=1", "raceId=2"]
    return path


OLD = {("1", "old"): 10, ("2", "old"): 10}
NEW = {("1", "old"): 10, ("2", "new"): 4, ("3", "new"): 4}


def test_replaces_and_adds(spark, path):
    R.replace_partitions(spark, path, write(rows(spark, ["2", "3"], 4, "new")))
    assert table(spark, path) == NEW
    assert not [n for n in os.listdir(os.path.join(path, R.JOURNAL)) if not n.startswith(".")]


def test_a_failed_write_leaves_the_old_races(spark, path):
    bad = rows(spark, ["2"], 4, "new").withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        R.replace_partitions(spark, path, write(bad))
    assert table(spark, path) == OLD


@pytest.mark.parametrize("moves", range(5))
def test_a_switch_that_ends_anywhere_is_finished_later(spark, path, monkeypatch, moves):
    """The run dies after ``moves`` of its moves; the next one finishes them."""
    done = []
    move = R._Folder.move

    def dying(self, source, target):
        if len(done) >= moves:
            raise KeyboardInterrupt
        done.append(target)
        move(self, source, target)

    monkeypatch.setattr(R._Folder, "move", dying)
    monkeypatch.setattr(R, "_THREADS", 1)
    new = write(rows(spark, ["2", "3"], 4, "new"))
    if moves < 3:
        with pytest.raises(KeyboardInterrupt):
            R.replace_partitions(spark, path, new)
    else:
        R.replace_partitions(spark, path, new)
    monkeypatch.setattr(R._Folder, "move", move)
    assert R.recover(spark, path) == (moves < 3)
    assert table(spark, path) == NEW
    assert R.recover(spark, path) == 0


def test_a_run_that_died_before_its_commit_is_undone(spark, path):
    write(rows(spark, ["2"], 4, "new"))(os.path.join(path, R.JOURNAL, "dead", "new"))
    assert table(spark, path) == OLD  # out of the readers' sight
    assert R.recover(spark, path) == 0
    assert not os.path.exists(os.path.join(path, R.JOURNAL, "dead")) and table(spark, path) == OLD


def race(root, n, frames):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, f"TelemetryData_{n}.csv"), "w") as f:
        f.write("pilot_index,frameIdentifier,speed\n" + "".join(f"0,{i},1.0\n" for i in range(frames)))


@pytest.mark.parametrize("output", ["chunks", "table", "rejects"])
def test_pipeline_keeps_a_race_whose_replacement_fails(spark, workdir, monkeypatch, output):
    out = os.path.join(workdir, output)
    for name, frames in (("first", 9), ("second", 5)):
        race(os.path.join(workdir, name), 7, frames)
        with open(os.path.join(workdir, name, "TelemetryData_7.csv"), "a") as f:
            f.write(",1,2.0\n" * frames)  # rows without a car
    conf = {f"{output}_path": out, "dynamic_overwrite": True}
    run(spark, PipelineConf(source=os.path.join(workdir, "first"), **conf))

    def failing(df, path, *args, **kwargs):
        bad = df.withColumn("speed", F.when(F.col("frameIdentifier") >= 1, F.raise_error(F.lit("disk full"))).otherwise(F.col("speed")))
        (write_chunks if output == "chunks" else write_flat)(bad, path, *args, **kwargs)

    name = "write_chunks" if output == "chunks" else "write_flat"
    with monkeypatch.context() as m:
        m.setattr(pipeline, name, failing)
        with pytest.raises(Exception, match="disk full"):
            run(spark, PipelineConf(source=os.path.join(workdir, "second"), **conf))
    assert spark.read.parquet(out).count() == 9
    run(spark, PipelineConf(source=os.path.join(workdir, "second"), **conf))
    assert spark.read.parquet(out).count() == 5


def test_jdbc_only_run_writes_staged_rows(spark, workdir, monkeypatch):
    """The writer's few connections must not narrow the series pass: it reads rows that are written already."""
    plans = []
    monkeypatch.setattr(pipeline, "write_jdbc", lambda df, *a, **o: plans.append((df.count(), df.inputFiles(), df._jdf.queryExecution().executedPlan().toString())))
    root = os.path.join(workdir, "races")
    for n in (1, 2):
        race(root, n, 50)
    run(spark, PipelineConf(source=root, jdbc_url="jdbc:x"))
    ((n, read, plan),) = plans
    assert n == 100
    assert read and all("/prepared-" in f for f in read)
    assert not any(x in plan for x in ("Window", "Exchange", "Join"))
