"""Replacing single races of a written table so that a failure never loses one.

1. *Write*: the new races go to ``<table>/_replacing/<run>/new``, out of every reader's sight.
2. *Commit*: an empty file ``_COMMITTED`` says that they are complete.
3. *Switch*: each race's old folder moves to ``<run>/old`` and its new one into its place.
4. *Remove*: the run's folder goes.

A run that ends before its commit leaves the table as it was; one that ends after it is
finished by the next ``replace_partitions`` or by ``recover``, which repeat the switch from wherever it stopped.
Rows never pass through the driver, only one folder name per race.  A table takes one replacing
run at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

JOURNAL = "_replacing"
COMMITTED = "_COMMITTED"
_THREADS = 16


class _Folder:
    """The few operations on the table's file system, whatever it is."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        p = self.path(path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def move(self, source: str, target: str) -> None:
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def make(self, path: str) -> None:
        self.fs.mkdirs(self.path(path))

    def touch(self, path: str) -> None:
        self.fs.create(self.path(path), True).close()

    def remove(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def replace_partitions(spark: SparkSession, path: str, write: Callable[[str], None], key: str = "raceId") -> list[str]:
    """Replace the ``key=`` folders that ``write`` makes; all others stay.  Returns the folders' names.

    ``write`` gets a fresh path and writes a table there, partitioned by ``key`` first.
    """
    path = path.rstrip("/")
    recover(spark, path, key)
    files, run = _Folder(spark, path), f"{path}/{JOURNAL}/{uuid.uuid4().hex}"
    try:
        write(f"{run}/new")
    except BaseException:
        files.remove(run)
        raise
    names = [n for n in files.names(f"{run}/new") if n.startswith(f"{key}=")]
    files.touch(f"{run}/{COMMITTED}")
    _switch(files, path, run, key)
    return names


def recover(spark: SparkSession, path: str, key: str = "raceId") -> int:
    """Finish committed runs that were interrupted, undo the others; returns how many were finished.

    Only when no run is replacing races in this table.
    """
    path = path.rstrip("/")
    files, finished = _Folder(spark, path), 0
    for name in files.names(f"{path}/{JOURNAL}"):
        run = f"{path}/{JOURNAL}/{name}"
        if files.exists(f"{run}/{COMMITTED}"):
            _switch(files, path, run, key)
            finished += 1
        else:
            files.remove(run)
    return finished


def _switch(files: _Folder, path: str, run: str, key: str) -> None:
    """Move every new folder into place; one that has left ``new`` is done."""
    files.make(f"{run}/old")

    def one(name: str) -> None:
        if files.exists(f"{path}/{name}") and not files.exists(f"{run}/old/{name}"):
            files.move(f"{path}/{name}", f"{run}/old/{name}")
        files.move(f"{run}/new/{name}", f"{path}/{name}")

    with ThreadPoolExecutor(max_workers=_THREADS) as pool:
        list(pool.map(one, [n for n in files.names(f"{run}/new") if n.startswith(f"{key}=")]))
    files.remove(run)
