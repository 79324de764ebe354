"""Written copies in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_lake.workspace import discard, scratch


#: Rows that go to a Python worker at once. Whole texts and sets of shingles are large rows.
BATCH_ROWS = 1000


#: While a copy is written, batches between Spark and Python are small, and so is the memory that both
#: sides hold them in; and its shuffle files go as soon as it is complete, not when the driver's memory
#: is next collected.
WRITING = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in WRITING}
    for key, value in WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


#: Copies that lazy results of this process still read, in the order they were written.
KEPT: list[str] = []


def release(spark: SparkSession, paths: list[str]) -> None:
    """Remove kept copies once the results that read them are written."""
    for path in paths:
        if path in KEPT:
            KEPT.remove(path)
            discard(spark, path)


@atexit.register
def _release_at_exit() -> None:
    """What no caller released goes with the program, while its session still runs."""
    session = SparkSession.getActiveSession()
    if session is None or session.sparkContext._jsc is None:
        return
    for path in list(KEPT):
        try:
            release(session, [path])
        except (Py4JError, OSError, ValueError, RuntimeError):  # the session is already going, or was another one
            return


class Staging:
    """Copies written by one operator call. ``keep`` marks those its lazy result still reads."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self._paths: dict[int, str] = {}
        self._kept: set[str] = set()

    def write(self, frame: DataFrame, keep: bool = False) -> DataFrame:
        path = scratch(self.spark, self.label)
        try:
            with writing(self.spark):
                frame.write.option("compression", "zstd").parquet(path)
        except BaseException:
            discard(self.spark, path)
            raise
        back = self.spark.read.parquet(path)
        self._paths[id(back)] = path
        back._staged_path = path
        if keep:
            self._kept.add(path)
        return back

    def drop(self, *frames: DataFrame) -> None:
        """Remove copies that nothing reads any more."""
        for frame in frames:
            path = getattr(frame, "_staged_path", None)
            if path and path in self._paths.values():
                self._paths = {k: v for k, v in self._paths.items() if v != path}
                discard(self.spark, path)

    def close(self, failed: bool) -> None:
        for path in list(self._paths.values()):
            if failed or path not in self._kept:
                discard(self.spark, path)
            else:
                KEPT.append(path)
        self._paths = {}


@contextmanager
def staging(spark: SparkSession, label: str) -> Iterator[Staging]:
    """On success everything but the kept copies goes; on failure everything goes."""
    area = Staging(spark, label)
    try:
        yield area
    except BaseException:
        area.close(failed=True)
        raise
    area.close(failed=False)


#: Largest number of keys that are sent to every task instead of shuffling the other side.
BROADCAST_KEYS = 1_000_000


def semi_by_key(frame: DataFrame, keys: DataFrame, on: list[str], limit: int = BROADCAST_KEYS) -> DataFrame:
    """Rows of ``frame`` whose key occurs in the staged ``keys`` (distinct; nulls equal nulls).

    Up to ``limit`` keys (counted first) travel to the rows; beyond, both sides are shuffled.
    """
    named = keys.select(*[F.col(c).alias(f"__key_{c}") for c in on])
    side = F.broadcast(named) if keys.count() <= limit else named
    condition = None
    for c in on:
        same = frame[c].eqNullSafe(named[f"__key_{c}"])
        condition = same if condition is None else condition & same
    return frame.join(side, condition, "left_semi")
