"""Offset-driven incremental jobs: read past the offset, process, write, then move the offset."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sinks.files import data_files, delete_path, path_exists
from millrace.sources.external import probe

log = logging.getLogger(__name__)

OFFSETS = "source string, last_id bigint"
# Commits that may lie beside each other before they are put together.
LOOSE_COMMITS = 50


class OffsetTable:
    """The last processed id per source. Each commit appends a row and the largest one counts, so
    an offset never moves back and two writers cannot undo each other. Every so often the commits are
    put together in one file, before those it was made from go, so readers always find the largest."""

    def __init__(self, spark: SparkSession, path: str, loose: int = LOOSE_COMMITS):
        self.spark = spark
        self.path = path
        self.loose = loose

    def all(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], OFFSETS)
        commits = self.spark.read.schema(OFFSETS).parquet(self.path)
        return commits.groupBy("source").agg(F.max("last_id").alias("last_id"))

    def read(self, source: str) -> int:
        found = self.all().filter(F.col("source") == source).first()
        return found["last_id"] if found else 0

    def commit(self, offsets: DataFrame) -> None:
        """``offsets``: one row per source."""
        offsets.select("source", "last_id").coalesce(1).write.mode("append").parquet(self.path)
        self.compact()

    def compact(self) -> None:
        """Put the commits together if there are more than ``loose`` files of them."""
        files = data_files(self.spark, self.path)
        if len(files) <= self.loose:
            return
        found = self.spark.read.schema(OFFSETS).parquet(*files).groupBy("source").agg(F.max("last_id").alias("last_id"))
        found.coalesce(1).write.mode("append").parquet(self.path)
        for file in files:
            delete_path(self.spark, file)

    def advance(self, source: str, last_id: int) -> None:
        self.commit(self.spark.createDataFrame([(source, last_id)], OFFSETS))


def retry(action: Callable[[], None], attempts: int = 3, wait_seconds: float = 0.2) -> None:
    """Run ``action``; after a failure wait ``attempt × wait_seconds`` and try again."""
    for attempt in range(1, attempts + 1):
        try:
            action()
            return
        except Exception:
            if attempt == attempts:
                raise
            time.sleep(wait_seconds * attempt)


@dataclass
class IncrementalJob:
    """At-least-once batches over an id-ordered table; with a repeatable ``process`` each id
    counts once. ``process`` gets the new rows and must have stored its result when it returns.

    A row whose id appears only after a larger id was committed is not seen again; ``processed.CompleteJob`` takes it up.
    """

    source: str
    rows: Callable[[], DataFrame]
    offsets: OffsetTable
    process: Callable[[DataFrame], None]
    id_column: str = "txn_id"
    # For test runs only: move the offset although the rows were not stored.
    force_commit: bool = False

    def run_once(self) -> int:
        """Process what lies past the offset; returns the number of new rows."""
        start = self.offsets.read(self.source)
        found = probe(self.rows(), self.id_column, start).first()
        if found["n"] == 0:
            return 0
        # The batch ends at the probed id, so rows that arrive meanwhile wait for the next one.
        batch = self.rows().filter(F.col(self.id_column).between(start + 1, found["max_id"]))
        try:
            self.process(batch)
        except Exception:
            if not self.force_commit:
                raise
            log.exception("batch of %s failed, its offset moves on by request", self.source)
        retry(lambda: self.offsets.advance(self.source, found["max_id"]))
        return found["n"]

    def on_batch(self, _ticks: DataFrame, _batch_id: int) -> None:
        """For ``foreachBatch`` on a rate stream that only sets the pace."""
        self.run_once()
