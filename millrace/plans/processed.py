"""Processed ids as intervals: an id that appears late, below the largest one seen, is still taken up.

A source numbers its rows, but rows become visible in another order than their numbers: transactions that began earlier commit
later. All ids up to the last one count as processed but for the gaps that were open when they were passed. A gap is
looked at again by each run until its rows have come or it has been open for ``patience`` runs.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregates import running_max
from millrace.plans.incremental import retry
from millrace.session import settle
from millrace.sinks.files import path_exists, replace_partitions

log = logging.getLogger(__name__)

GAPS = "lo bigint, hi bigint, since bigint"
STORED = f"source string, slot int, version bigint, last_id bigint, {GAPS}"


@dataclass
class Progress:
    """How far a source has come: the number of the commit, the last id, and the gaps below it with the commit that saw them first."""

    version: int
    last_id: int
    gaps: DataFrame


class ProcessedIds:
    """The progress of each source, in two slots written by turns: a commit replaces the older one, so what it was made from
    stays until it is there, and the number of files does not grow with the commits. For one writer per source."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self, source: str) -> Progress:
        if path_exists(self.spark, self.path):
            rows = self.spark.read.schema(STORED).parquet(self.path).filter(F.col("source") == source)
            # The row without a gap stands for the commit itself.
            newest = rows.filter("lo IS NULL").orderBy(F.col("version").desc()).first()
            if newest:
                gaps = rows.filter((F.col("slot") == newest["slot"]) & F.col("lo").isNotNull()).select("lo", "hi", "since")
                return Progress(newest["version"], newest["last_id"], gaps)
        return Progress(0, 0, self.spark.createDataFrame([], GAPS))

    def commit(self, source: str, progress: Progress) -> None:
        own = self.spark.createDataFrame([(None, None, None)], GAPS)
        rows = own.unionByName(progress.gaps.select("lo", "hi", "since")).withColumns(
            {
                "source": F.lit(source),
                "slot": F.lit(progress.version % 2),
                "version": F.lit(progress.version).cast("bigint"),
                "last_id": F.lit(progress.last_id).cast("bigint"),
            }
        )
        replace_partitions(rows, self.path, ["source", "slot"])


def _marks(gaps: DataFrame) -> DataFrame:
    """The ends of gaps on a scale of half steps, where an id lies at twice its value."""
    start = F.struct((F.col("lo") * 2 - 1).alias("place"), F.lit(1).alias("kind"), F.struct("lo", "hi", "since").alias("gap"))
    stop = F.struct((F.col("hi") * 2 + 1).alias("place"), F.lit(0).alias("kind"), F.lit(None).cast(f"struct<{GAPS}>").alias("gap"))
    # Where one gap ends and the next begins, the end comes first.
    return gaps.select(F.inline(F.array(start, stop)))


def rows_in_gaps(rows: DataFrame, gaps: DataFrame, id_column: str) -> DataFrame:
    """The rows whose id lies in one of the disjoint ``gaps`` (lo, hi, since), without forming pairs.

    Rows and gaps are put in one order; a row lies in the last gap that begins before it, or in none.
    """
    ends = gaps.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    if ends["lo"] is None:
        return rows.limit(0)
    # The range is pushed into the scan: gaps that are given up let it move on.
    near = rows.filter(F.col(id_column).between(ends["lo"], ends["hi"]))
    payload = F.struct(*rows.columns)
    points = near.select((F.col(id_column) * 2).cast("bigint").alias("place"), F.lit(2).alias("kind"), payload.alias("row"))
    begun = gaps.select((F.col("lo") * 2 - 1).alias("place"), F.lit(1).alias("kind"), F.col("hi").alias("until"))
    both = settle(points.unionByName(begun, allowMissingColumns=True).withColumn("n", F.monotonically_increasing_id()), "near")
    reached = running_max(both, ["place", "kind", "n"], {"reach": "until"})
    return reached.filter(F.col("row").isNotNull() & (F.col("place") <= 2 * F.col("reach"))).select("row.*")


def gaps_left(gaps: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """What is left of disjoint ``gaps`` (lo, hi, since) when the ``ids`` inside of them have come."""
    points = ids.select((F.col(id_column) * 2).cast("bigint").alias("place")).distinct()
    points = points.select("place", F.lit(2).alias("kind"), F.lit(None).cast(f"struct<{GAPS}>").alias("gap"))
    line = settle(_marks(gaps).unionByName(points), "line")
    # The predecessor of an id or an end is an id or the start of its gap.
    seen = running_max(line, ["place", "kind"], {"behind": "place", "began": F.struct("gap.lo", "gap.since")}, earlier=True)
    inner = seen.filter("kind <> 1")
    left = inner.select(
        F.floor(F.col("behind") / 2 + 1).cast("bigint").alias("lo"),
        F.ceil(F.col("place") / 2 - 1).cast("bigint").alias("hi"),
        F.col("began.since").alias("since"),
    )
    return left.filter("lo <= hi")


@dataclass
class CompleteJob:
    """Batches over a numbered table in which each id counts once, whenever it appears within the patience.

    ``process`` gets the rows of new ids, as they were read once, and must have stored its result when it returns; it must
    be repeatable, as a batch whose commit failed comes again. ``patience`` counts runs.
    """

    source: str
    rows: Callable[[], DataFrame]
    done: ProcessedIds
    process: Callable[[DataFrame], None]
    id_column: str = "txn_id"
    patience: int = 10

    def run_once(self) -> int:
        """Process what is past the last id or in an open gap; returns the number of rows."""
        state = self.done.read(self.source)
        gaps = settle(state.gaps, "gaps")
        column = F.col(self.id_column)
        late = rows_in_gaps(self.rows(), gaps, self.id_column)
        # Written once, so that the ids that are committed are those of the rows that were processed.
        batch = settle(late.unionByName(self.rows().filter(column > state.last_id)), "batch")
        found = batch.agg(F.count("*").alias("n"), F.max(self.id_column).alias("last")).first()
        version = state.version + 1
        last = max(state.last_id, found["last"] or state.last_id)
        if found["n"]:
            self.process(batch)
            passed = batch.sparkSession.createDataFrame([(state.last_id + 1, last, version)], GAPS).filter("lo <= hi")
            gaps = settle(gaps_left(gaps.unionByName(passed), batch, self.id_column), "gaps")
        kept = gaps.filter(F.col("since") > version - self.patience)
        retry(lambda: self.done.commit(self.source, Progress(version, last, kept)))
        return found["n"]

    def on_batch(self, _ticks: DataFrame, _batch_id: int) -> None:
        """For ``foreachBatch`` on a rate stream that only sets the pace."""
        self.run_once()
