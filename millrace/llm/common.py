"""What the operators share: words, folds, tables and null-safe keys."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run without ASCII white space; bytes.split() cuts in the same places.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

# Documents a Python function holds in parsed form at a time.
DOCUMENTS = 256


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = DOCUMENTS) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows, none of them empty; their memory goes back at the end."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks, and would keep what a task needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on batches, and after its end, when nothing it held is left, ``give_back``."""

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        give_back()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_fold(column: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string")) % folds


def words_of(text: str | Column) -> Column:
    """The words of a text as an array; null and empty texts have none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def text_check(text: str | Column) -> Column:
    """crc32 of a text, which tells texts of one doc_id apart; a null text counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.crc32(F.coalesce(text.cast("string"), F.lit("")))
