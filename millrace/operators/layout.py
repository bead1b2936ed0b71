"""Tables laid out for their joins: bucketed and sorted by key once, joined and grouped without moving rows again."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from millrace.session import scratch_path


def lay_out(df: DataFrame, keys: Sequence[str], buckets: int, name: str | None = None, path: str | None = None) -> DataFrame:
    """``df`` as a table in ``buckets`` buckets by ``keys``, each one sorted file, read back from the catalog.

    The rows are dealt out as the buckets are, so a task writes one bucket and not a file in each. Tables of one number
    of buckets and one type of keys lie side by side. A bucket is a task of every later join: choose as many as keep the largest
    key's rows, and leave a table whose keys are very uneven to ``skew.balanced_join``. Stored under
    ``path``, by default in the application's scratch folder.
    """
    name = name or f"laid_out_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path or scratch_path(df.sparkSession, name)).saveAsTable(name)
    return df.sparkSession.table(name)


def join_laid_out(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join of two tables laid out by ``keys``: bucket meets bucket, and neither side is moved or sent to all."""
    return left.hint("merge").join(right, list(keys), how)
