"""Session factory and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Bytes of a row group of a table in the scratch folder.
ROW_GROUP = 16 * 2**20
# Scratch folders of local sessions that name none.
_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def object_store_conf(
    endpoint: str | None = None,
    region: str | None = None,
    credentials_provider: str | None = None,
    max_connections: int = 200,
    path_style: bool = False,
) -> dict[str, str]:
    """S3A settings for ``build_session``; credentials come from the provider, never from code."""
    conf = {
        "spark.hadoop.fs.s3a.fast.upload": "true",
        "spark.hadoop.fs.s3a.connection.maximum": str(max_connections),
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if region:
        conf["spark.hadoop.fs.s3a.endpoint.region"] = region
    if credentials_provider:
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = credentials_provider
    return conf


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_ROOTS[application]


def scratch_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return os.path.join(scratch_root(spark), "millrace", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the application's folder; no two calls give the same one."""
    return os.path.join(scratch_folder(spark), f"{label}-{uuid.uuid4().hex}")


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files and broadcasts of steps that nothing refers to any longer.

    Spark finds these when the driver's garbage is collected, which by itself may be half an hour away; a job of many written
    steps would hold the files of all of them until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Steps run inside send Python functions batches of at most ``most`` bytes, or one row.

    Spark's 64 MB a batch lie beside the heap twice, as Arrow's vectors and as the stream to the worker, and once more in the
    worker, for each task of an executor.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_scratch(df: DataFrame, path: str, codec: str = "snappy", wide: bool = False) -> None:
    """Write a table that is read again soon. A writer holds a row group in memory, so these are small.

    Its size is looked at every hundred rows, or after each if they are ``wide``.
    """
    checks = {"parquet.page.size.row.check.min": 1} if wide else {}
    df.write.options(**checks).option("parquet.block.size", ROW_GROUP).option("compression", codec).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove settled tables that nothing reads any longer, as all that was made from them is settled itself."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if scratch_folder(spark).split("://")[-1].split(":")[-1] not in folder:
                raise ValueError(f"{folder} is not a scratch folder of this application")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str = "settled", codec: str = "snappy", wide: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table; ``wide`` rows have some megabytes each.

    Used where later steps must all see one and the same evaluation, and where recomputing after
    a lost executor would cost the whole upstream plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    write_scratch(df, path, codec, wide)
    return spark.read.schema(df.schema).parquet(path)
