"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_given_out: ContextVar[list[str] | None] = ContextVar("given_out", default=None)


def session(app: str = "riskweave", **conf: str) -> SparkSession:
    """A session with the settings the package relies on; `conf` adds to them."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="riskweave-")
    return _local_dirs[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/riskweave/{name}-{uuid.uuid4().hex}"
    paths = _given_out.get()
    if paths is not None:
        paths.append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end of the block, the scratch paths given out within it."""
    paths: list[str] = []
    token = _given_out.set(paths)
    try:
        yield
    finally:
        _given_out.reset(token)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system the path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(folder, True)


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below `path` that a Spark job has finished writing."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    return [
        f.getPath().getName()
        for f in fs.listStatus(top)
        if f.isDirectory() and fs.exists(done(f.getPath(), "_SUCCESS"))
    ]


def folders_below(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names of the folders below `path` and when they were last changed, in seconds."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    found = [f for f in fs.listStatus(top) if f.isDirectory()]
    return [(f.getPath().getName(), f.getModificationTime() / 1000) for f in found]


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files in a folder; none where it does not exist."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    return [f.getPath().toString() for f in fs.listStatus(top) if f.isFile()]


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a written table has any data file."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return False
    files = fs.listFiles(top, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder.

    Cuts the lineage durably: a lost executor re-reads the table instead of
    recomputing the plan, and values fixed at write time stay fixed.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
