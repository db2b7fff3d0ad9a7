"""Written intermediate tables.

A scratch table cuts lineage and freezes a partitioning or a set of rows: it lives in
the shared folder the cluster names in ``spark.checkpoint.dir``, so a lost executor
costs a re-read, never a different answer.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_LOCAL: list[str] = []
_SCOPE = threading.local()


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="tremorlake-"))
        root = _LOCAL[0]
    return f"{root.rstrip('/')}/tremorlake-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    folder = getattr(_SCOPE, "folder", None) or scratch_root(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, none if it does not exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside are deleted at the end: for a batch whose results are stored
    by then, so that a long-running stream leaves none behind."""
    outer = getattr(_SCOPE, "folder", None)
    _SCOPE.folder = scratch_path(spark, "scope")
    try:
        yield
    finally:
        delete_path(spark, _SCOPE.folder)
        _SCOPE.folder = outer


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables, once no plan needs them."""
    delete_path(spark, scratch_root(spark))
