"""Tables and files that one plan writes for the next, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; below a temporary one only where all tasks run in this process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="gapwright-")
    return f"{base.rstrip('/')}/gapwright-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """df written once and read again, so that what several branches use is computed once and outlives lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_at = path
    if _scopes:
        _scopes[-1][path] = df.sparkSession
    return out


_scopes: list[dict[str, SparkSession]] = []


def dropped(*tables: DataFrame) -> None:
    """Delete kept tables that nothing reads any more (others are left alone)."""
    for df in tables:
        if hasattr(df, "kept_at"):
            _delete(df.sparkSession, df.kept_at)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def only():
    """Within it, kept tables are written; at its end those are deleted that weren't put into the list it gives."""
    held: list[DataFrame] = []
    _scopes.append({})
    try:
        yield held
    finally:
        made = _scopes.pop()
        stay = {df.kept_at for df in held if hasattr(df, "kept_at")}
        for path, spark in made.items():
            if path not in stay:
                _delete(spark, path)
            elif _scopes:
                _scopes[-1][path] = spark
