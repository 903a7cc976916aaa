"""Written tables that cut lineage; they live in the shared folder the session names."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_scopes: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, read from the session."""
    context = spark.sparkContext
    root = context.getConf().get(CHECKPOINT_DIR) or context.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="regiobank-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody used before."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _scopes:
        paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove everything that is staged within the block at its end; results must have been written by then."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        files = spark._jvm.org.apache.hadoop.fs
        for path in paths:
            place = files.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and go on from the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
