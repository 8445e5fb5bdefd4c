"""Folders for intermediate tables that driver and executors share.

The folder is the one ``spark.checkpoint.dir`` names. Where it is unset, the
warehouse is used if somebody has set it, or if the master is local (tests). A
cluster without either is refused: its default warehouse is a folder of the
driver's machine, which executors cannot see.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, without a slash at its end."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and not context.getConf().contains("spark.sql.warehouse.dir"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete at the end all scratch paths made inside, but those taken off the list."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.remove(made)
        for path in made:
            remove(spark, path)
