"""The driver's Parquet tables, read lazily so Catalyst prunes columns and
pushes filters into each scan.

Every call lists the files anew, so a table that has grown is read whole.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table as a DataFrame; nothing is read until an action runs."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_all(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register every table as a temp view, for ``spark.sql`` use."""
    for name in names:
        path = table_path(sf_dir, name)
        if os.path.exists(path) or "://" in path:
            load(spark, sf_dir, name).createOrReplaceTempView(name)
