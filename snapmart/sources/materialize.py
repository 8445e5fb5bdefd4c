"""Materializations: a stored table (drop and rebuild), a view (kept as a
query) and reading a model by name.

Tables are Parquet folders under one warehouse root. Writing a table also
cuts the lineage: the next model reads the stored files, so a lost executor
recomputes from there, not from the raw documents.

A rebuild writes a folder of its own and then publishes it
(:mod:`snapmart.sources.versions`): readers see the old table or the new one,
never a part, and a build killed midway leaves every model readable. A model
may be rebuilt from itself.

Measures (Q2, Q3, R9) are aggregates that the write itself computes over the rows
it stores, through ``Dataset.observe``; they are published in the same
manifest, so they always belong to the rows a reader sees. They are taken in the
stage that writes, after any shuffle, where Spark counts each partition of a
finished task once: a task that is run again adds nothing.
"""

from __future__ import annotations

import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from . import versions


def table_path(warehouse: str, name: str) -> str:
    return posixpath.join(warehouse.rstrip("/"), name)


def write_table(
    df: DataFrame,
    warehouse: str,
    name: str,
    partition_by: list[str] | None = None,
    sort_within: list[str] | None = None,
    measures: dict[str, Column] | None = None,
) -> str:
    """``materialized='table'``: overwrite the table with ``df``.

    A partitioned table is written after a ``rebalance`` on its partition
    columns: each task then writes few partition folders, so the table is
    not cut into tasks x partitions small files, and adaptive execution
    splits a partition value holding much of the data over several tasks.
    ``sort_within`` sorts rows inside each file (no global sort), which
    tightens Parquet min/max statistics for filters on those columns.
    ``measures`` are aggregates by name, read back by :func:`measured`.
    """
    root, folder = table_path(warehouse, name), versions.new_folder()
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    seen = Observation() if measures else None
    if seen is not None:
        df = df.observe(seen, *[c.alias(name) for name, c in measures.items()])
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(posixpath.join(root, folder))
    manifest = {"folders": [folder]} | ({"measured": dict(seen.get)} if seen is not None else {})
    while True:
        base, _ = versions.head(df.sparkSession, root)
        try:
            versions.publish(df.sparkSession, root, manifest, base)
        except versions.VersionConflict:
            continue  # another rebuild was published meanwhile; the later one holds
        return root


def read_table(spark: SparkSession, warehouse: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """``ref('name')``: the stored table, columns in ``columns`` order if given
    (a partitioned table puts its partition columns last on read)."""
    df = read_stored(spark, table_path(warehouse, name))
    return df.select(*columns) if columns else df


def measured(spark: SparkSession, warehouse: str, name: str) -> dict[str, int]:
    """The measures of the newest version of a stored table; empty without any."""
    _, manifest = versions.head(spark, table_path(warehouse, name))
    return (manifest or {}).get("measured", {})


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the table at ``path``, or the plain Parquet folder."""
    _, manifest = versions.head(spark, path)
    if manifest is None:
        return spark.read.parquet(path)
    return spark.read.parquet(*[posixpath.join(path, f) for f in versions.folders_of(manifest)])


def read_if_built(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table at ``path``, or None when there is none.

    Only a missing path counts as absent; a folder that cannot be read fails.
    """
    try:
        return read_stored(spark, path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``materialized='view'``: a named query, evaluated when read."""
    df.createOrReplaceTempView(name)
    return df
