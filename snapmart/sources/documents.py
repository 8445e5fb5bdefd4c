"""Raw JSON documents: one object per file, found by a glob under a root.

* Every read has an explicit schema, ``multiLine`` (a file is one value,
  pretty-printed or not) and ``FAILFAST``.
* The file path is a column (``source_path``, from ``_metadata.file_path``),
  and keys in the path are cut from its end, so any root works: a local
  folder, ``s3a://bucket/prefix`` or any Hadoop file system.
* Files are unsplittable but small; Spark packs many into one task
  (``spark.sql.files.openCostInBytes``). A store that grows every day is
  taken in once as Parquet by the landing jobs and the incremental stream.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import path_part
from ..schemas import DOC_SCHEMAS, LAYOUT

SOURCE_PATH = "source_path"


def doc_glob(raw_root: str, kind: str) -> str:
    return posixpath.join(raw_root.rstrip("/"), LAYOUT[kind])


def read_documents(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Documents at ``path`` (a glob) with ``schema``, plus ``source_path``.

    ``multi_line=False`` is for files with one document per line, which are split.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .json(path)
        .withColumn(SOURCE_PATH, F.col("_metadata.file_path"))
    )


def read_kind(spark: SparkSession, raw_root: str, kind: str) -> DataFrame:
    """One document kind of the raw store (standings, rosters, ...)."""
    return read_documents(spark, doc_glob(raw_root, kind), DOC_SCHEMAS[kind])


def path_key(from_end: int):
    """Column: path segment ``from_end`` of the document's path."""
    return path_part(F.col(SOURCE_PATH), from_end)


def object_store_conf(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    ssl: bool = False,
    path_style: bool = True,
) -> dict[str, str]:
    """Hadoop S3A settings for an S3-compatible store, for the session builder.

    The reference points its engine at an endpoint with keys, no SSL and
    path-style URLs; these are the same four choices. Pass the result as
    ``extra_conf`` to :func:`snapmart.session.build_session` and use
    ``s3a://bucket/...`` as ``raw_root``. Needs the hadoop-aws jars on the
    cluster.
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
    if access_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key is not None:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf
