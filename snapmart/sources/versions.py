"""Versions of a stored table: data folders, and small numbered manifests that name them.

A write puts its files into a new folder under ``data/`` and then publishes
a manifest ``_versions/<number>.json``, created only if that number is still
free. Readers follow the manifest of the greatest number that is whole. So a
write that is killed leaves the version before it readable, and two writers that
start from one version cannot both publish: the second one gets
:class:`VersionConflict`. Files of a store that only Spark can open are reached
through Hadoop's file system, on the driver; manifests hold folder names, no rows.

Folders named only by manifests older than the last ``KEEP`` are deleted when a
new one is published, so a frame that was read before it still finds its files.
"""

from __future__ import annotations

import json
import posixpath
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

VERSIONS = "_versions"
DATA = "data"
#: Versions whose files stay.
KEEP = 2


class VersionConflict(RuntimeError):
    """Another writer has published from the same version."""


def _open(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _open(spark, posixpath.join(root, VERSIONS))
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest_path(root: str, number: int) -> str:
    return posixpath.join(root, VERSIONS, f"{number:012d}.json")


def _read_manifest(spark: SparkSession, root: str, number: int) -> dict | None:
    """The manifest, or None if its writer did not finish it."""
    fs, path = _open(spark, _manifest_path(root, number))
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def head(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """Greatest number in use, and the newest whole manifest (None: no version yet)."""
    numbers = _numbers(spark, root)
    for n in reversed(numbers):
        found = _read_manifest(spark, root, n)
        if found is not None:
            return numbers[-1], found
    return (numbers[-1] if numbers else 0), None


def new_folder() -> str:
    """A data folder of its own for one write, relative to the table's root."""
    return f"{DATA}/{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, manifest: dict, base: int) -> int:
    """Make ``manifest`` version ``base + 1``; fails if that version exists."""
    fs, path = _open(spark, _manifest_path(root, base + 1))
    try:
        stream = fs.create(path, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception):
            raise VersionConflict(f"{root}: version {base + 1} exists") from e
        raise
    try:
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    finally:
        stream.close()
    _collect(spark, root)
    return base + 1


def folders_of(manifest: dict) -> list[str]:
    """All data paths a manifest names, relative to the root."""
    return [*manifest.get("folders", []), *(p for ps in manifest.get("buckets", {}).values() for p in ps)]


def _collect(spark: SparkSession, root: str) -> None:
    """Delete what only versions older than the last ``KEEP`` name."""
    numbers = _numbers(spark, root)
    kept = {p for n in numbers[-KEEP:] for p in folders_of(_read_manifest(spark, root, n) or {})}
    for n in numbers[:-KEEP]:
        for folder in set(folders_of(_read_manifest(spark, root, n) or {})) - kept:
            fs, path = _open(spark, posixpath.join(root, folder))
            fs.delete(path, True)
        fs, path = _open(spark, _manifest_path(root, n))
        fs.delete(path, False)
