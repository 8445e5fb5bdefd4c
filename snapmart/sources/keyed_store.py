"""A store of rows by key, in a fixed number of hash buckets.

* :func:`append_unseen` (R4, R6, R9): rows whose keys the store does not hold.
  Only the buckets that the incoming keys fall into are read, and of them only
  the key columns; the rows come in as new files of these buckets.
* :func:`replace_keys` (R7): the rows of the incoming keys are replaced, the
  other keys stay. Only the buckets of these keys are rewritten.
* :func:`merge_latest` (M2): the store holds the latest rows per key; a new
  snapshot is merged into the buckets of its keys, and no history is read.

The number of folders is that of the buckets, however many keys there are.
Every change is one new version (:mod:`snapmart.sources.versions`): readers see
all of it or nothing, and a change that was killed can be run again. Appends
and merges under a ``stream`` name keep the number of their last batch in the
same manifest, so a batch that is delivered twice is applied once.

A NULL in a key column makes a row unusable for an append (it counts as
failed); for a replacement NULL is a key like any other; a merge drops rows
with a NULL key or a NULL date, which are in no current view.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..operators.latest import latest_per_key
from . import versions
from .documents import SOURCE_PATH
from .landing import one_per_key

#: Buckets of a new store; a store keeps its number.
BUCKETS = 64
#: Append files of one bucket before it is rewritten as one.
MOST_FILES = 16
BUCKET = "_bucket"
CORRUPT = "_corrupt_record"


def bucket_of(keys: list[str], n_buckets: int) -> Column:
    """0 to ``n_buckets - 1`` of a key; NULL keys have a bucket too."""
    return F.pmod(F.xxhash64(*keys, *[F.isnull(k) for k in keys]), F.lit(n_buckets)).cast("int")


def _paths(root: str, manifest: dict, buckets: list[int] | None = None) -> list[str]:
    held = manifest.get("buckets", {})
    chosen = sorted(held, key=int) if buckets is None else [str(b) for b in sorted(buckets)]
    return [posixpath.join(root, p) for b in chosen for p in held.get(b, [])]


def read_keyed(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows of the newest version, or None before the first one."""
    _, manifest = versions.head(spark, root)
    paths = _paths(root, manifest) if manifest else []
    if not paths:
        return None
    return spark.read.schema(manifest["schema"]).parquet(*paths)


def rows_of_keys(spark: SparkSession, root: str, wanted: DataFrame, keys: list[str]) -> DataFrame | None:
    """The stored keys that may equal ``wanted`` ones: key columns of their buckets only."""
    _, manifest = versions.head(spark, root)
    return _held_keys(spark, root, manifest, _touched(wanted, keys, manifest["n_buckets"]), keys) if manifest else None


def _touched(df: DataFrame, keys: list[str], n_buckets: int) -> list[int]:
    """Buckets that the keys fall into: at most ``n_buckets`` numbers."""
    return [r[0] for r in df.select(bucket_of(keys, n_buckets).alias(BUCKET)).distinct().collect()]


def _held_keys(spark: SparkSession, root: str, manifest: dict, buckets: list[int], keys: list[str]) -> DataFrame | None:
    paths = _paths(root, manifest, buckets)
    return spark.read.schema(manifest["schema"]).parquet(*paths).select(*keys) if paths else None


def _start(spark: SparkSession, root: str, df: DataFrame, n_buckets: int) -> tuple[int, dict]:
    base, manifest = versions.head(spark, root)
    if manifest is None:
        manifest = {"n_buckets": n_buckets, "schema": _nullable_ddl(df), "buckets": {}, "streams": {}}
    elif manifest["schema"] != _nullable_ddl(df):
        raise ValueError(f"{root} holds {manifest['schema']}, not {_nullable_ddl(df)}")
    return base, manifest


def _nullable_ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _write(df: DataFrame, root: str, keys: list[str], n_buckets: int) -> str:
    """Write ``df`` by bucket into a folder of its own; large buckets are split over tasks."""
    folder = versions.new_folder()
    dealt = df.withColumn(BUCKET, bucket_of(keys, n_buckets)).hint("rebalance", BUCKET)
    dealt.write.partitionBy(BUCKET).parquet(posixpath.join(root, folder))
    return folder


def _written(spark: SparkSession, root: str, folder: str) -> list[int]:
    """Buckets that a write has made."""
    fs, path = versions._open(spark, posixpath.join(root, folder))
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return [int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")]


def append_unseen(
    incoming: DataFrame,
    root: str,
    keys: list[str],
    prefer: str = SOURCE_PATH,
    n_buckets: int = BUCKETS,
    stream: str | None = None,
    batch_id: int | None = None,
) -> dict[str, int]:
    """Append the rows whose keys the store does not hold; returns ``new, skipped, failed``.

    A key that ``incoming`` holds several times comes in once, from the
    greatest ``prefer``. Rows with a NULL key or a corrupt record fail. With
    ``stream`` and ``batch_id`` a batch that was applied before does nothing.
    Counts are those of whole results: of one aggregate and of the files of the
    published version.
    """
    spark = incoming.sparkSession
    clean = incoming.drop(CORRUPT)
    base, manifest = _start(spark, root, clean, n_buckets)
    done = manifest["streams"].get(stream) if stream is not None else None
    if done is not None and done["batch"] >= batch_id:
        return done["counts"] if done["batch"] == batch_id else {"new": 0, "skipped": 0, "failed": 0}
    bad = F.lit(False)
    for k in keys:
        bad = bad | F.col(k).isNull()
    if CORRUPT in incoming.columns:
        bad = bad | F.col(CORRUPT).isNotNull()
    # One run's delta; Spark also asks for this where a corrupt record is read.
    parsed = incoming.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = parsed.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("failed")).first()
        fresh = one_per_key(parsed.where(~bad).select(*clean.columns), keys, prefer)
        held = _held_keys(spark, root, manifest, _touched(parsed.where(~bad), keys, manifest["n_buckets"]), keys)
        if held is not None:
            fresh = fresh.join(held, on=keys, how="left_anti")
        folder = _write(fresh.select(*clean.columns), root, keys, manifest["n_buckets"])
    finally:
        parsed.unpersist()
    buckets = _written(spark, root, folder)
    new = spark.read.parquet(*[posixpath.join(root, folder, f"{BUCKET}={b}") for b in buckets]).count() if buckets else 0
    counts = {"new": new, "skipped": total["n"] - total["failed"] - new, "failed": total["failed"]}
    after = dict(manifest["buckets"])
    for b in buckets:
        after[str(b)] = [*after.get(str(b), []), f"{folder}/{BUCKET}={b}"]
    streams = manifest["streams"] | ({stream: {"batch": batch_id, "counts": counts}} if stream is not None else {})
    versions.publish(spark, root, manifest | {"buckets": after, "streams": streams}, base)
    return counts


def replace_keys(df: DataFrame, root: str, keys: list[str], n_buckets: int = BUCKETS) -> None:
    """Replace the rows of the keys in ``df``; other keys stay as they are."""
    spark = df.sparkSession
    base, manifest = _start(spark, root, df, n_buckets)
    touched = _touched(df, keys, manifest["n_buckets"])
    rows = df
    paths = _paths(root, manifest, touched)
    if paths:
        new_keys = df.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
        kept = spark.read.schema(manifest["schema"]).parquet(*paths).join(new_keys, same, "left_anti")
        rows = kept.unionByName(df)
    _rewrite(rows, root, keys, base, manifest, touched)


def merge_latest(
    snapshot: DataFrame,
    root: str,
    keys: list[str],
    order_col: str,
    n_buckets: int = BUCKETS,
    stream: str | None = None,
    batch_id: int | None = None,
) -> bool:
    """Merge ``snapshot`` into a store of the latest rows per key.

    After any number of merges the store equals
    :func:`~snapmart.operators.latest.latest_per_key` over all that was merged,
    in whatever order it came: a late, older row loses against the stored ones,
    a row of the stored date is a tie and stays beside them, and a key that the
    snapshot does not hold keeps its rows. Only the buckets that hold the
    snapshot's keys are read and rewritten, so the work follows the snapshot
    and the state of its buckets, never the history.

    With ``stream`` and ``batch_id`` a batch that was applied before does
    nothing; returns whether the batch was applied.
    """
    spark = snapshot.sparkSession
    base, manifest = _start(spark, root, snapshot, n_buckets)
    done = manifest["streams"].get(stream) if stream is not None else None
    if done is not None and done["batch"] >= batch_id:
        return False
    present = F.col(order_col).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    fresh = snapshot.where(present)
    touched = _touched(fresh, keys, manifest["n_buckets"])
    paths = _paths(root, manifest, touched)
    if paths:
        fresh = spark.read.schema(manifest["schema"]).parquet(*paths).unionByName(fresh)
    streams = manifest["streams"] | ({stream: {"batch": batch_id}} if stream is not None else {})
    _rewrite(latest_per_key(fresh, keys, order_col).select(*snapshot.columns), root, keys, base, manifest | {"streams": streams}, touched)
    return True


def _rewrite(rows: DataFrame, root: str, keys: list[str], base: int, manifest: dict, touched: list[int]) -> None:
    """Publish a version in which ``rows`` are all rows of the ``touched`` buckets."""
    spark = rows.sparkSession
    folder = _write(rows, root, keys, manifest["n_buckets"])
    after = {b: p for b, p in manifest["buckets"].items() if int(b) not in touched}
    after |= {str(b): [f"{folder}/{BUCKET}={b}"] for b in _written(spark, root, folder)}
    versions.publish(spark, root, manifest | {"buckets": after}, base)


def compact(spark: SparkSession, root: str, keys: list[str], most: int = MOST_FILES) -> int:
    """Rewrite buckets that appends have cut into more than ``most`` folders; returns how many."""
    base, manifest = versions.head(spark, root)
    many = [int(b) for b, p in (manifest or {}).get("buckets", {}).items() if len(p) > most]
    if not many:
        return 0
    rows = spark.read.schema(manifest["schema"]).parquet(*_paths(root, manifest, many))
    folder = _write(rows, root, keys, manifest["n_buckets"])
    after = manifest["buckets"] | {str(b): [f"{folder}/{BUCKET}={b}"] for b in _written(spark, root, folder)}
    versions.publish(spark, root, manifest | {"buckets": after}, base)
    return len(many)
