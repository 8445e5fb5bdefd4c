"""snapmart: snapshot-to-mart analytics on Spark.

Nested JSON documents (dated snapshots, one file per game) are typed,
unnested and kept as history; the latest rows per key feed two dimensions
and one wide fact table with many role joins to the same dimension.
Reports, data-quality checks and incremental landing sit on top.

Everything is DataFrame code over built-in functions; no Python UDF runs in
any hot path.
"""

__all__ = ["session", "tables", "schemas"]
