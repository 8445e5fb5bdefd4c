"""Small document frames with the edge cases every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents from ``(doc_id, text, source)`` rows."""
    full = [(i, t, None, s, None if t is None else len(t)) for i, t, s in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


#: Nulls, empty and blank texts, repeats, ties and a very long text.
EDGE_ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "a"),
    (1, "alpha beta gamma delta epsilon zeta", "a"),
    (2, None, "a"),
    (3, "", None),
    (None, "lone words here", "b"),
    (None, None, None),
    (4, " \t\n ", "b"),
    (5, "one", "c"),
    (6, "long " * 30_000, "c"),
    (7, "Übung macht élève \U0001f600   end", "c"),
]


def with_clashing_columns(docs: DataFrame) -> DataFrame:
    """Extra columns under names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["size", "score", "key", "label", "kind", "part", "grp", "ids", "cls", "words", "target", "copies", "spans", "bucket", "_key", "n_shingles"]
    return docs.withColumns({n: F.lit("x") for n in names})
