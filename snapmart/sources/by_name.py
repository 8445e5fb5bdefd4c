"""Files whose columns differ, read as one table by column name.

A column's type is the common one of all files that hold it; a file without
the column gives NULLs. The common type of two types:

* the same type, or the other one where one is unknown (only NULLs);
* of two numbers the wider one: integers to the longer, with a decimal to a
  decimal with room for both (a double if 38 digits are too few), with a
  floating number to a double; a boolean with a number to that number;
* a date with a timestamp to the timestamp;
* structs field by field, arrays by their elements;
* anything else to text.

Spark's own union would read a text as a number under ANSI and fail on one that
is none, and its Parquet reader refuses files whose types differ. Here files are
put into groups that Spark can merge, each group is read with its merged schema,
and every group is cast to the common one. Groups are found by halving the
sorted list of files where a merge is refused, so the footers are read by
Spark's tasks: one job if all files agree, about twice the logarithm of their
number for each place where the type changes along the list. What the driver
holds is the listing and one schema per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_INTEGER_DIGITS = (3, 5, 10, 19)


def _as_decimal(t: T.DataType) -> T.DecimalType:
    return t if isinstance(t, T.DecimalType) else T.DecimalType(_INTEGER_DIGITS[_INTEGERS.index(t)], 0)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both (see the module's rules)."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), True)
    if isinstance(a, T.NumericType) and isinstance(b, T.BooleanType):
        return a
    if isinstance(a, T.BooleanType) and isinstance(b, T.NumericType):
        return b
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if a in _INTEGERS and b in _INTEGERS:
            return max(a, b, key=_INTEGERS.index)
        if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        a, b = _as_decimal(a), _as_decimal(b)
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    times = {T.DateType(), T.TimestampType(), T.TimestampNTZType()}
    if T.DateType() in (a, b) and {a, b} <= times:
        return b if a == T.DateType() else a
    return T.StringType()


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of ``schemas`` in order of first sight, told apart without regard to case."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            key = f.name.lower()
            kind = common_type(found[key].dataType, f.dataType) if key in found else f.dataType
            found[key] = T.StructField(found[key].name if key in found else f.name, kind, True)
    return T.StructType(list(found.values()))


def _cast(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as ``want``; absent fields of a struct are NULL."""
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = []
        for f in want.fields:
            there = own.get(f.name.lower())
            part = _cast(value.getField(there.name), there.dataType, f.dataType) if there else F.lit(None).cast(f.dataType)
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType) and have.elementType != want.elementType:
        return F.transform(value, lambda x: _cast(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value if have == want else value.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``; columns it lacks are NULL."""
    own = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in schema.fields:
        there = own.get(f.name.lower())
        value = _cast(F.col(f"`{there.name}`"), there.dataType, f.dataType) if there else F.lit(None).cast(f.dataType)
        out.append(value.alias(f.name))
    return df.select(*out)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of ``frames`` under their common schema."""
    schema = common_schema([df.schema for df in frames])
    return reduce(DataFrame.unionAll, [conform(df, schema) for df in frames])


def files_of(spark: SparkSession, path: str, suffix: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of the files below ``path`` (a folder or a glob), by path.

    Spark lists them, in parallel where folders are many; no content is read.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path)
    return [(r.path, r.length) for r in listing.select("path", "length").orderBy("path").collect()]


def _merged(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """The merged schema of Parquet files, or None where Spark refuses."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema
    except Py4JJavaError as e:  # PySpark passes this error of Spark's on as it is
        if "CANNOT_MERGE_SCHEMAS" not in str(e.java_exception):
            raise
        return None


def schema_groups(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Runs of ``paths`` that Spark can merge, with the schema of each; equal schemas are joined."""
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    todo = [paths] if paths else []
    while todo:
        run = todo.pop()
        schema = _merged(spark, run)
        if schema is None:
            half = len(run) // 2
            todo += [run[half:], run[:half]]
        else:
            groups.setdefault(schema.json(), (schema, []))[1].extend(run)
    return list(groups.values())


def read_parquet_by_name(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below ``path`` as one table by name, types widened.

    Each file belongs to one group, so it is read once; filters and column
    pruning reach every group's scan where a column keeps its type.
    """
    paths = [p for p, _ in files_of(spark, path, ".parquet")]
    if not paths:
        raise FileNotFoundError(f"no Parquet file below {path}")
    return union_by_name([spark.read.schema(schema).parquet(*group) for schema, group in schema_groups(spark, paths)])


def read_json_by_name(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All JSON documents at ``path`` as one table by name, types widened.

    The types are found by one pass over all documents. Spark's own rules agree
    with the module's for JSON: whole numbers with fractions are doubles, mixed
    with text they are text.
    """
    return spark.read.option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
