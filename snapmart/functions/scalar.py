"""Scalar column functions with the reference's SQL semantics.

All are compositions of built-in ``pyspark.sql.functions`` so they stay in
whole-stage codegen. Each docstring names the semantic it keeps where Spark's
default would differ.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_part(c: ColumnOrName, delimiter: str, n: int) -> Column:
    """1-based field ``n`` of ``c`` split on a literal ``delimiter``.

    Past the last field the result is ``''``, not NULL, as in the reference.
    ``n`` must not be 0.
    """
    if n == 0:
        raise ValueError("split_part index is 1-based; 0 is not allowed")
    return F.split_part(_col(c), F.lit(delimiter), F.lit(n))


def path_part(path: ColumnOrName, from_end: int) -> Column:
    """Path segment counted from the end (1 = file name, 2 = its folder).

    Counting from the end works for any root depth (``s3a://bucket/...``,
    ``file:/...``), where a fixed index from the start would depend on the
    bucket name. A path with fewer segments gives ``''``, as ``split_part``
    does past the end, so a typed cast of it (``::date``) still fails; a
    NULL path gives NULL.
    """
    if from_end < 1:
        raise ValueError("from_end starts at 1")
    p = _col(path)
    part = F.try_element_at(F.split(p, "/"), F.lit(-from_end))
    return F.when(p.isNotNull(), F.coalesce(part, F.lit("")))


def split_literal(c: ColumnOrName, delimiter: str) -> Column:
    """``string_split(c, d)``: split on a literal; empty fields are kept."""
    return F.split(_col(c), re.escape(delimiter), -1)


def replace_literal(c: ColumnOrName, search: str, replacement: str = "") -> Column:
    """Literal (not regex) replacement of every occurrence."""
    return F.replace(_col(c), F.lit(search), F.lit(replacement))


def int_half_even(c: ColumnOrName) -> Column:
    """``x::integer`` for a DOUBLE: round half to even, then INTEGER.

    Spark's cast truncates a fraction; ``rint`` first keeps the reference's
    rounding (12.5 -> 12, 13.5 -> 14). Overflow fails under ANSI mode.
    """
    return F.rint(_col(c)).cast("int")


def int_from_text(c: ColumnOrName, spark_type: str = "int") -> Column:
    """``x::integer`` for a text: round half away from zero ('12.5' -> 13).

    The text may have a fraction or an exponent; one that is no number, or
    does not fit, fails under ANSI mode. A cast to a decimal without a fraction
    rounds once, from all digits. (Trying an integer first costs an exception
    for each text that has a fraction.)
    """
    whole = {"int": "decimal(11,0)", "bigint": "decimal(20,0)"}[spark_type]
    return _col(c).cast(whole).cast(spark_type)


def number_field(df: DataFrame, path: str, spark_type: str) -> Column:
    """A number in a document: held as text there, as a number in typed frames."""
    c = F.col(path)
    if spark_type == "double" or not isinstance(df.select(c).schema[0].dataType, StringType):
        return c.cast(spark_type)
    return int_from_text(c, spark_type)


def year_crossings(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``date_diff('year', start, end)``: New Years crossed, as BIGINT.

    2000-12-31 to 2001-01-01 is 1; Spark's ``timestampdiff(YEAR)`` counts
    whole years and would say 0.
    """
    return (F.year(_col(end)) - F.year(_col(start))).cast("bigint")


def round_scaled(c: ColumnOrName, digits: int) -> Column:
    """``round(double, d)`` computed in binary: scale, round half away from
    zero, scale back.

    Spark's ``round`` rounds the printed decimal, so ``round(4.0005, 3)`` is
    4.001 there but 4.0 in the reference, whose double is 4.000499...
    Scaling first reproduces the reference bit for bit.
    """
    scale = float(10 ** digits)
    return F.round(_col(c) * F.lit(scale), 0) / F.lit(scale)


def concat_strict(*parts: ColumnOrName) -> Column:
    """``a || b``: NULL when any part is NULL (``concat``, not ``concat_ws``).

    Strings are column names; wrap literals in ``F.lit``.
    """
    return F.concat(*[_col(p) for p in parts])


def text(c: Column) -> Column:
    """``::varchar``."""
    return c.cast("string")


def height_display(inches: ColumnOrName) -> Column:
    """``feet'inches"`` text, NULL when the height is NULL (CASE without ELSE).

    Feet are ``(inches / 12)::integer``: a true division rounded half to even,
    exactly as the reference computes it, so 71 gives ``6'11"``.
    """
    h = _col(inches)
    feet = int_half_even(h / F.lit(12))
    rest = (h % F.lit(12)).cast("int")
    return F.when(
        h.isNotNull(),
        F.concat(feet.cast("string"), F.lit("'"), rest.cast("string"), F.lit('"')),
    )


def height_display_floor(inches: ColumnOrName) -> Column:
    """The arithmetically right display, with whole feet (floor)."""
    h = _col(inches)
    feet = F.floor(h / F.lit(12)).cast("int")
    rest = (h % F.lit(12)).cast("int")
    return F.when(
        h.isNotNull(),
        F.concat(feet.cast("string"), F.lit("'"), rest.cast("string"), F.lit('"')),
    )


# Position codes and the group each maps to.
POSITION_GOALIE = "G"
POSITION_FORWARD = ("L", "R", "C")
POSITION_DEFENSE = "D"


def position_group(code: ColumnOrName) -> Column:
    """Searched CASE with ELSE: Goalie / Forward / Defenseman / Unknown."""
    c = _col(code)
    return (
        F.when(c == F.lit(POSITION_GOALIE), F.lit("Goalie"))
        .when(c.isin(*POSITION_FORWARD), F.lit("Forward"))
        .when(c == F.lit(POSITION_DEFENSE), F.lit("Defenseman"))
        .otherwise(F.lit("Unknown"))
    )


def nullif(c: ColumnOrName, value) -> Column:
    """``nullif(c, value)``."""
    return F.nullif(_col(c), F.lit(value))


def as_date(c: ColumnOrName) -> Column:
    """``::date`` (ISO text or timestamp); bad text fails under ANSI."""
    return _col(c).cast("date")
