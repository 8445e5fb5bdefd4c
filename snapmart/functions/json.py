"""JSON access with the reference's ``->`` / ``->>`` semantics.

Open-ended JSON objects are held as VARIANT: parsed once (at read, or by
``parse_json``) and then read per key without re-parsing the text, which is
what 26 key extractions per play need.

* ``->>`` (text): an absent key or a JSON null gives SQL NULL.
* ``->`` (JSON): a sub-document, still VARIANT.
* a typed extraction (``(j->>'k')::integer``) is read as text and cast as
  text is: fractions round half away from zero, and a value that is not a
  number fails the job instead of turning NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import int_from_text


def _path(*keys: str) -> str:
    for k in keys:
        if not k.replace("_", "").isalnum():
            raise ValueError(f"JSON key {k!r} needs quoting; not supported")
    return "$." + ".".join(keys)


def parse(text_col: Column) -> Column:
    """JSON text to VARIANT; malformed text fails the job."""
    return F.parse_json(text_col)


def hop(variant: Column, *keys: str) -> Column:
    """``j -> 'a' -> 'b'``: the sub-document, as VARIANT."""
    return F.variant_get(variant, _path(*keys), "variant")


def get_text(variant: Column, *keys: str) -> Column:
    """``j ->> 'k'``: text, NULL when absent or JSON null.

    A number with a fraction or an exponent is written as :func:`double_text`
    does, an integer of any length by its digits. A whole number of 2^63 and
    more is taken for an integer, as a VARIANT does not tell ``1e19`` written
    out with ``.0`` from one without. Numbers inside a nested object or array
    keep the text VARIANT gives them.
    """
    plain = F.variant_get(variant, _path(*keys), "string")
    kind = F.schema_of_variant(hop(variant, *keys))
    # Without a fraction and not in 64 bits: an integer, which VARIANT holds as a decimal.
    long_integer = kind.startswith("DECIMAL") & (F.abs(plain.try_cast("double")) >= 2.0**63) & ~plain.contains(".")
    is_float = (kind == "DOUBLE") | (kind.startswith("DECIMAL") & ~long_integer)
    return F.when(is_float, double_text(plain.try_cast("double"))).otherwise(plain)


def double_text(c: Column) -> Column:
    """A DOUBLE as JSON text: the shortest digits that read back as the same
    number, always with a fraction or an exponent; plain from ``0.000001`` to
    below ``1e21`` (``2.0``, ``100000.0``), else like ``1e21`` or ``1.5e-7``."""
    shorter = [F.format_string(f"%.{n}e", c) for n in (14, 15, 16)]
    digits = F.when(shorter[0].try_cast("double") == c, shorter[0]).when(shorter[1].try_cast("double") == c, shorter[1]).otherwise(shorter[2])
    size = F.abs(c)
    # Room for 17 digits on either side of one.
    plain = F.when(size >= 1, digits.try_cast("decimal(38,16)").cast("string")).otherwise(digits.try_cast("decimal(38,23)").cast("string"))
    return (
        F.when((c == 0) | F.isnan(c) | (size == float("inf")), c.cast("string"))
        # Up to 15 digits are always the shortest, and Spark writes these plainly.
        .when((size >= 1e-3) & (size < 1e7) & (F.length(c.cast("string")) <= 16), c.cast("string"))
        .when((size < 1e-6) | (size >= 1e21), F.regexp_replace(digits, r"\.?0*e\+?(-?)0*", "e$1"))
        .otherwise(F.regexp_replace(plain, r"(\.\d+?)0+$", "$1"))
    )


def get_int(variant: Column, *keys: str) -> Column:
    """``(j ->> 'k')::integer``."""
    return int_from_text(F.variant_get(variant, _path(*keys), "string"))


def get_typed(variant: Column, spark_type: str, *keys: str) -> Column:
    """Typed extraction for any Spark SQL type name."""
    return F.variant_get(variant, _path(*keys), spark_type)


def get_fields(variant: Column, fields: list[tuple[str, str]], stored: bool = True) -> Column:
    """Many ``(j->>'k')::type`` reads: a struct with one field per ``(key, type)``.

    An ``int`` is read as a double, which holds every such value and its
    fraction, and a ``bigint`` as a decimal with six decimals, so that ``84``,
    ``84.0`` and ``"84"`` all fit; select the struct under a name first, then
    take each field through :func:`typed_field`, which rounds half away from
    zero. An absent key, a JSON null or a document that is no object gives NULL
    fields; a value that does not fit its type fails the job.

    From a stored table the keys are read one by one, and each read becomes one
    of a typed sub-column. ``stored=False`` is for documents that are no
    scan's column (parsed or built in the same query): all keys in one pass,
    half the work there, and an ``int`` as a decimal without a fraction, which
    the read itself rounds. Its check for objects must not be pushed into a
    scan, which would evaluate the read without it.
    """
    for k, _ in fields:
        _path(k)
    if stored:
        return F.struct(*[F.variant_get(variant, _path(k), _NUMBERS.get(t, t)).alias(k) for k, t in fields])
    whole = _NUMBERS | {"int": _WHOLE_INT}
    ddl = "struct<" + ", ".join(f"`{k}`: {whole.get(t, t)}" for k, t in fields) + ">"
    # A key that no object has: NULL only for a value that is no object.
    is_object = F.try_variant_get(variant, "$", "struct<`_`: string>").isNotNull()
    return F.when(is_object, F.variant_get(variant, "$", ddl))


#: Types that hold every value of an integer type, and fractions.
_NUMBERS = {"int": "double", "bigint": "decimal(38,6)"}
#: Holds every INTEGER; a cast to it rounds half away from zero.
_WHOLE_INT = "decimal(11,0)"


def typed_field(field: Column, spark_type: str, stored: bool = True) -> Column:
    """A field of :func:`get_fields`, read with the same ``stored``, in its type.

    An ``int`` goes by one decimal cast, as little code: 22 calls of ``round``
    beside a dozen joins make a generated method that the JVM does not compile.
    """
    if spark_type == "int":
        whole = field.cast(_WHOLE_INT).cast("int")
        # The text "NaN" is a double without a decimal; the plain cast fails on it.
        return F.coalesce(whole, field.cast("int")) if stored else whole
    return F.round(field, 0).cast(spark_type) if spark_type in _NUMBERS else field
