"""Reading drifting JSON held in VARIANT columns.

Three notions decide most results and are kept apart here:

* *absent or null* - the key is missing or JSON null;
* *present* - anything else, including ``""``, ``0``, ``false`` and ``{}``;
* *truthy* - present and not one of the empty values just listed.

A value is always selected first and cast second, so a present value of the wrong type gives
null instead of falling through to the next key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON renderings of the values that count as false.
FALSY_JSON = ("null", "false", '""', "[]", "{}", "0", "0.0", "-0.0")


def at(value: Column, key: str) -> Column:
    """Field ``key`` of an object as VARIANT; null for other shapes."""
    return F.try_variant_get(value, f"$['{key}']", "variant")


def read(value: Column, *shape: str) -> Column:
    """Several fields of an object at once, as a struct of the given shape.

    One walk over the object instead of one per field. Fields that are missing or have another
    shape are null on their own; anything but an object gives null.
    """
    return F.try_variant_get(value, "$", f"struct<{','.join(shape)}>")


def present(value: Column) -> Column:
    """The value, with JSON null turned into SQL null."""
    return F.when(~F.is_variant_null(value), value)


def first_of(*values: Column) -> Column:
    """First present value."""
    return F.coalesce(*[present(value) for value in values])


def first_present(value: Column, *keys: str) -> Column:
    """First of ``keys`` whose value is present."""
    return first_of(*[at(value, key) for key in keys])


def truthy(value: Column) -> Column:
    """Whether a JSON value is non-empty and non-zero; never null.

    Strings render with quotes, so the strings ``"0"`` and ``"false"`` are truthy.
    """
    return truthy_json(F.to_json(value))


def truthy_json(text: Column) -> Column:
    """``truthy`` of a value already rendered as JSON."""
    return ~F.coalesce(text, F.lit("null")).isin(*FALSY_JSON)


def first_truthy(*values: Column) -> Column:
    """First truthy value, else null."""
    return F.coalesce(*[F.when(truthy(value), value) for value in values])


def either(left: Column, right: Column) -> Column:
    """``left`` if truthy, else whatever ``right`` holds (JSON null counts as null)."""
    return F.when(truthy(left), left).otherwise(present(right))


def to_text(value: Column) -> Column:
    """Scalar as text; objects and arrays as JSON text."""
    return F.try_variant_get(value, "$", "string")


def to_int(value: Column) -> Column:
    """Lenient integer: numeric strings and booleans convert, fractions truncate, the rest is null.

    Digits grouped with underscores, non-ASCII digits and values beyond 64 bits give null. Plain
    digits and text that cannot be a number are told apart first, since the general conversion
    raises and catches an error for each value it refuses.
    """
    text = F.to_json(value)
    return (
        F.when(
            text.rlike('^"?-?[0-9]{1,18}"?$'), F.translate(text, '"', "").try_cast("bigint")
        )
        .when(text.rlike(r'^"([^0-9\\]*|[^"\\]*[A-Za-z.][^"\\]*)"$'), F.lit(None))
        .otherwise(F.try_variant_get(value, "$", "bigint"))
    )


def elements(value: Column) -> Column:
    """An array value as ARRAY<VARIANT>; null for other shapes."""
    return F.try_variant_get(value, "$", "array<variant>")


def list_at(value: Column, key: str) -> Column:
    """Field ``key`` as ARRAY<VARIANT>, empty when it is missing or not a list."""
    return F.coalesce(
        F.try_variant_get(value, f"$['{key}']", "array<variant>"), no_items()
    )


def no_items() -> Column:
    return F.expr("cast(array() as array<variant>)")


def fields(value: Column) -> Column:
    """An object as MAP<STRING, VARIANT>; null for other shapes."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _quoted(text: Column) -> Column:
    """Text in single quotes, or in double ones if it holds single quotes only; backslash, tab and return escaped."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    escaped = F.replace(F.replace(escaped, F.lit("\t"), F.lit("\\t")), F.lit("\r"), F.lit("\\r"))
    doubled = text.contains("'") & ~text.contains('"')
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(doubled, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(single)


def kind_and_size(value: Column) -> tuple[Column, Column]:
    """Short type name as ``type_name`` gives it, and how many entries an object or list has (0 for others).

    The type of a whole subtree is asked for scalars only: following a document level by level would otherwise
    describe all that lies below once per level, which is quadratic in its depth.
    """
    n_fields, n_elements = F.size(fields(value)), F.size(elements(value))
    kind = F.when(n_fields >= 0, "dict").when(n_elements >= 0, "list").otherwise(type_name(value))
    return kind, F.greatest(n_fields, n_elements, F.lit(0))


def type_name(value: Column, preview: bool = False, length: int | None = None) -> Column:
    """Short type name of a JSON value: null, bool, int, float, str, list or dict.

    With ``preview`` a string also shows its text in quotes on one line, or the first ``length`` characters of it.
    Whole numbers beyond 64 bits are stored as wide decimals and still count as int.
    """
    stored = F.schema_of_variant(value)
    text = to_text(value)
    string_name = F.lit("str")
    if preview:
        shown = F.translate(text if length is None else F.left(text, F.lit(length)), "\n", " ")
        string_name = F.when(text == "", F.lit("str (empty)")).otherwise(
            F.concat(F.lit("str ("), _quoted(shown), F.lit(")"))
        )
    return (
        F.when(stored == "VOID", "null")
        .when(stored == "BOOLEAN", "bool")
        .when(stored == "STRING", string_name)
        .when(stored.startswith("OBJECT"), "dict")
        .when(stored.startswith("ARRAY"), "list")
        .when(stored.rlike(r"^BIGINT$|^DECIMAL\((19|[23][0-9]),0\)$"), "int")
        .when(stored.isNotNull(), "float")
    )
