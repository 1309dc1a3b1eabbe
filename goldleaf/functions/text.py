"""Cleaning and strict JSON parsing of model answers, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

FENCE = r"`{3}(json)?"

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    """Drop blanks at both ends, Unicode ones included."""
    return F.btrim(text, F.lit(BLANKS))


def strip_fences(raw: Column) -> Column:
    """Drop every code-fence mark, then the blanks around what is left."""
    return strip(F.regexp_replace(raw, FENCE, ""))


def non_blank(text: Column) -> Column:
    """Not null and not only spaces; a tab-only text counts as text."""
    return text.isNotNull() & (F.trim(text) != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once, however often it is named.

    Columns would not do: a filter pushed below them puts the whole expression in every place.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def json_object(raw: Column, use: Callable[[Column], Column]) -> Column:
    """`use(object)` for an answer, where the object is the VARIANT of a text that is one JSON
    object and nothing else, or null.

    The parser stops at the end of the first value, so text after it would pass. Inside a
    list, with a hash of the text as second element, it cannot.
    """

    def sealed(clean: Column) -> Column:
        seal = F.xxhash64(clean)
        pair = F.try_parse_json(F.concat(F.lit("["), clean, F.lit(","), seal.cast("string"), F.lit("]")))

        def whole(both: Column) -> Column:
            sealed_by = F.try_variant_get(both, "$[1]", "bigint") == seal
            return F.when(sealed_by & clean.startswith("{"), F.try_variant_get(both, "$[0]", "variant"))

        return let(pair, whole)

    return let(let(strip_fences(raw), sealed), use)


def field(obj: Column, name: str) -> Column:
    """The field as VARIANT; null only when the key is missing."""
    return F.try_variant_get(obj, f"$.{name}", "variant")


def field_text(obj: Column, name: str) -> Column:
    """The field as text: '' when missing, 'None' for a JSON null."""

    def shown(value: Column) -> Column:
        text = F.try_variant_get(value, "$", "string")
        return (
            F.when(value.isNull(), F.lit(""))
            .when(F.is_variant_null(value), F.lit("None"))
            .when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(text))
            .otherwise(text)
        )

    return let(field(obj, name), shown)


def field_number(obj: Column, name: str) -> Column:
    """The field as double: 0.0 when missing, null when it is no number."""

    def number(value: Column) -> Column:
        text = strip(F.try_variant_get(value, "$", "string"))
        return F.when(value.isNull(), F.lit(0.0)).when(
            (F.schema_of_variant(value) != "STRING") | text.rlike(NUMBER), F.try_variant_get(value, "$", "double")
        )

    return let(field(obj, name), number)


def field_strings(obj: Column, name: str) -> Column:
    """The field as a list of distinct non-blank texts in first-seen order.

    Anything but a list gives an empty list; null, 0, false and empty elements go.
    """
    items = F.try_variant_get(obj, f"$.{name}", "array<variant>")

    def element(item: Column) -> Column:
        kind = F.schema_of_variant(item)

        def kept(shown: Column) -> Column:
            hollow = shown.isin("false", "[]", "{}") | F.coalesce(
                F.try_variant_get(item, "$", "double") == 0, F.lit(False)
            )
            return (
                F.when((kind == "STRING") | shown.isNull(), shown)
                .when(hollow, None)
                .when(kind == "BOOLEAN", F.lit("True"))
                .otherwise(shown)
            )

        return let(strip(F.try_variant_get(item, "$", "string")), kept)

    texts = F.filter(F.transform(items, element), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_distinct(texts), F.array().cast("array<string>"))


def json_list(text: Column) -> Column:
    """JSON text of a list back to a list, null when it is none."""
    return F.from_json(text, "array<string>")
