"""Strict JSON parsing and JSON value inspection over VARIANT.

A payload is built into a VARIANT once; every later check (key presence,
value kinds, typed extraction) navigates the binary variant.  Deciding that
the text is exactly one document takes a second pass that only tokenizes.
A repeated key keeps its last value (``spark.sql.variant.allowDuplicateKeys``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_JSON_WS = " \t\n\r"


def strict_json(raw: Column) -> Column:
    """VARIANT of ``raw`` if it is exactly one JSON document, else null.

    ``try_parse_json`` alone ignores trailing text (``{"a":1} x`` parses).
    The text is parsed wrapped in ``[ ]`` and must hold exactly one element;
    that rejects trailing text and a second document.  An extra ``]`` could
    still close the wrapper early (``0]`` parses as ``[0]``), so the text
    must also close a ``{"x": ... }`` wrapper correctly: an unmatched closer
    at depth 0 is ``]`` or ``}``, and each breaks one of the two wrappers.
    Acceptance then equals Python's ``json.loads`` except for bare NaN and
    Infinity (rejected here, accepted there).
    """
    return single_document(wrapped_json(raw))


def wrapped_json(raw: Column) -> Column:
    """The one VARIANT parse: ``raw`` wrapped in ``[ ]``, or null when the
    text is not valid JSON.  The object-wrapper check only tokenizes (no
    values are built), so the payload is materialized once."""
    closes = F.json_object_keys(F.concat(F.lit('{"x":'), raw, F.lit("}"))).isNotNull()
    return F.when(closes, F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))))


def single_document(wrapped: Column) -> Column:
    """The document of a wrapped parse when it holds exactly one element."""
    first = F.variant_get(wrapped, "$[0]", "variant")
    second = F.variant_get(wrapped, "$[1]", "variant")
    return F.when(first.isNotNull() & second.isNull(), first)


def root_kind(raw: Column) -> Column:
    """Kind of a raw JSON text that is known to be valid, from its first
    non-blank character: object / array / string / boolean / null / number."""
    c = F.substring(F.ltrim(raw, F.lit(_JSON_WS)), 1, 1)
    return (F.when(c == "{", "object").when(c == "[", "array")
            .when(c == '"', "string").when(c.isin("t", "f"), "boolean")
            .when(c == "n", "null").otherwise("number"))


def wrapped_field(wrapped: Column, name: str) -> Column:
    """A top-level key of the document inside a ``wrapped_json`` parse,
    navigated in place (no copy of the whole document)."""
    return F.variant_get(wrapped, "$[0]['" + name.replace("'", "\\'") + "']", "variant")


def field(doc: Column, name: str) -> Column:
    """Variant of a top-level key; SQL NULL when the key is absent, a VOID
    variant when it is present with JSON null."""
    return F.variant_get(doc, "$['" + name.replace("'", "\\'") + "']", "variant")


# Variant type name of a scalar -> JSON-Schema type name.
_SCALAR_KIND = {"STRING": "string", "BIGINT": "integer", "INTEGER": "integer", "DOUBLE": "number",
                "FLOAT": "number", "BOOLEAN": "boolean", "VOID": "null"}


def kind(v: Column) -> Column:
    """JSON-Schema type name of a variant value; null when ``v`` is null.

    Scalars map through a literal lookup of ``schema_of_variant``; only
    objects, arrays and decimals take the second branch.  A decimal is
    ``integer`` when its scale is 0 (1.0 and 2999.00 normalize to scale 0;
    Draft-07 counts them as integers).
    """
    m = F.create_map(*[F.lit(x) for kv in _SCALAR_KIND.items() for x in kv])
    t = F.schema_of_variant(v)
    head = F.substring(F.schema_of_variant(v), 1, 3)
    rest = (F.when(head == "OBJ", F.lit("object")).when(head == "ARR", F.lit("array"))
            .when(head == "DEC", F.when(F.schema_of_variant(v).endswith(",0)"), F.lit("integer"))
                  .otherwise(F.lit("number"))))
    return F.coalesce(F.try_element_at(m, t), rest)


def is_present(v: Column) -> Column:
    """Key present with a non-null value."""
    return v.isNotNull() & ~F.is_variant_null(v)


def string_or_null(v: Column) -> Column:
    """The text of a string value; null for absent keys and other kinds."""
    return F.when(F.schema_of_variant(v) == "STRING", F.variant_get(v, "$", "string"))


def as_string(v: Column) -> Column:
    """Text of a string variant (null for other kinds)."""
    return F.when(kind(v) == "string", F.variant_get(v, "$", "string"))


def _render_scalar(v: Column, quote_strings: bool) -> Column:
    t = F.schema_of_variant(v)
    s = F.variant_get(v, "$", "string")
    # Python floats print with a fraction (2999.0); an integral variant
    # decimal can come from "2999.00", so only BIGINT prints as an integer.
    return (F.when(t == "STRING", F.concat(F.lit("'"), s, F.lit("'")) if quote_strings else s)
            .when(t == "BIGINT", s)
            .when(t.startswith("DECIMAL") | (t == "DOUBLE"), F.variant_get(v, "$", "double").cast("string"))
            .when(t == "BOOLEAN", F.when(F.variant_get(v, "$", "boolean"), "True").otherwise("False"))
            .when(t == "VOID", "None"))


def _render(v: Column, quote_strings: bool) -> Column:
    """Python-style text of a JSON value (str() or repr()).  Scalars and
    lists of scalars print as Python does; deeper values fall back to JSON."""
    t = F.schema_of_variant(v)
    items = F.try_variant_get(v, "$", "array<variant>")
    shown = F.transform(items, lambda x: _render_scalar(x, True))
    list_text = F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))
    all_scalar = F.size(F.filter(shown, lambda x: x.isNull())) == 0
    return (F.when(t.startswith("ARRAY"), F.when(all_scalar, list_text).otherwise(F.to_json(v)))
            .when(t.startswith("OBJECT"), F.to_json(v))
            .otherwise(_render_scalar(v, quote_strings)))


def py_str(v: Column) -> Column:
    """``str(value)`` as Python prints it (strings unquoted)."""
    return _render(v, quote_strings=False)


def py_repr(v: Column) -> Column:
    """``repr(value)`` as Python prints it (strings in single quotes)."""
    return _render(v, quote_strings=True)
