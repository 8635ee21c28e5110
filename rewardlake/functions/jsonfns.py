"""JSON column functions: record building and tool-call argument decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip, strict_json_object

# keys looked up, in this order, in a JSON object of tool-call arguments
TOOL_SQL_KEYS = ("sql", "query", "statement")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def messages(*pairs) -> Column:
    """ARRAY<STRUCT<role, content>> from (role, content) column pairs."""
    return F.array(*[F.struct(F.lit(r).alias("role") if isinstance(r, str) else r.alias("role"),
                              _c(c).alias("content")) for r, c in pairs])


def tool_args_sql(arguments) -> Column:
    """FN17 for one tool call's ``arguments`` text.

    non-JSON text -> the stripped text; JSON object -> 'sql', 'query',
    'statement' when that value is a string, else the first string value in
    key order; JSON string -> itself; anything else -> NULL.
    """
    a = _c(arguments)
    v = F.try_parse_json(a)
    as_map = F.from_json(a, "map<string,variant>")
    entries = F.map_entries(as_map)

    def key_str(k):
        val = F.try_element_at(as_map, F.lit(k))
        return F.when(F.schema_of_variant(val) == F.lit("STRING"), F.try_variant_get(val, "$", "string"))

    first_str = F.try_element_at(
        F.filter(entries, lambda e: F.schema_of_variant(e["value"]) == F.lit("STRING")), F.lit(1))["value"]
    obj_sql = F.coalesce(*[key_str(k) for k in TOOL_SQL_KEYS], F.try_variant_get(first_str, "$", "string"))
    kind = F.schema_of_variant(v)
    res = (F.when(a.isNull() | (a == F.lit("")), F.lit(None))
            .when(v.isNull(), a)
            .when(kind.startswith("OBJECT"), obj_sql)
            .when(kind == F.lit("STRING"), F.try_variant_get(v, "$", "string")))
    return py_strip(res)


def tool_calls_sql(tool_calls) -> Column:
    """SQL of the first tool call (in order) whose arguments yield text; blank
    text decides too, but is no SQL (NULL)."""
    per_call = F.transform(F.coalesce(_c(tool_calls), F.array().cast("array<struct<name:string,arguments:string>>")),
                           lambda tc: tool_args_sql(tc["arguments"]))
    return F.nullif(F.try_element_at(F.filter(per_call, lambda x: x.isNotNull()), F.lit(1)), F.lit(""))


def guarded_from_json(text, schema: str) -> Column:
    """``from_json`` only for text that is one strict JSON object, else NULL."""
    t = py_strip(_c(text))
    return F.when(strict_json_object(t), F.from_json(t, schema, {"allowSingleQuotes": "false"}))
