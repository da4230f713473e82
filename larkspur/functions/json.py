"""JSON record functions (JSN1-JSN9) on top of Spark's VARIANT type.

Presence rules follow the source records: a key that is present with a
JSON ``null`` is *present* (``has_path`` is true), a missing key is absent.
``get_json_object`` cannot tell the two apart, so presence is always tested
on the VARIANT value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_strict(text: Column | str) -> Column:
    """JSN1: strict parse; a malformed record fails the query."""
    return F.parse_json(_c(text))


def parse_lenient(text: Column | str) -> Column:
    """JSN2: NULL for malformed input (route those rows to a dirty output)."""
    return F.try_parse_json(_c(text))


def with_parsed(df, text: Column | str, name: str, strict: bool = False):
    """Add the parsed VARIANT of ``text`` as column ``name``, parsed once.

    The value comes out of a one-element ``explode``: the optimizer pushes
    filters on parsed fields below a plain projection, substituting the
    parse into the filter (so each record would be parsed twice); it cannot
    push them below a generator output, so the parse stays single."""
    v = parse_strict(text) if strict else parse_lenient(text)
    return df.select("*", F.explode(F.array(v)).alias(name))


def is_json_object(v: Column) -> Column:
    """A parsed value that is a JSON object (records must be objects)."""
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def path(v: Column, p: str, typ: str = "string") -> Column:
    """JSN3: typed extraction of ``$.a.b``; NULL when absent or not castable."""
    return F.try_variant_get(v, p, typ)


def has_path(v: Column, p: str) -> Column:
    """JSN5: key present (even when its value is JSON null)."""
    return F.try_variant_get(v, p, "variant").isNotNull()


def as_map(v: Column) -> Column:
    """Top-level object as MAP<STRING, VARIANT> (NULL when not an object)."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def set_field(obj: Column, key: str, value: Column) -> Column:
    """JSN4: set / overwrite one key of a MAP<STRING, VARIANT> object."""
    kept = F.map_filter(obj, lambda k, _v: k != F.lit(key))
    return F.map_concat(kept, F.create_map(F.lit(key), value.cast("variant")))


def set_nested_field(v: Column, parent: str, key: str, value: Column) -> Column:
    """JSN4 on a nested object: ``v[parent][key] = value``; returns VARIANT."""
    top = as_map(v)
    inner = F.try_variant_get(v, f"$.{parent}", "map<string,variant>")
    new_inner = F.to_variant_object(set_field(inner, key, value))
    return F.to_variant_object(
        F.map_concat(F.map_filter(top, lambda k, _v: k != F.lit(parent)),
                     F.create_map(F.lit(parent), new_inner)))


def prune_columns(data: Column, columns_csv: Column | str) -> Column:
    """JSN6: keep the keys listed in a comma list (exact match, no trim).

    The list is split once a record: inside the filter it would be split anew for every key."""
    lists = F.array(F.split(_c(columns_csv), ","))
    return F.transform(lists, lambda cols: F.map_filter(data, lambda k, _v: F.array_contains(cols, k)))[0]


def object_keys(text: Column | str) -> Column:
    """JSN9: keys of a top-level JSON object, in document order."""
    return F.json_object_keys(_c(text))
