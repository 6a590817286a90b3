"""Access to semi-structured columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_get(v: Column | str, path: str, type_: str = "string") -> Column:
    """Value at a dotted path, cast; NULL when the path is missing."""
    return F.variant_get(v, f"$.{path}" if path else "$", type_)


def json_array(v: Column | str, path: str, element: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{path}" if path else "$", f"array<{element}>")


def json_elements(v: Column | str, path: str) -> Column:
    """Elements of the array, or values of the object, at a path; NULL for a scalar or no value."""
    at = f"$.{path}" if path else "$"
    return F.coalesce(
        F.try_variant_get(v, at, "array<variant>"),
        F.map_values(F.try_variant_get(v, at, "map<string,variant>")),
    )


def array_first(v: Column | str, path: str, type_: str = "string") -> Column:
    """First element of the array at a path; NULL for an empty or missing array."""
    return F.get(json_array(v, path, type_), F.lit(0))


def array_last(v: Column | str, path: str, type_: str = "string") -> Column:
    """Last element of the array at a path; NULL for an empty or missing array."""
    return F.try_element_at(json_array(v, path, type_), F.lit(-1))


def path_depth(path: Column | str) -> Column:
    """Depth of a path such as `a.b[0]`: one per name, and one more for an index at the end.

    An index in the middle of a path does not count: `crew[0].name` has depth 2 and
    `crew[0]` has depth 2 as well.
    """
    column = F.col(path) if isinstance(path, str) else path
    marked = F.regexp_replace(column, r"\[(\d+)\]$", ".$1")
    return F.size(F.filter(F.split(marked, r"\."), lambda token: token != ""))
