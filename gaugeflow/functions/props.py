"""Open property maps: ``map<string,string>`` keyed by path (``party/website``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.functions.values import _loose_text_equal

MAP = "map<string,string>"


def empty_map() -> Column:
    return F.create_map().cast(MAP)


def build_map(items: Mapping[str, Column | str]) -> Column:
    """Map from path to value; entries whose value is NULL are left out."""
    entries = F.array(
        *[
            F.struct(F.lit(k).alias("key"), (v if isinstance(v, Column) else F.lit(v)).cast("string").alias("value"))
            for k, v in items.items()
        ]
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def parameters(json_text: Column) -> Column:
    """Flat map from a JSON object; text that is none gives an empty map."""
    return F.coalesce(F.from_json(json_text, MAP), empty_map())


def json_path(path: str) -> str:
    """``a/b/0`` as the JSON path Spark reads."""
    out = "$"
    for step in (s.replace("~1", "/").replace("~0", "~") for s in path.split("/") if s):
        out += f"[{step}]" if step.isdigit() else f"['{step}']"
    return out


def json_walk(json_text: Column, path: str) -> Column:
    """Value at a path of array indexes and field names, as text."""
    return F.get_json_object(json_text, json_path(path))


def get_path(properties: Column, path: str) -> Column:
    return F.element_at(properties, F.lit(path))


def set_path(properties: Column, path: str, value: Column | str) -> Column:
    """Set one path; a value replaces whatever lay at, below or above that path."""
    parents = [path[:i] for i, ch in enumerate(path) if ch == "/"]
    kept = F.map_filter(
        F.coalesce(properties, empty_map()),
        lambda k, v: (k != path) & ~k.startswith(path + "/") & ~k.isin(*parents) if parents
        else (k != path) & ~k.startswith(path + "/"),
    )
    text = (value if isinstance(value, Column) else F.lit(value)).cast("string")
    return F.map_concat(kept, F.create_map(F.lit(path), text))


def entries(properties: Column) -> Column:
    """Comparable form of a map."""
    return F.array_sort(F.map_entries(properties))


def _inside(path: Column, parent: Column) -> Column:
    return path.startswith(F.concat(parent, F.lit("/")))


def merge_properties(target: Column, source: Column, depth: int = 5) -> Column:
    """``struct(properties, changed)``: source values win when they differ, other entries stay.

    Empty source values for unknown paths are ignored. Paths nested more than ``depth`` levels below
    the top are taken over only where the target has nothing at that level. A value replaces a
    sub-map and a sub-map replaces a value.
    """
    has_target = target.isNotNull()
    old = F.coalesce(target, empty_map())
    old_keys = F.map_keys(old)

    def ancestor(path: Column) -> Column:
        return F.substring_index(path, "/", depth + 1)

    def wanted(k: Column, v: Column) -> Column:
        known = F.array_contains(old_keys, k)
        blank = v.isNull() | (v == "")
        too_deep = (F.size(F.split(k, "/")) > depth + 1) & F.exists(
            old_keys, lambda o: (o == ancestor(k)) | _inside(o, ancestor(k))
        )
        return ~too_deep & (known | ~blank)

    incoming = F.map_filter(F.coalesce(source, empty_map()), wanted)
    new_keys = F.map_keys(incoming)
    kept = F.map_filter(old, lambda k, v: ~F.exists(new_keys, lambda n: (n == k) | _inside(n, k) | _inside(k, n)))
    settled = F.transform_values(
        incoming,
        lambda k, v: F.when(
            F.array_contains(old_keys, k) & _loose_text_equal(F.element_at(old, k), v), F.element_at(old, k)
        ).otherwise(v),
    )
    merged = F.map_concat(kept, settled)
    result = F.when(has_target, merged).otherwise(F.coalesce(source, empty_map()))
    changed = F.when(has_target, entries(merged) != entries(old)).otherwise(F.size(F.coalesce(source, empty_map())) > 0)
    return F.struct(result.alias("properties"), changed.alias("changed"))


def append_local_id(ids: Column, new_id: Column) -> Column:
    """List of local ids with one more, unless it is there already; order kept."""
    current = F.coalesce(ids, F.array().cast("array<string>"))
    return F.when(F.array_contains(current, new_id), current).otherwise(F.array_append(current, new_id))
