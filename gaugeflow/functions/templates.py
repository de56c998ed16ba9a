"""Text templates compiled once on the driver into concatenations of columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholder syntaxes of the two template languages and of `replace_in`.
NAME_PLACEHOLDER = re.compile(r"\{([0-9a-zA-Z_]+)(\|([^}]*))?\}")
PATH_PLACEHOLDER = re.compile(r"\{([^|{}]+)(\|([^}]+))?\}")
MAP_PLACEHOLDER = re.compile(r"\{([^}]+)\}")

PLAIN, JSON, URL = "plain", "json", "url"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _pieces(template: str, syntax: re.Pattern) -> list[tuple[str, re.Match | None]]:
    """Literal text and placeholder matches in order."""
    out: list[tuple[str, re.Match | None]] = []
    at = 0
    for match in syntax.finditer(template):
        if match.start() > at:
            out.append((template[at : match.start()], None))
        out.append(("", match))
        at = match.end()
    if at < len(template) or not out:
        out.append((template[at:], None))
    return out


def _escape(value: Column, mode: str, quotes: bool) -> Column:
    if mode == JSON:
        value = F.replace(value, F.lit("\\"), F.lit("\\\\"))
        value = F.replace(value, F.lit("\n"), F.lit("\\n"))
        if quotes:
            value = F.replace(value, F.lit('"'), F.lit('\\"'))
    elif mode == URL:
        value = F.replace(value, F.lit("'"), F.lit("''"))
    return value


def template(
    text: str,
    columns: Sequence[str],
    mode: str = PLAIN,
    strip_newlines: bool = False,
    escape_quotes: bool = True,
) -> Column:
    """``{name}``, ``{3}`` and ``{name|default}`` filled from the columns of a record.

    The default replaces an empty cell. A template that is itself a column name yields that cell.
    A placeholder for a column that does not exist is an error when the plan is built.
    """
    if strip_newlines:
        text = text.replace("\n", "")
    if text in columns:
        return F.coalesce(quoted(text), F.lit(""))
    parts = []
    for literal, match in _pieces(text, NAME_PLACEHOLDER):
        if match is None:
            parts.append(F.lit(literal))
            continue
        name = match.group(1)
        if re.fullmatch(r"[0-9]+", name):
            if int(name) >= len(columns):
                raise ValueError(f"template column {name} is beyond the {len(columns)} columns of the record")
            name = columns[int(name)]
        elif name not in columns:
            raise ValueError(f"template column {name!r} is not in the record")
        cell = F.coalesce(quoted(name).cast("string"), F.lit(""))
        if match.group(3) is not None:
            cell = F.when(cell == "", F.lit(match.group(3))).otherwise(cell)
        parts.append(_escape(cell, mode, escape_quotes))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _resolve_path(path: str, columns: Mapping[str, str]) -> Column | None:
    """Column for ``a/b/c``; ``columns`` maps a top-level name to its type string."""
    steps = [s.replace("~1", "/").replace("~0", "~") for s in path.split("/") if s]
    if not steps or steps[0] not in columns:
        return None
    value, kind = quoted(steps[0]), columns[steps[0]]
    for i, step in enumerate(steps[1:]):
        if kind.startswith("struct<"):
            value = value.getField(step)
            kind = "unknown"
        elif kind == "map<string,string>":
            # Nested maps are flat: the rest of the path is one key.
            return F.element_at(value, F.lit("/".join(steps[i + 1 :])))
        elif kind.startswith("array<"):
            if not re.fullmatch(r"[0-9]+", step):
                return None
            value = F.get(value, F.lit(int(step)))
            kind = kind[len("array<") : -1]
        else:
            value = value.getItem(step)
    return value.cast("string")


def path_template(text: str, columns: Mapping[str, str], for_url: bool = False) -> Column:
    """``{a/b|default}`` over nested values; any value missing without default empties the result."""
    if text in columns:
        return F.coalesce(quoted(text).cast("string"), F.lit(""))
    parts, required = [], []
    for literal, match in _pieces(text, PATH_PLACEHOLDER):
        if match is None:
            parts.append(F.lit(literal))
            continue
        value = _resolve_path(match.group(1), columns)
        value = F.lit(None).cast("string") if value is None else F.nullif(value, F.lit(""))
        if for_url:
            value = F.replace(value, F.lit("'"), F.lit("''"))
        else:
            value = F.replace(F.replace(value, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
        if match.group(3) is not None:
            value = F.coalesce(value, F.lit(match.group(3)))
        else:
            required.append(value)
        parts.append(value)
    filled = parts[0] if len(parts) == 1 else F.concat(*parts)
    return F.coalesce(filled, F.lit("")) if required else filled


def column_types(df) -> dict[str, str]:
    return dict(df.dtypes)


def _literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def translate_values(value: Column, mapping: Mapping[str, str]) -> Column:
    """Mapped value, or the input when the mapping has none."""
    if not mapping:
        return value
    return F.coalesce(F.element_at(_literal_map(mapping), value), value)


def replace_in(value: Column, mapping: Mapping[str, str], url_encode: bool = False) -> Column:
    """Replace each ``{key}`` found in the text by its mapped value, in a single pass.

    Text is cut at the placeholders so that a replacement is never scanned again. An unknown key
    becomes the text ``null``, or NULL for the whole result when URL encoding is asked for.
    """
    table = _literal_map(mapping) if mapping else F.create_map().cast("map<string,string>")
    keys = F.regexp_extract_all(value, F.lit(r"\{([^}]+)\}"), F.lit(1))
    between = F.split(value, r"\{[^}]+\}", -1)
    filled = F.transform(keys, lambda k: F.element_at(table, k))
    if url_encode:
        filled = F.transform(filled, lambda v: F.url_encode(v))
        complete = ~F.exists(filled, lambda v: v.isNull())
    else:
        filled = F.transform(filled, lambda v: F.coalesce(v, F.lit("null")))
        complete = F.lit(True)
    woven = F.zip_with(between, filled, lambda text, v: F.concat(F.coalesce(text, F.lit("")), F.coalesce(v, F.lit(""))))
    return F.when(complete, F.array_join(woven, ""))
