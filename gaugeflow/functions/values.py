"""Result values: parsing, missing markers, unit conversion, comparison, small text helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.templates import quoted
from gaugeflow.model import RESULT_DECIMAL

# What counts as a whole number and as a decimal number in a cell.
INTEGER = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"

NUMERIC_KINDS = ("int", "long", "decimal")


def _decimal(text: Column) -> Column:
    return F.when(text.rlike(DECIMAL), text.try_cast(RESULT_DECIMAL))


def parse_result(cell: Column, percent: str = "reference") -> Column:
    """Tagged result ``struct(kind, num, text)``: int, long, decimal, else string; NULL when empty.

    ``text`` keeps the cell as read, so numbers wider than the decimal column lose nothing.
    ``percent='numeric'`` reads ``50%`` as a number; by default only values beyond the 32-bit range
    lose their percent sign.
    """
    text = number_text(cell, percent)
    return tagged_result(cell, text, text.try_cast(RESULT_DECIMAL))


def number_text(cell: Column, percent: str = "reference") -> Column:
    """The number in a cell as ``parse_result`` reads it, still as text; NULL where it reads none."""
    bare = F.regexp_replace(cell, "%+$", "")
    if percent == "numeric":
        # A percent sign after any number.
        is_percent = bare.rlike(DECIMAL)
    else:
        is_percent = bare.rlike(INTEGER) & (_number_kind(bare, bare.try_cast(RESULT_DECIMAL)) == "long")
    return F.when(cell.rlike(DECIMAL), cell).when(cell.endswith("%") & is_percent, bare)


def _number_kind(text: Column, number: Column) -> Column:
    # Ranges instead of casts: a cast that fails is an exception per row.
    whole = F.when(number.between(-(1 << 31), (1 << 31) - 1), "int").when(
        number.between(F.lit(-(1 << 63)), F.lit((1 << 63) - 1)), "long"
    )
    fraction = text.contains(".") | text.contains("e") | text.contains("E")
    return F.when(fraction, "decimal").otherwise(F.coalesce(whole, F.lit("decimal")))


def tagged_result(cell: Column, text: Column, number: Column) -> Column:
    """The struct of ``parse_result`` from the cell, its ``number_text`` and that as a number."""
    empty = cell.isNull() | (cell == "") | (F.lower(cell) == "null")
    kind = F.when(text.isNull(), "string").otherwise(_number_kind(text, number))
    return F.when(~empty, F.struct(kind.alias("kind"), number.alias("num"), cell.alias("text")))


def decimal_text(cell: Column, separator: str = "DETECT") -> Column:
    """The cell as plain decimal text with a point, NULL when it is not a number.

    DETECT takes the comma as decimal mark when the first comma lies after the first point.
    """
    trimmed = F.trim(cell)
    from_comma = F.replace(F.replace(trimmed, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    if separator == "COMMA":
        text = from_comma
    elif separator == "POINT":
        text = trimmed
    elif separator == "DETECT":
        text = F.when(F.instr(cell, ",") > F.instr(cell, "."), from_comma).otherwise(trimmed)
    else:
        raise ValueError(f"unknown decimal separator {separator!r}")
    return F.when(text.rlike(DECIMAL), text)


def strip_zeros(text: Column) -> Column:
    """Drop zeros that end a decimal fraction, and a point left bare."""
    has_fraction = (F.instr(text, ".") > 0) & ~text.rlike("[eE]")
    return F.when(has_fraction, F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text)


def parse_decimal(cell: Column, separator: str = "DETECT") -> Column:
    return decimal_text(cell, separator).try_cast(RESULT_DECIMAL)


def parse_number(cell: Column, on_error: str = "fail") -> Column:
    """A number, or an error for text that is none (``on_error='null'`` yields NULL)."""
    text = cell.cast("string")
    number = _decimal(text)
    if on_error == "null":
        return number
    return F.when(text.isNull() | number.isNotNull(), number).otherwise(
        F.raise_error(F.concat(F.lit("not a number: "), text)).cast(RESULT_DECIMAL)
    )


def convert_unit(
    value: Column, unit_from: Column, unit_to: Column, conversions: Iterable[tuple[str, str, str | int | Decimal]]
) -> Column:
    """Value in the wanted unit: unchanged, times the factor, or divided by it; NULL if neither applies.

    The conversion list is configuration, so it is folded into a literal CASE. A later pair
    replaces an earlier one; a forward pair is tried before a reversed one.
    """
    forward: dict[tuple[str, str], Decimal] = {}
    backward: dict[tuple[str, str], Decimal] = {}
    for source, target, factor in conversions:
        forward[source, target] = Decimal(str(factor))
        backward[target, source] = Decimal(str(factor))
    # 16 whole digits leave room for factors of up to 9 digits without losing fraction digits.
    narrow = value.try_cast("decimal(28,12)")

    def scaled(apply) -> Column:
        return F.coalesce(apply(narrow), apply(value)).try_cast(RESULT_DECIMAL)

    out = F.when(unit_from == unit_to, value.cast(RESULT_DECIMAL))
    for (source, target), factor in forward.items():
        out = out.when(
            (unit_from == source) & (unit_to == target), scaled(lambda v, f=factor: F.try_multiply(v, F.lit(f)))
        )
    for (source, target), factor in backward.items():
        out = out.when(
            (unit_from == source) & (unit_to == target), scaled(lambda v, f=factor: F.try_divide(v, F.lit(f)))
        )
    return out


def is_missing(cell: Column, equals: str | None = None, regex: str | None = None) -> Column:
    """Missing marker by exact text or by a pattern that has to cover the whole cell."""
    if equals is not None:
        return cell.eqNullSafe(F.lit(equals))
    if regex is not None:
        return F.coalesce(cell.rlike(f"^(?:{regex})$"), F.lit(False))
    return F.lit(False)


def drop_missing(df: DataFrame, column: str, equals: str | None = None, regex: str | None = None) -> DataFrame:
    return df.filter(~is_missing(quoted(column), equals, regex))


def _plain(number: Column) -> Column:
    """Number text without plus sign, needless zeros and a bare decimal point."""
    bare = F.regexp_replace(F.trim(number), r"^\+", "")
    bare = F.regexp_replace(bare, r"^(-?)0+(?=[0-9])", "$1")
    bare = F.regexp_replace(bare, r"(\.[0-9]*?)0+$", "$1")
    return F.regexp_replace(F.regexp_replace(bare, r"\.$", ""), r"^(-?)(?=\.)", "$10")


def _same_digits(a: Column, b: Column) -> Column:
    """False where numbers differ only in digits that RESULT_DECIMAL drops; unknown text doesn't count.

    Texts with an exponent compare as doubles, others digit by digit.
    """
    finer = r"\.[0-9]{12}[0-9]*[1-9]|[eE]-"
    exponent = a.rlike("[eE]") | b.rlike("[eE]")
    exact = F.when(exponent, a.try_cast("double") == b.try_cast("double")).otherwise(_plain(a) == _plain(b))
    return F.coalesce(F.when(a.rlike(finer) | b.rlike(finer), exact), F.lit(True))


def _loose_text_equal(a: Column, b: Column) -> Column:
    both = a.rlike(DECIMAL) & b.rlike(DECIMAL)
    numbers = F.coalesce(a.try_cast(RESULT_DECIMAL) == b.try_cast(RESULT_DECIMAL), a == b) & _same_digits(a, b)
    return F.when(both, numbers).otherwise(a.eqNullSafe(b))


def result_equals(a: Column, b: Column) -> Column:
    """Same value, whatever the number type; arrays element by element; NULL equals NULL.

    Both arguments are ``struct(kind, num, text, arr)``.
    """
    numeric = a["kind"].isin(*NUMERIC_KINDS) & b["kind"].isin(*NUMERIC_KINDS)
    same_number = F.coalesce(a["num"] == b["num"], a["text"] == b["text"], F.lit(False))
    same_number = same_number & _same_digits(a["text"], b["text"])
    arrays = (a["kind"] == "array") & (b["kind"] == "array")
    same_array = (F.size(a["arr"]) == F.size(b["arr"])) & F.forall(
        F.zip_with(a["arr"], b["arr"], _loose_text_equal), lambda x: x
    )
    return (
        F.when(a["kind"].isNull() | b["kind"].isNull(), a["kind"].isNull() & b["kind"].isNull())
        .when(numeric, same_number)
        .when(arrays, F.coalesce(same_array, F.lit(False)))
        .when(a["kind"] == b["kind"], a["text"].eqNullSafe(b["text"]))
        .otherwise(F.lit(False))
    )


def after_last_slash(text: Column) -> Column:
    return F.substring_index(text, "/", -1)


def camel_case(text: Column) -> Column:
    """``snake_case`` to ``camelCase``: lower case, a capital for every word after the first."""
    words = F.filter(F.split(F.lower(text), "_"), lambda w: w != "")
    joined = F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 30))), ""
    )
    return F.concat(F.lower(F.left(joined, F.lit(1))), F.substring(joined, 2, 1 << 30))


def first_column(df: DataFrame, names: Sequence[str], trim: bool = False) -> Column:
    """The first of several alternative columns that the record has."""
    for name in names:
        if name in df.columns:
            return F.trim(quoted(name)) if trim else quoted(name)
    raise ValueError(f"none of the columns {list(names)} is in the record")
