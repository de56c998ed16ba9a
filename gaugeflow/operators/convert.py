"""Records to observations: by column number, by column name, fan-out, wide tables, own code."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import props, templates, times, values
from gaugeflow.functions.steps import step
from gaugeflow.functions.templates import quoted
from gaugeflow.model import RESULT_DECIMAL
from gaugeflow.operators.lookup import map_datastream
from gaugeflow.sources.records import CELLS, data_columns

Parser = Callable[[Column], Column]


@dataclass(frozen=True)
class Converter:
    """How one record becomes one observation.

    Columns are numbers (``to_observations_by_index``) or names/templates (``..._by_name``).
    ``keys`` gives the datastream lookup: dimension column to a template over the record.
    Without ``keys`` the datastream is ``ds_id``/``kind`` as given.
    """

    result: int | str
    phen_time: Sequence[int | str]
    missing: str | None = None
    decimal: str | None = None
    percent: str = "reference"
    time_format: str | None = None
    zone: str = "UTC"
    result_time: int | str | None = None
    valid_time: Sequence[int | str] = ()
    unit: int | str | None = None
    conversions: Sequence[tuple[str, str, str]] = ()
    parameters: str | None = None
    keys: dict[str, str] = field(default_factory=dict)
    ds_id: str | None = None
    kind: str = "D"


_PASSED = ("src_file", "src_line", "seq")


def _cell(df: DataFrame, spec: int | str, by_index: bool) -> Column:
    columns = data_columns(df)
    if isinstance(spec, int) or by_index:
        # By the place in the record's own file, where the scan tells it.
        return F.coalesce(F.get(CELLS, F.lit(int(spec))), F.lit("")) if CELLS in df.columns else quoted(columns[int(spec)])
    return templates.path_template(spec, {c: t for c, t in df.dtypes if c in columns})


def _time_cells(df: DataFrame, specs: Sequence[int | str], by_index: bool) -> list[Column | str]:
    """Text columns, or an ISO duration where the entry is one and not a column."""
    out: list[Column | str] = []
    for spec in specs:
        is_duration = isinstance(spec, str) and spec not in df.columns and times.Period.parse(spec) is not None
        out.append(spec if is_duration else _cell(df, spec, by_index))
    return out


def _raw(df: DataFrame, spec: Converter, by_index: bool) -> Column:
    """The cells a converter uses, still as text, as one struct."""
    columns = data_columns(df)
    short = by_index and CELLS not in df.columns and int(spec.result) >= len(columns)

    def times_of(name: str, specs: Sequence[int | str]) -> list[Column]:
        cells = _time_cells(df, specs, by_index)
        texts = [F.lit(None).cast("string") if isinstance(c, str) else c for c in cells]
        return [t.alias(f"{name}{i}") for i, t in enumerate(texts)]

    optional = {
        "rt": None if spec.result_time is None else _cell(df, spec.result_time, by_index),
        "unit": None if spec.unit is None else _cell(df, spec.unit, by_index),
        "params": templates.template(spec.parameters, columns, templates.JSON) if spec.parameters else None,
    }
    return F.struct(
        (F.lit("") if short else _cell(df, spec.result, by_index)).alias("cell"),
        *times_of("pt", spec.phen_time),
        *times_of("vt", spec.valid_time),
        *[(F.lit(None).cast("string") if c is None else c).alias(n) for n, c in optional.items()],
        F.lit(spec.kind).alias("kind"),
        F.lit(spec.ds_id).cast("string").alias("ds_id"),
        F.array(*[templates.template(t, columns) for _, t in sorted(spec.keys.items())]).cast("array<string>").alias("keys"),
    )


def _durations(df: DataFrame, specs: Sequence[int | str], by_index: bool) -> list[str | None]:
    return [c if isinstance(c, str) else None for c in _time_cells(df, specs, by_index)]


def _settings(df: DataFrame, spec: Converter, by_index: bool) -> tuple:
    """Everything that decides how the raw cells are read, apart from which cells they are."""
    return (
        spec.missing, spec.decimal, spec.percent, spec.time_format, spec.zone, spec.result_time is None,
        tuple(_durations(df, spec.phen_time, by_index)), tuple(_durations(df, spec.valid_time, by_index)),
        spec.parameters is None,
    )


def _parse(flat: DataFrame, df: DataFrame, spec: Converter, by_index: bool) -> DataFrame:
    """Observation fields and a reject reason from the raw cells.

    In steps that the optimizer keeps apart, so each cell is parsed once, and each step is a generated method that
    the JVM compiles (it interprets those above 8000 bytes): times, results, then what is combined from them.
    """
    cell = F.col("cell")
    raw = ["cell", "pt0", "pt1", "vt0", "vt1", "rt", "params"]
    passed = [c for c in flat.columns if c not in raw]
    text = values.decimal_text(cell, spec.decimal) if spec.decimal else values.number_text(cell, spec.percent)
    missing = (
        values.is_missing(cell, equals=spec.missing) if by_index else values.is_missing(cell, regex=spec.missing)
    )

    def ends_of(name: str, specs: Sequence[int | str]):
        cells = [d or F.col(f"{name}{i}") for i, d in enumerate(_durations(df, specs, by_index))]
        parsed = times.endpoints(cells, spec.time_format, spec.zone)
        columns = {f"{name}{i}": e for i, e in enumerate(parsed) if not isinstance(e, times.Period)}
        refs = [e if isinstance(e, times.Period) else F.col(f"{name}{i}") for i, e in enumerate(parsed)]
        if len(cells) == 2 and not any(isinstance(e, times.Period) for e in parsed):
            columns[f"{name}_given"] = times.is_given(F.col(f"{name}1"))
            return columns, times.combine(refs, F.col(f"{name}_given"))
        return columns, times.combine(refs)

    phen_columns, phen = ends_of("pt", spec.phen_time)
    valid_columns, valid = ends_of("vt", spec.valid_time) if spec.valid_time else ({}, None)
    # The converter by number reads its result time without the configured pattern.
    rt = times.parse_time_ladder(F.col("rt"), None if by_index else spec.time_format, spec.zone)
    none = F.lit(None).cast("timestamp")
    result_time = {} if spec.result_time is None else {"result_time": rt}
    timed = step(step(flat, phen_columns), valid_columns | result_time)
    read = step(timed, {"number": text, "missing": missing})
    read = step(read, {"num": F.col("number").try_cast(RESULT_DECIMAL)})
    if spec.decimal:
        result = F.struct(F.lit("decimal").alias("kind"), F.col("number").alias("text"), F.col("num").alias("num"))
    else:
        result = values.tagged_result(cell, F.col("number"), F.col("num"))
    no_time = F.struct(none.alias("start"), none.alias("end"), F.lit(None).cast("string").alias("error"))
    combined = step(
        read,
        {
            "r": result,
            "p": phen,
            "v": no_time if valid is None else valid,
            "parameters": props.parameters(F.col("params")) if spec.parameters else F.lit(None).cast(props.MAP),
        },
    )
    if spec.result_time is None:
        combined = combined.withColumn("result_time", none)
    no_result = F.col("r.text").isNull() if spec.decimal else F.col("r").isNull()
    number = F.col("r.num")
    reject = F.when(F.col("missing"), "Missing value").when(no_result, "No result")
    reject = reject.when(F.col("p.error").isNotNull(), F.col("p.error"))
    reject = reject.when(F.col("v.error").isNotNull(), F.col("v.error"))
    if spec.result_time is not None:
        reject = reject.when(F.col("result_time").isNull(), "Could not parse time")
    return combined.select(
        *passed,
        F.when(~no_result, F.col("r.kind")).alias("result_kind"),
        number.alias("result_num"),
        F.col("r.text").alias("result_text"),
        F.col("p.start").alias("phen_start"),
        F.col("p.end").alias("phen_end"),
        "result_time",
        F.col("v.start").alias("valid_start"),
        F.col("v.end").alias("valid_end"),
        "parameters",
        reject.alias("reject"),
    )


def _by_branch(specs: Sequence[Converter], of: Callable[[Converter], object], value: Callable[[Converter], Column]) -> Column:
    """A column that depends on the row's branch, with one case per distinct setting ``of``."""
    groups: dict = {}
    for branch, spec in enumerate(specs):
        groups.setdefault(of(spec), (spec, []))[1].append(branch)
    if len(groups) == 1:
        return value(specs[0])
    out = None
    for spec, branches in groups.values():
        test = F.col("branch").isin(branches)
        out = F.when(test, value(spec)) if out is None else out.when(test, value(spec))
    return out


def _key_set(spec: Converter) -> tuple[str, ...]:
    return tuple(sorted(spec.keys))


def _attach_datastreams(flat: DataFrame, specs: Sequence[Converter], datastreams: DataFrame) -> DataFrame:
    """The datastream of every row, by the dimension columns its own converter names.

    Key sets are numbered; a row's key is its set's number with the values, and the datastreams are listed
    once per set with theirs. So one join serves all converters, and each datastream key is resolved once.
    """
    sets = sorted({_key_set(s) for s in specs} - {()})
    types = {k: datastreams.schema[k].dataType for names in sets for k in names}

    def as_key(names: Sequence[str], column: Callable[[int, str], Column]) -> Column:
        return F.array(*[column(i, k).cast("string") for i, k in enumerate(names)])

    def own_key(spec: Converter) -> Column:
        names = _key_set(spec)
        if not names:
            return F.lit(None).cast("struct<set:int,values:array<string>>")
        values_ = as_key(names, lambda i, k: F.col("keys")[i].try_cast(types[k]))
        key = F.struct(F.lit(sets.index(names)).alias("set"), values_.alias("values"))
        return F.when(~F.exists(values_, lambda v: v.isNull()), key)

    listed = [
        datastreams.filter(reduce(and_, [F.col(k).isNotNull() for k in names])).select(
            F.struct(F.lit(i).alias("set"), as_key(names, lambda _, k: F.col(k)).alias("values")).alias("key"), "kind", "ds_id", "uom"
        )
        for i, names in enumerate(sets)
    ]
    # The hash of the key goes first: sorting compares numbers and looks at the key itself only where they are equal.
    by_hash = {"hash": F.xxhash64("key"), "key": F.col("key")}
    known = reduce(DataFrame.unionAll, listed).withColumn("hash", by_hash["hash"])
    if len(sets) == 1 and all(_key_set(s) for s in specs):
        keyed = flat.drop("kind", "ds_id").withColumn("key", own_key(specs[0]))
        return map_datastream(keyed, known, by_hash).drop("key", "keys")
    keyed = flat.withColumnsRenamed({"kind": "_kind", "ds_id": "_ds_id"}).withColumn("key", _by_branch(specs, _key_set, own_key))
    mapped = map_datastream(keyed, known, by_hash)
    fixed = _by_branch(specs, lambda s: not s.keys, lambda s: F.lit(not s.keys))
    given = {"kind": F.col("_kind"), "ds_id": F.col("_ds_id"), "ds_status": F.lit("ok")}
    return mapped.withColumns({c: F.when(fixed, v).otherwise(F.col(c)) for c, v in given.items()}).drop("key", "keys", "_kind", "_ds_id")


def _attach(flat: DataFrame, specs: Sequence[Converter], datastreams: DataFrame | None) -> DataFrame:
    """Datastream lookup and unit conversion for projected observations."""
    if any(s.unit is not None and not s.keys for s in specs):
        raise ValueError("unit conversion needs the datastream's unit: give keys")
    if not any(s.keys for s in specs):
        return flat.drop("unit", "keys")
    if datastreams is None:
        raise ValueError("this converter looks up datastreams, but no datastreams are given")
    flat = _attach_datastreams(flat, specs, datastreams)
    lookup_reject = F.when(F.col("ds_status") == "not_found", "No Datastream").when(
        F.col("ds_status") == "ambiguous", "More than one Datastream"
    )
    flat = flat.withColumn("reject", F.coalesce("reject", lookup_reject)).drop("ds_status")
    if any(s.unit is not None for s in specs):
        target = F.col("ds_uom.symbol")
        has_unit = _by_branch(specs, lambda s: s.unit is None, lambda s: F.lit(s.unit is not None))
        same = ~has_unit | F.coalesce(F.col("unit") == target, F.lit(False))
        converted = _by_branch(
            specs,
            lambda s: tuple(map(tuple, s.conversions)),
            lambda s: values.convert_unit(F.col("result_num"), F.col("unit"), target, s.conversions),
        )
        message = F.concat(
            F.lit("Failed unit conversion from "), F.coalesce("unit", F.lit("")), F.lit(" to "), F.coalesce(target, F.lit(""))
        )
        changed = ~same & converted.isNotNull()
        flat = (
            flat.withColumn("reject", F.coalesce("reject", F.when(~same & converted.isNull(), message)))
            .withColumn("result_text", F.when(changed, converted.cast("string")).otherwise(F.col("result_text")))
            .withColumn("result_kind", F.when(changed, "decimal").otherwise(F.col("result_kind")))
            .withColumn("result_num", F.when(changed, converted).otherwise(F.col("result_num")))
        )
    return flat.drop("unit", "ds_uom")


def _convert(df: DataFrame, spec: Converter, datastreams: DataFrame | None, by_index: bool) -> DataFrame:
    passed = [c for c in _PASSED if c in df.columns]
    flat = df.select(*passed, _raw(df, spec, by_index).alias("o")).select(*passed, "o.*")
    return _attach(_parse(flat, df, spec, by_index), [spec], datastreams)


def to_observations_by_index(df: DataFrame, spec: Converter, datastreams: DataFrame | None = None) -> DataFrame:
    """Observations by column number, bad records marked with ``reject``."""
    return _convert(df, spec, datastreams, by_index=True)


def to_observations_by_name(df: DataFrame, spec: Converter, datastreams: DataFrame | None = None) -> DataFrame:
    """Observations by column name or template, bad records marked with ``reject``."""
    return _convert(df, spec, datastreams, by_index=False)


def fan_out(
    df: DataFrame, specs: Sequence[Converter], datastreams: DataFrame | None = None, by_index: bool = False
) -> DataFrame:
    """Several converters over one scan: every record yields one row per converter (``branch``).

    The cells of all branches are exploded as text and parsed after that, so the parsing is planned
    once however many converters there are. A branch that rejects a record does not affect the
    others. Each converter may look up its datastream by other columns and convert units in its own way: all
    lookups are one join. Converters that read their cells in different ways (formats, missing markers) make
    one scan per way.
    """
    passed = [c for c in _PASSED if c in df.columns]
    ways: dict[tuple, list[tuple[int, Converter]]] = {}
    for branch, spec in enumerate(specs):
        ways.setdefault(_settings(df, spec, by_index), []).append((branch, spec))
    parts = []
    for members in ways.values():
        cells = F.array(*[F.struct(F.lit(b).alias("branch"), _raw(df, s, by_index).alias("o")) for b, s in members])
        flat = df.select(*passed, F.explode(cells).alias("b")).select(*passed, "b.branch", "b.o.*")
        parts.append(_parse(flat, df, members[0][1], by_index))
    return _attach(union_observations(parts), specs, datastreams)


def union_observations(parts: Sequence[DataFrame]) -> DataFrame:
    """Append converter outputs by column name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject").isNull()).drop("reject")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject").isNotNull())


def unpivot_years(
    df: DataFrame,
    years: Sequence[str],
    id_parts: Sequence[str],
    id_col: str | None = None,
    interval: bool = True,
    separator: str = ",",
) -> DataFrame:
    """Wide year table to observations: ``*id_parts, phen_start, phen_end, result_num``.

    ``id_col`` (the first column by default) is a composite cell split into ``id_parts``. A year
    is the interval up to the next year, or its first instant. Cells that aren't numbers drop out.
    """
    id_col = id_col or df.columns[0]
    parts = F.split(quoted(id_col), separator)
    cells = F.array(*[F.struct(F.lit(y).alias("year"), quoted(y).cast("string").alias("cell")) for y in years])
    long = df.select(
        *[F.trim(F.get(parts, F.lit(i))).alias(n) for i, n in enumerate(id_parts)], F.explode(cells).alias("c")
    ).select(*id_parts, "c.*")
    year = F.regexp_extract("year", r"([0-9]{4})", 1).try_cast("int")

    def first_day(y: Column) -> Column:
        return F.make_timestamp(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))

    number = F.when(F.trim("cell").rlike(values.DECIMAL), F.trim("cell").try_cast(RESULT_DECIMAL))
    return long.select(
        *id_parts,
        first_day(year).alias("phen_start"),
        (first_day(year + 1) if interval else F.lit(None).cast("timestamp")).alias("phen_end"),
        number.alias("result_num"),
    ).filter(F.col("result_num").isNotNull())


def convert_with(df: DataFrame, fn: Callable[..., DataFrame], **options) -> DataFrame:
    """A user's own converter: any function from records to observations (0..n per record)."""
    return df.transform(fn, **options)


def convert_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """A user's own converter in Python over Arrow batches: ``fn(iterator of pandas frames)``."""
    return df.mapInPandas(fn, schema)
