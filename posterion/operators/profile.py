"""Type inference, coercion and column pruning from a column profile of the table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from posterion.functions.scalars import INTEGRAL, NUMERIC, quoted

TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType, T.DayTimeIntervalType, T.YearMonthIntervalType)
NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
# a decimal number as both engines read it; suffixes and digit separators are not numbers
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


@dataclass(frozen=True)
class ColumnProfile:
    name: str
    dtype: T.DataType
    rows: int
    present: int
    distinct: int            # non-null distinct values (a lower bound when `exact` is False)
    exact: bool

    @property
    def values(self) -> int:
        """Distinct values with null counted as one value."""
        return self.distinct + (1 if self.present < self.rows else 0)


def profile(df: DataFrame, columns=None, *, limit: int | None = None, unique: bool = False) -> dict[str, ColumnProfile]:
    """Row, present and distinct counts of every column.

    With `limit`, an approximate count comes first and exact distinct counting is left to
    columns that may be near the limit, so wide-range columns are never shuffled for a
    question like "more than 150 states?". `unique` also settles columns near the row count.
    """
    fields = [f for f in df.schema.fields if (columns is None or f.name in columns) and not isinstance(f.dataType, NESTED)]
    if not fields:
        return {}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        aggs += [F.count(quoted(f.name)).alias(f"n{i}"), F.approx_count_distinct(quoted(f.name), 0.02).alias(f"a{i}")]
    row = df.agg(*aggs).head()
    need = []
    for i, f in enumerate(fields):
        guess = row[f"a{i}"]
        near_limit = limit is None or guess <= limit * 1.5 + 10
        near_rows = unique and guess >= 0.8 * row["rows"]
        if near_limit or near_rows:
            need.append(i)
    exact = df.agg(*[F.count_distinct(quoted(fields[i].name)).alias(f"d{i}") for i in need]).head() if need else None
    out = {}
    for i, f in enumerate(fields):
        known = i in need
        d = exact[f"d{i}"] if known else int(row[f"a{i}"] / 1.2)
        out[f.name] = ColumnProfile(f.name, f.dataType, row["rows"], row[f"n{i}"], d, known)
    return out


def _is_number(t: T.DataType) -> bool:
    return isinstance(t, NUMERIC)


def continuous_columns(df: DataFrame, *, limit: int = 20, discrete=(), continuous=(), columns=None,
                       found: dict[str, ColumnProfile] | None = None) -> dict[str, bool]:
    """Numeric columns with more than `limit` distinct values (null counts as one)."""
    found = found or profile(df, columns, limit=limit)
    return {n: (n not in discrete) and (n in continuous or (_is_number(p.dtype) and p.values > limit))
            for n, p in found.items()}


def discrete_columns(df: DataFrame, *, max_states: int = 150, limit: int = 20, discrete=(), continuous=(),
                     columns=None) -> dict[str, bool]:
    """Columns with 2 to `max_states` values that are not continuous, or are forced discrete."""
    found = profile(df, columns, limit=max(max_states, limit))
    is_continuous = continuous_columns(df, limit=limit, discrete=discrete, continuous=continuous, found=found)
    return {n: n not in continuous and 1 < p.values <= max_states and not isinstance(p.dtype, TEMPORAL)
            and (n in discrete or not is_continuous[n]) for n, p in found.items()}


def could_be_int(df: DataFrame, columns=None) -> dict[str, bool]:
    """Integer columns, and floating columns whose present values are all whole."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    floats = [f.name for f in fields if _is_number(f.dataType) and not isinstance(f.dataType, INTEGRAL)]
    row = df.agg(*[F.bool_and(quoted(c) == F.floor(quoted(c))).alias(f"w{i}") for i, c in enumerate(floats)]).head() if floats else None
    return {f.name: isinstance(f.dataType, INTEGRAL) or (f.name in floats and bool(row[f"w{floats.index(f.name)}"]))
            for f in fields}


def parse_number(c: Column) -> Column:
    return F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))


def coerce_to_numeric(df: DataFrame, *, cutoff: float = 0.10, ignore=()) -> tuple[DataFrame, dict[str, tuple[float | None, bool]]]:
    """T4: text columns whose distinct values mostly parse become numbers, failures null.
    Returns the table and (ratio of unparsable distinct values, converted) per column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in ignore]
    if not names:
        return df, {}
    row = df.agg(*[a for i, c in enumerate(names) for a in (
        F.count_distinct(quoted(c)).alias(f"d{i}"),
        F.count_distinct(F.when(parse_number(quoted(c)).isNotNull(), quoted(c))).alias(f"p{i}"))]).head()
    report: dict[str, tuple[float | None, bool]] = {}
    for i, c in enumerate(names):
        d, p = row[f"d{i}"], row[f"p{i}"]
        ratio = None if d == 0 else (d - p) / d
        report[c] = (ratio, ratio is None or ratio <= cutoff)
    return df.select(*[parse_number(quoted(c)).alias(c) if report.get(c, (0, False))[1] else quoted(c)
                       for c in df.columns]), report


def _truthy(c: Column, t: T.DataType) -> Column:
    if isinstance(t, T.StringType):
        return c.isNull() | (c != "")
    if isinstance(t, T.BooleanType):
        return c.isNull() | c
    return c.isNull() | (c != 0)


def coerce_to_boolean(df: DataFrame, *, ignore=()) -> tuple[DataFrame, dict[str, bool]]:
    """T5: two-valued columns whose truthy rows are exactly one of the two values become
    boolean; a null is truthy. Min, max and counts decide, in one scan."""
    fields = [f for f in df.schema.fields if f.name not in ignore and not isinstance(f.dataType, TEMPORAL + NESTED)]
    aggs = []
    for i, f in enumerate(fields):
        c = quoted(f.name)
        aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"),
                 F.sum(_truthy(c, f.dataType).cast("bigint")).alias(f"t{i}"), F.count(c).alias(f"n{i}")]
    row = df.agg(*aggs).head()
    maybe = [i for i in range(len(fields)) if row[f"lo{i}"] is not None and row[f"lo{i}"] != row[f"hi{i}"]]
    if maybe:
        counts = df.agg(*[F.count_if(quoted(fields[i].name) == F.lit(row[f"{e}{i}"])).alias(f"{e}{i}")
                          for i in maybe for e in ("lo", "hi")]).head()
    report = {f.name: False for f in fields}
    for i in maybe:
        lo, hi = counts[f"lo{i}"], counts[f"hi{i}"]
        two_valued = lo + hi == row[f"n{i}"]
        report[fields[i].name] = two_valued and row[f"t{i}"] in (lo, hi)
    types = {f.name: f.dataType for f in fields}
    return df.select(*[_truthy(quoted(c), types[c]).alias(c) if report.get(c) else quoted(c) for c in df.columns]), report


def keep_varying(found: dict[str, ColumnProfile], cutoff: int = 1) -> dict[str, bool]:
    """drop columns with at most `cutoff` values."""
    return {n: p.values > cutoff for n, p in found.items()}


def keep_not_unique(found: dict[str, ColumnProfile]) -> dict[str, bool]:
    """drop columns with one value per row."""
    return {n: p.values != p.rows for n, p in found.items()}


def keep_filled(found: dict[str, ColumnProfile], cutoff: float = 0.1) -> dict[str, bool]:
    """drop columns present in at most a `cutoff` share of rows."""
    return {n: p.rows > 0 and p.present / p.rows > cutoff for n, p in found.items()}


def keep_few_states(found: dict[str, ColumnProfile], num_states: int = 30) -> dict[str, bool]:
    """drop text columns with `num_states` values or more."""
    return {n: not (isinstance(p.dtype, T.StringType) and p.values >= num_states) for n, p in found.items()}


def apply_filters(found: dict[str, ColumnProfile], *, cutoff: int = 1, num_states: int = 30) -> dict[str, bool]:
    """F1, then F2, then F4 from one profile."""
    parts = [keep_varying(found, cutoff), keep_not_unique(found), keep_few_states(found, num_states)]
    return {n: all(p[n] for p in parts) for n in found}


def single_state_columns(df: DataFrame, discrete) -> list[str]:
    """discrete columns with at most one observed state. Min and max settle it."""
    if not discrete:
        return []
    row = df.agg(*[f(quoted(c)).alias(f"{n}{i}") for i, c in enumerate(discrete)
                   for n, f in (("lo", F.min), ("hi", F.max))]).head()
    return [c for i, c in enumerate(discrete) if row[f"lo{i}"] == row[f"hi{i}"]]


def report_frame(df: DataFrame, flags: dict[str, bool], name: str) -> DataFrame:
    """A (column_name, flag) frame."""
    return df.sparkSession.createDataFrame(sorted((n, bool(v)) for n, v in flags.items()), f"column_name string, {name} boolean")
