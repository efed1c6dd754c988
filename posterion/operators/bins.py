"""Discretisation: bin edges from the data, interval membership, histogram CDF."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from posterion.functions.scalars import (NUMERIC, as_double, interval_index, lookup, quoted, state_text)
from posterion.operators.ranking import quantiles
from posterion.plans.network import Network, Variable
from posterion.sources.storage import BROADCAST_BYTES

MAX_STATES = 100_000         # values a discrete column may have
DIRECT_BINS = 128            # bins written as one comparison tree


@dataclass(frozen=True)
class Interval:
    lo: float
    hi: float
    lo_closed: bool = True
    hi_closed: bool = False


def _values(df: DataFrame, columns) -> dict[str, Column]:
    fields = {f.name: f.dataType for f in df.schema.fields}
    return {c: as_double(quoted(c), fields[c]) for c in columns}


def discover_states(df: DataFrame, columns) -> DataFrame:
    """`variable, state, ord, value_type` of every non-null distinct value, all columns in
    one job; states are ordered by value. Integral numbers give INTEGER states."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    entries = []
    for c in columns:
        t = fields[c]
        number = quoted(c).cast("double") if isinstance(t, NUMERIC + (T.BooleanType,)) else F.lit(None).cast("double")
        kind = "BOOLEAN" if isinstance(t, T.BooleanType) else "NUMBER" if isinstance(t, NUMERIC) else "NONE"
        entries.append(F.struct(F.lit(c).alias("variable"), state_text(quoted(c), t).alias("state"),
                                number.alias("number"), F.lit(kind).alias("kind")))
    guess = df.agg(*[F.approx_count_distinct(quoted(c)).alias(f"a{i}") for i, c in enumerate(columns)]).head()
    wide = [c for i, c in enumerate(columns) if guess[f"a{i}"] > MAX_STATES]
    if wide:
        raise ValueError(f"{wide} have more than {MAX_STATES} values: bin them, or treat them as continuous")
    long = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter(F.col("state").isNotNull())
    distinct = long.groupBy("variable", "state", "number", "kind").agg(F.lit(1).alias("__one"))
    w = Window.partitionBy("variable")
    whole = F.min(F.when(F.col("number") == F.floor("number"), 1).otherwise(0)).over(w) == 1
    value_type = (F.when(F.col("kind") == "BOOLEAN", "BOOLEAN").when(F.col("kind") == "NONE", "NONE")
                  .when(whole, "INTEGER").otherwise("NONE"))
    return distinct.select("variable", "state",
                           (F.row_number().over(w.orderBy("number", "state")) - 1).alias("ord"),
                           value_type.alias("value_type"))


def equal_frequency_edges(df: DataFrame, columns, bins: int = 4, *, infinite_extremes: bool = True,
                          approx: bool = False) -> dict[str, list[float]]:
    """Edges at k/bins quantiles of every column, duplicates merged."""
    got = quantiles(df, _values(df, columns), [k / bins for k in range(bins + 1)], approx=approx)
    return {c: _edges(q, infinite_extremes) for c, q in got.items()}


def _edges(points, infinite_extremes: bool) -> list[float]:
    if not points or points[0] is None:
        return [-math.inf, math.inf]
    inner = sorted(set(points[1:-1]))
    lo, hi = (-math.inf, math.inf) if infinite_extremes else (points[0], points[-1])
    return [lo, *[p for p in inner if lo < p < hi], hi]


def equal_frequency(df: DataFrame, columns, bins: int = 4, *, infinite_extremes: bool = True, zero_crossing: bool = False,
                    approx: bool = False) -> dict[str, list[Interval]]:
    """Equal-frequency bins of all columns from one aggregate."""
    edges = equal_frequency_edges(df, columns, bins, infinite_extremes=infinite_extremes, approx=approx)
    return {c: _finish(from_edges(e), zero_crossing, infinite_extremes) for c, e in edges.items()}


def equal_width(df: DataFrame, columns, bins: int = 4, *, infinite_extremes: bool = True,
                zero_crossing: bool = False) -> dict[str, list[Interval]]:
    """D3: bins of equal width between min and max, one aggregate for all columns."""
    values = _values(df, columns)
    row = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(values.values())
                   for n, f in (("lo", F.min), ("hi", F.max))]).head()
    out = {}
    for i, c in enumerate(values):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        points = [None] if lo is None else [lo + k * (hi - lo) / bins for k in range(bins + 1)]
        out[c] = _finish(from_edges(_edges(points, infinite_extremes)), zero_crossing, infinite_extremes)
    return out


def _finish(intervals, crossing: bool, infinite: bool):
    if not infinite and intervals:
        intervals = intervals[:-1] + [replace(intervals[-1], hi_closed=True)]
    return zero_crossing(intervals) if crossing else intervals


def from_edges(edges) -> list[Interval]:
    """Consecutive [lo, hi) intervals."""
    return [Interval(float(a), float(b)) for a, b in zip(edges[:-1], edges[1:])]


def defined(bounds) -> list[Interval]:
    """(lo, hi) pairs, or (lo, hi, lo_closed, hi_closed)."""
    return [Interval(*b) for b in bounds]


def zero_crossing(intervals: list[Interval]) -> list[Interval]:
    """When 0.5 lies below the first bin's end, that bin starts at 0.5 and a zero bin precedes it."""
    if intervals and 0.5 < intervals[0].hi:
        return [Interval(-math.inf, 0.5), replace(intervals[0], lo=0.5, lo_closed=True), *intervals[1:]]
    return intervals


def _text(v: Column, decimals: int) -> Column:
    number = F.format_string(f"%.{decimals}f", F.round(v, decimals))
    return F.when(v == F.lit(math.inf), "inf").when(v == F.lit(-math.inf), "-inf").otherwise(number)


def interval_label(lo: Column, hi: Column, lo_closed: Column, hi_closed: Column, decimals: int = 4) -> Column:
    """`[a,b)` text with fixed decimals."""
    return F.concat(F.when(lo_closed, "[").otherwise("("), _text(lo, decimals), F.lit(","), _text(hi, decimals),
                    F.when(hi_closed, "]").otherwise(")"))


def label(i: Interval, decimals: int = 4) -> str:
    def text(v: float) -> str:
        return ("inf" if v > 0 else "-inf") if math.isinf(v) else f"{round(v, decimals):.{decimals}f}"
    return f"{'[' if i.lo_closed else '('}{text(i.lo)},{text(i.hi)}{']' if i.hi_closed else ')'}"


def bins_frame(spark: SparkSession, bins: dict[str, list[Interval]], decimals: int = 4) -> DataFrame:
    """`variable, ord, lo, hi, lo_closed, hi_closed, label`."""
    rows = [(c, i, b.lo, b.hi, b.lo_closed, b.hi_closed) for c, bs in bins.items() for i, b in enumerate(bs)]
    frame = spark.createDataFrame(rows, "variable string, ord int, lo double, hi double, lo_closed boolean, hi_closed boolean")
    return frame.withColumn("label", interval_label(F.col("lo"), F.col("hi"), F.col("lo_closed"), F.col("hi_closed"), decimals))


def _is_chain(bins: list[Interval]) -> bool:
    return all(b.lo_closed and not b.hi_closed for b in bins) and all(a.hi == b.lo for a, b in zip(bins, bins[1:]))


def interval_position(v: Column, bins: list[Interval]) -> Column:
    """Position of the bin that admits the value; missing when none does."""
    if _is_chain(bins) and len(bins) > 1:
        inside = (v >= F.lit(bins[0].lo)) & (v < F.lit(bins[-1].hi)) if not math.isinf(bins[0].lo) or not math.isinf(
            bins[-1].hi) else v.isNotNull()
        return F.when(inside, interval_index(v, [b.lo for b in bins[1:]]))
    expr = None
    for i, b in enumerate(bins):
        ok = (v >= F.lit(b.lo) if b.lo_closed else v > F.lit(b.lo)) & (v <= F.lit(b.hi) if b.hi_closed else v < F.lit(b.hi))
        expr = F.when(ok, F.lit(i)) if expr is None else expr.when(ok, F.lit(i))
    return expr


def _apart(bins: list[Interval]) -> list[tuple[Interval, str]]:
    """Disjoint pieces of the bins in order, each with the label of the first bin that admits it."""
    ends = sorted({float(e) for b in bins for e in (b.lo, b.hi)})
    pieces = []
    for i, e in enumerate(ends):
        pieces.append(Interval(e, e, True, True))
        if i + 1 < len(ends):
            pieces.append(Interval(e, ends[i + 1], False, False))

    def admits(b: Interval, p: Interval) -> bool:
        return (b.lo < p.lo or b.lo == p.lo and (b.lo_closed or not p.lo_closed)) and (
            p.hi < b.hi or p.hi == b.hi and (b.hi_closed or not p.hi_closed))

    first = ((p, next((b for b in bins if admits(b, p)), None)) for p in pieces)
    return [(p, label(b)) for p, b in first if b is not None]


def assign(df: DataFrame, column: str, bins: list[Interval], *, name: str) -> DataFrame:
    """The label of the first bin that admits each value. Long bin lists become an equi-join
    on equal-width cells of disjoint pieces followed by the interval test, never a product of
    rows and bins; both ways give the same rows."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    v = as_double(quoted(column), fields[column])
    if len(bins) <= DIRECT_BINS:
        names = F.array(*[F.lit(label(b)) for b in bins])
        return df.withColumn(name, F.get(names, interval_position(v, bins)))
    finite = sorted(e for b in bins for e in (b.lo, b.hi) if not math.isinf(e))
    lo, span, cells = finite[0], max(finite[-1] - finite[0], 1e-300), 4 * len(bins)

    def cell(x: float) -> int:
        return 0 if x <= lo else cells - 1 if x >= finite[-1] else min(cells - 1, math.floor((x - lo) / span * cells))

    rows = [(g, b.lo, b.hi, b.lo_closed, b.hi_closed, text) for b, text in _apart(bins) for g in range(cell(b.lo), cell(b.hi) + 1)]
    table = df.sparkSession.createDataFrame(
        rows, "__g int, __lo double, __hi double, __lc boolean, __hc boolean, __label string")
    place = F.floor((F.col("__v") - F.lit(lo)) / F.lit(span) * cells)
    inside = F.when(F.col("__v") <= lo, 0).when(F.col("__v") >= finite[-1], cells - 1).otherwise(F.least(F.lit(cells - 1), place)).cast("int")
    keyed = df.withColumn("__v", v).withColumn("__k", F.when(F.col("__v").isNotNull(), inside))
    ok = (F.col("__k") == F.col("__g")) & ((F.col("__v") > F.col("__lo")) | (F.col("__lc") & (F.col("__v") == F.col("__lo")))) & (
        (F.col("__v") < F.col("__hi")) | (F.col("__hc") & (F.col("__v") == F.col("__hi"))))
    small = F.broadcast(table) if 64 * len(rows) <= BROADCAST_BYTES else table
    return keyed.join(small, ok, "left").select(*[quoted(c) for c in df.columns], F.col("__label").alias(name))


def discretise(df: DataFrame, network: Network, columns, *, mode: str = "frequency", bin_count: int = 4,
               bins: dict[str, list[Interval]] | None = None, approx: bool = False) -> tuple[DataFrame, Network]:
    """Chosen continuous columns become their bins; each keeps its own links."""
    bins = dict(bins or {})
    todo = [c for c in columns if c not in bins]
    if todo:
        found = equal_frequency(df, todo, bin_count, approx=approx) if mode == "frequency" else equal_width(df, todo, bin_count)
        bins.update(found)
    for c in columns:
        df = assign(df, c, bins[c], name=c)
    variables = tuple(Variable(v.name, "discrete", tuple(label(b) for b in bins[v.name])) if v.name in columns else v
                      for v in network.variables)
    kept = tuple(b for b in network.blocks if not set(b) & set(columns))
    return df, Network(variables, network.edges, kept)


def zero_indicator(v: Column) -> Column:
    """State `0` below 0.5, else `1`."""
    return F.when(v < 0.5, "0").when(v >= 0.5, "1")


def with_zero_indicator(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(f"{column}_0Node", zero_indicator(quoted(column).cast("double")))


def histogram_cdf(df: DataFrame, column: str, bins: int = 10, *, name: str = "cdf") -> DataFrame:
    """Cumulative share of each value under an equal-width histogram, linear inside a bin."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    v = as_double(quoted(column), fields[column])
    row = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).head()
    lo, hi = row["lo"], row["hi"]
    if lo is None or lo == hi:
        return df.withColumn(name, F.when(v.isNotNull(), F.lit(1.0)))
    width = (hi - lo) / bins
    place = (v - F.lit(lo)) / F.lit(width)
    bucket = F.least(F.floor(place).cast("int"), F.lit(bins - 1))
    counts = {r["b"]: r["n"] for r in df.filter(v.isNotNull()).groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    before = [sum(counts.get(j, 0) for j in range(i)) / total for i in range(bins)]
    share = [counts.get(i, 0) / total for i in range(bins)]
    return df.withColumn(name, lookup(before, bucket) + lookup(share, bucket) * (place - bucket))
