"""Column expressions shared by every operator; all stay on the JVM side."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F, types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
NUMERIC = INTEGRAL + FLOATING + (T.DecimalType,)
VARIANCE_FLOOR = 1e-6


def quoted(name: str) -> Column:
    """Column by its exact name, also when it holds dots, colons or `$$`."""
    return F.col("`" + name.replace("`", "``") + "`")


def rounded(c: Column, digits: int) -> Column:
    """Round and turn -0.0 into 0.0, so that results compare by value."""
    return F.round(c, digits) + F.lit(0.0)


def const_array(values) -> Column:
    """A constant array<double>; foldable, so it is one literal in the plan."""
    text = ",".join(repr(float(v)) for v in values)
    return F.split(F.lit(text), ",").cast("array<double>")


def lookup(values, index: Column) -> Column:
    """values[index]; null when the index is null."""
    return F.get(const_array(values), index)


def as_double(c: Column, dtype: T.DataType) -> Column:
    """Numeric column as double, with NaN and infinities read as missing."""
    d = c.cast("double")
    if isinstance(dtype, FLOATING):
        return F.when(F.isnan(d) | (F.abs(d) == F.lit(math.inf)), None).otherwise(d)
    return d


def finite(c: Column) -> Column:
    """Infinities become null."""
    return F.when(F.abs(c) == F.lit(math.inf), None).otherwise(c)


def state_text(c: Column, dtype: T.DataType) -> Column:
    """State name of a discrete value; integral doubles are named like integers."""
    if isinstance(dtype, FLOATING + (T.DecimalType,)):
        d = c.cast("double")
        whole = (d == F.floor(d)) & (F.abs(d) < 1e15)
        return F.when(F.isnan(d), None).when(whole, d.cast("bigint").cast("string")).otherwise(d.cast("string"))
    return c.cast("string")


def typed_state(state: str, dtype: T.DataType):
    """The state name as a value of the column's own type (None when it is none)."""
    try:
        if isinstance(dtype, INTEGRAL):
            return int(state)
        if isinstance(dtype, FLOATING + (T.DecimalType,)):
            return float(state)
    except ValueError:
        return None
    if isinstance(dtype, T.BooleanType):
        return {"true": True, "false": False}.get(state.lower())
    return state


def _branches(bounds: list, leaf, below, lo: int, hi: int) -> Column:
    """Balanced `case when` tree: log2(n) comparisons per row instead of n."""
    if hi - lo <= 3:
        expr = leaf(hi)
        for i in range(hi - 1, lo - 1, -1):
            expr = F.when(below(bounds[i]), leaf(i)).otherwise(expr)
        return expr
    mid = (lo + hi) // 2
    return F.when(below(bounds[mid - 1]), _branches(bounds, leaf, below, lo, mid - 1)).otherwise(
        _branches(bounds, leaf, below, mid, hi))


def interval_index(c: Column, cuts) -> Column:
    """Number of cuts at or below the value: 0 for v < cuts[0], and so on."""
    cuts = list(cuts)
    if not cuts:
        return F.when(c.isNotNull(), F.lit(0))
    tree = _branches(cuts, lambda i: F.lit(i), lambda b: c < F.lit(b), 0, len(cuts))
    return F.when(c.isNotNull(), tree)


def state_index(c: Column, states, dtype: T.DataType = T.StringType()) -> Column:
    """Position of the value in the state list; null for missing or unknown states."""
    pairs = [(typed_state(s, dtype), i) for i, s in enumerate(states)]
    pairs = sorted((v, i) for v, i in pairs if v is not None)
    if not pairs:
        return F.lit(None).cast("int")
    if len(pairs) == 1:
        return F.when(c == F.lit(pairs[0][0]), F.lit(pairs[0][1]))
    values = [v for v, _ in pairs]
    tree = _branches(values[1:], lambda i: F.when(c == F.lit(values[i]), F.lit(pairs[i][1])),
                     lambda b: c < F.lit(b), 0, len(values) - 1)
    return F.when(c.isNotNull(), tree)


def key_text(c: Column) -> Column:
    """A state's text inside a parent key, where `|` parts the parents: `\\` and `|` are escaped."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def hash_bits(id_col: Column, seed) -> Column:
    """32 reproducible bits per (id, seed) as bigint: first 8 hex digits of md5(id:seed)."""
    text = F.concat(id_col.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_uniform(id_col: Column, seed) -> Column:
    """Reproducible uniform in [0, 1) per (id, seed)."""
    return hash_bits(id_col, seed) / F.lit(4294967296.0)


def hash_normal(id_col: Column, seed) -> Column:
    """Standard normal by Box-Muller from two hash uniforms."""
    u1 = F.greatest(hash_uniform(id_col, f"{seed}a"), F.lit(2.0 ** -32))
    u2 = hash_uniform(id_col, f"{seed}b")
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def replace_zero_with_normal(c: Column, id_col: Column, seed, std: float = 3.0) -> Column:
    """Zeros replaced by reproducible N(0, std) draws."""
    return F.when(c == 0, F.lit(std) * hash_normal(id_col, seed)).otherwise(c)


def log_sum_exp(scores: list[Column]) -> Column:
    """ln(sum(exp(s))) without overflow; null when every term is -inf or null."""
    if len(scores) == 1:
        return finite(scores[0])
    top = finite(F.greatest(*scores))
    total = sum((F.exp(s - top) for s in scores[1:]), F.exp(scores[0] - top))
    return top + F.ln(total)


def normal_log_density(x: Column, mean: Column, var: Column) -> Column:
    dev = x - mean
    return F.lit(-0.5) * F.ln(F.lit(2 * math.pi) * var) - dev * dev / (F.lit(2.0) * var)


def pack_state(variable: Column, state: Column) -> Column:
    """`variable$$state`."""
    return F.concat(variable, F.lit("$$"), state)


def unpack_state(text: Column) -> tuple[Column, Column]:
    """T10 inverse."""
    return F.split_part(text, F.lit("$$"), F.lit(1)), F.split_part(text, F.lit("$$"), F.lit(2))


def cast_state(text: Column, dtype: str) -> Column:
    """A state name as a value of the wanted output type."""
    if dtype in ("bool", "boolean"):
        return F.when(text.isNotNull(), F.lower(text) == "true")
    return text.try_cast(dtype)


def first_token_match(text: Column, pattern: str) -> Column:
    """First whole match of the pattern among space-separated tokens ('' if none)."""
    hits = F.filter(F.transform(F.split(text, " "), lambda t: F.regexp_extract(t, pattern, 0)),
                    lambda t: t != "")
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(""))
