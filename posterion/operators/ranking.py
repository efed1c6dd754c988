"""Exact order statistics, ranks and near-equal groups without a single-task sort."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from posterion.functions.scalars import INTEGRAL, NUMERIC, hash_bits, interval_index, lookup, quoted
from posterion.sources.storage import sized

EXACT_VALUES = 500_000       # distinct values the built-in exact percentile may hold
ACCURACY = 20_000            # of the approximate percentile used for narrowing


def order_statistics(df: DataFrame, targets: list[tuple[Column, int]]) -> list[float | None]:
    """The value at each 0-based rank of each expression (nulls left out), exactly.

    The built-in percentile keeps every distinct value in one task, so it is used only after
    the range around the rank holds few enough of them; approximate percentiles, whose rank
    error is bounded, narrow the range first. Every step is a scan with map-side sums.
    """
    if not targets:
        return []
    state = []
    row = df.agg(*[f.alias(f"{n}{i}") for i, (e, _) in enumerate(targets)
                   for n, f in (("n", F.count(e)), ("d", F.approx_count_distinct(e)))]).head()
    for i, (e, rank) in enumerate(targets):
        n = row[f"n{i}"]
        state.append({"lo": None, "hi": None, "below": 0, "inside": n, "distinct": row[f"d{i}"],
                      "ok": 0 <= rank < n})

    def inside(i) -> Column:
        e, s = targets[i][0], state[i]
        if s["lo"] is None:
            return e
        return F.when((e >= F.lit(s["lo"])) & (e <= F.lit(s["hi"])), e)

    while True:
        wide = [i for i, s in enumerate(state) if s["ok"] and s["distinct"] > EXACT_VALUES]
        if not wide:
            break
        aggs = []
        for i in wide:
            q = (targets[i][1] - state[i]["below"] + 0.5) / state[i]["inside"]
            margin = 2.0 / ACCURACY
            aggs.append(F.percentile_approx(inside(i), [max(q - margin, 0.0), min(q + margin, 1.0)], ACCURACY).alias(f"q{i}"))
        found = df.agg(*aggs).head()
        for i in wide:
            state[i]["lo"], state[i]["hi"] = found[f"q{i}"]
        counts = df.agg(*[f.alias(f"{n}{i}") for i in wide for n, f in (
            ("b", F.count_if(targets[i][0] < F.lit(state[i]["lo"]))), ("n", F.count(inside(i))),
            ("d", F.approx_count_distinct(inside(i))))]).head()
        for i in wide:
            state[i].update(below=counts[f"b{i}"], inside=counts[f"n{i}"], distinct=counts[f"d{i}"])
    good = [i for i, s in enumerate(state) if s["ok"]]
    if not good:
        return [None] * len(targets)
    shares = {i: (targets[i][1] - state[i]["below"] + 0.5) / state[i]["inside"] for i in good}
    row = df.select(*[inside(i).alias(f"t{i}") for i in good]).agg(*[
        F.expr(f"percentile_disc({shares[i]!r}D) within group (order by t{i})").alias(f"v{i}") for i in good
    ]).head().asDict()
    return [row.get(f"v{i}") for i in range(len(targets))]


def quantiles(df: DataFrame, columns: dict[str, Column], fractions, *, approx: bool = False) -> dict[str, list[float]]:
    """Interpolated quantiles of several columns; `approx` trades exactness for one scan."""
    fractions = [float(f) for f in fractions]
    if not columns:
        return {}
    if approx:
        row = df.agg(*[F.percentile_approx(c, fractions, ACCURACY).alias(f"p{i}")
                       for i, c in enumerate(columns.values())]).head()
        return {n: row[f"p{i}"] for i, n in enumerate(columns)}
    row = df.agg(*[f.alias(f"{k}{i}") for i, c in enumerate(columns.values())
                   for k, f in (("n", F.count(c)), ("d", F.approx_count_distinct(c)))]).head()
    narrow = {n: c for i, (n, c) in enumerate(columns.items()) if row[f"d{i}"] <= EXACT_VALUES}
    result: dict[str, list[float]] = {}
    if narrow:
        got = df.agg(*[F.percentile(c, F.array(*[F.lit(f) for f in fractions])).alias(f"p{i}")
                       for i, c in enumerate(narrow.values())]).head()
        result = {n: got[f"p{i}"] for i, n in enumerate(narrow)}
    targets, places = [], []
    for i, (n, c) in enumerate(columns.items()):
        if n not in narrow:
            for f in fractions:
                position = f * (row[f"n{i}"] - 1)
                lo, hi = math.floor(position), math.ceil(position)
                places.append((n, position - lo))
                targets += [(c, lo), (c, hi)]
    values = order_statistics(df, targets)
    for k, (n, part) in enumerate(places):
        lo, hi = values[2 * k], values[2 * k + 1]
        result.setdefault(n, []).append(lo + (hi - lo) * part)
    return result


def group_sizes(n: int, k: int) -> list[int]:
    """Sizes of k near-equal groups: the first n mod k groups get one more."""
    return [n // k + (1 if i < n % k else 0) for i in range(k)]


def near_equal_groups(df: DataFrame, value: str, id_col: str, k: int, *, name: str) -> DataFrame:
    """Group number 1..k by (value, id) ascending, like ntile(k) over the whole table.

    Only the k-1 boundary rows are located (exactly); each row then compares itself with
    them. No sort, no shuffle, and ties of any size are split by id. Integral ids are exact in
    all 64 bits; other numeric ids count as doubles; ids that are no numbers come in the order of
    their 64-bit hash.
    """
    v, ident = quoted(value).cast("double"), quoted(id_col)
    whole = isinstance(df.schema[id_col].dataType, INTEGRAL)
    if not isinstance(df.schema[id_col].dataType, NUMERIC):
        ident, whole = F.xxhash64(ident), True
    n = df.agg(F.count(v)).head()[0]
    starts, at = [], 0
    for size in group_sizes(n, k)[:-1]:
        at += size
        starts.append(at)
    ranks = [s for s in starts if s < n]
    values = order_statistics(df, [(v, r) for r in ranks])
    below = df.agg(*[F.count_if(v < F.lit(x)).alias(f"b{i}") for i, x in enumerate(values)]).head() if values else ()
    tied = [(v == F.lit(x), r - below[i]) for i, (x, r) in enumerate(zip(values, ranks))]
    ids = _id_statistics(df, ident.cast("bigint"), tied) if whole else order_statistics(
        df, [(F.when(ok, ident.cast("double")), r) for ok, r in tied])
    group = F.lit(1)
    for x, i in zip(values, ids):
        group = group + F.when((v > F.lit(x)) | ((v == F.lit(x)) & (ident >= F.lit(i))), 1).otherwise(0)
    return df.withColumn(name, F.when(v.isNotNull(), group))


def _id_statistics(df: DataFrame, ident: Column, tied) -> list[int]:
    """The id at a rank among the rows that meet a condition, for each (condition, rank).

    A double holds 53 bits, so the upper and the lower 32 bits are found one after the other.
    """
    high, low = F.shiftright(ident, 32), ident.bitwiseAND(F.lit(0xFFFFFFFF))
    tops = [int(t) for t in order_statistics(df, [(F.when(ok, high.cast("double")), r) for ok, r in tied])]
    if not tops:
        return []
    below = df.agg(*[F.count_if(ok & (high < F.lit(t))).alias(f"b{i}") for i, ((ok, _), t) in enumerate(zip(tied, tops))]).head()
    rest = order_statistics(df, [(F.when(ok & (high == F.lit(t)), low.cast("double")), r - below[i])
                                 for i, ((ok, r), t) in enumerate(zip(tied, tops))])
    return [(t << 32) + int(x) for t, x in zip(tops, rest)]


def hashed_rank(df: DataFrame, id_col: str, seed, *, by: str | None = None, buckets: int | None = None,
                name: str = "rank") -> DataFrame:
    """Exact 1-based rank in hash order, overall or within a class, as a two-level count.

    The hash is uniform, so equal hash ranges are equal work: rows are numbered inside
    (class, range), and a small table of range sizes gives each range its offset. A class
    with a third of all rows is spread over all ranges. The number of ranges follows the row
    count, so a range stays near half a million rows.
    """
    if buckets is None:
        buckets = max(256, min(1_000_000, df.count() // 500_000))
    h = hash_bits(quoted(id_col), seed)
    part = [quoted(by)] if by else []
    base = df.withColumn("__h", h).withColumn("__b", F.floor(F.col("__h") * buckets / 4294967296).cast("int"))
    sizes = base.groupBy(*part, "__b").agg(F.count(F.lit(1)).alias("__n"))
    # the size table has at most classes x buckets rows; per class it is one short running sum
    up_to = Window.partitionBy(*part).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1) if by else \
        Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(*part) if by else Window.partitionBy(F.lit(0))
    offsets = sizes.select(*[c.alias("__by") for c in part], F.col("__b").alias("__ob"),
                           F.coalesce(F.sum("__n").over(up_to), F.lit(0)).alias("__off"),
                           F.sum("__n").over(total).alias("__total"))
    local = Window.partitionBy(*part, "__b").orderBy("__h", quoted(id_col))
    numbered = base.withColumn("__r", F.row_number().over(local))
    match = F.col("__b") == F.col("__ob")
    if by:
        match = match & quoted(by).eqNullSafe(F.col("__by"))
    out = numbered.join(sized(offsets), match, "inner")
    return out.select(*[quoted(c) for c in df.columns], (F.col("__off") + F.col("__r")).cast("bigint").alias(name),
                      F.col("__total").cast("bigint").alias(f"{name}_of"))


def group_of_rank(rank: Column, total: Column, k: int) -> Column:
    """ntile group of a 1-based rank: the first total mod k groups have one more row."""
    base, extra = F.floor(total / k), total % k
    cut = extra * (base + 1)
    return F.when(rank <= cut, F.ceil(rank / (base + 1))).otherwise(extra + F.ceil((rank - cut) / F.greatest(base, F.lit(1)))).cast("int")


def dense_ids(df: DataFrame, order_col: str, *, name: str = "ix", ranges: int = 64, parts: int = 256) -> DataFrame:
    """1..N by a unique numeric column, nulls last, numbered inside value ranges plus range offsets.

    Ranges hold equal shares of rows (approximate percentiles) and each is cut into equal-width
    parts, so the numbering runs in up to ranges x parts separate groups. Rows without a value
    follow in as many groups by hash.
    """
    v = quoted(order_col)
    row = df.agg(F.percentile_approx(v, [i / ranges for i in range(1, ranges)], ACCURACY).alias("q"),
                 F.min(v).alias("lo"), F.max(v).alias("hi")).head()
    cuts = sorted(set(row["q"] or []))
    low, high = (0, 0) if row["lo"] is None else (row["lo"], row["hi"])
    starts, ends = [low, *cuts], [*cuts, high]
    width = [max(float(b - a), 1e-300) for a, b in zip(starts, ends)]
    ranged = df.withColumn("__c", interval_index(v, cuts))
    part = F.floor((v - lookup(starts, F.col("__c"))) / lookup(width, F.col("__c")) * parts)
    # maps have no hash
    hashed = [quoted(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    last = F.lit(len(starts) * parts) + F.pmod(F.xxhash64(*hashed), F.lit(parts)).cast("int")
    base = ranged.withColumn("__b", F.when(v.isNull(), last).otherwise(F.col("__c") * parts + F.least(F.lit(parts - 1), part).cast("int")))
    sizes = base.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("__b").alias("__ob"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    numbered = base.withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy(v.asc_nulls_last())))
    # at most ranges x parts offsets
    return numbered.join(F.broadcast(offsets), F.col("__b") == F.col("__ob")).select(
        *[quoted(c) for c in df.columns], (F.col("__off") + F.col("__r")).cast("bigint").alias(name))
