"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight and a schedule that says how its share of the mix moves while training
runs from time 0 to 1 (a straight line between a start and an end intensity). Integrating the
schedule gives the source's cumulative demand for words; a document that stands at a cumulative
offset of its source takes the time at which the demand reaches that offset. Sorting documents
by that time is the training order.

Targets share all words by weight, but none exceeds `limit` times its source's size; the excess
is shared again by weight. A source is read in whole passes in hash order; the last pass ends
where the target is reached, so its last document counts in part.

Prefix sums of a source, however large, come in two levels: cells of some thousand documents
each (by hash) are summed first, the sums are accumulated over cells, and rows are numbered
inside their cell only.

Defined cases: null source is a source of its own (last in order); null or wordless text has
size 0 and takes nothing; repeated rows are separate documents; a source without words gets
target 0; reruns give the same rows, because order rests on hashes of ids and texts alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from posterion.llm.common import count_words, fresh, sized, staged

LIMIT = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
START_END = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))    # schedules by turn: early, even, late
CELL = 4096
SEED = 29


def shares(sizes: list[tuple[str | None, int]], weights=WEIGHTS, limit: float = LIMIT) -> dict[str | None, float]:
    """Target words of each source. Sources come by code point, null last; weights repeat."""
    order = sorted(sizes, key=lambda s: (s[0] is None, [ord(c) for c in s[0] or ""]))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    target: dict[str | None, float] = {}
    free = [s for s, n in order if n > 0]
    rest = float(sum(size.values()))
    while free:
        unit = rest / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > limit * size[s]]
        if not full:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in full:
            target[s] = limit * size[s]
            rest -= target[s]
        free = [s for s in free if s not in target]
    return {s: target.get(s, 0.0) for s in size}


def planned(docs: DataFrame, source: str = "source", text: str = "text", weights=WEIGHTS, limit: float = LIMIT,
            schedules=START_END, order=("doc_id",), cell: int = CELL) -> DataFrame:
    """Every row with size, source_size, target, taken and passes.

    passes is an array of (words, position): one entry for each reading of the document. The
    sources' sizes are collected to share the targets (one row a source) and return by broadcast of
    the same rows, so that no shuffle is keyed by the source alone.
    Rows carry what they came with, so leave the text out where it is not needed.
    """
    spark = docs.sparkSession
    made = {n: fresh(docs, n) for n in ("__src", "__hash", "__cell", "__before", "__base", "__at", "__n", "__ratio", "__a", "__b")}
    src, hashed, cell_no, at = made["__src"], made["__hash"], made["__cell"], made["__at"]
    rows = docs.withColumn(src, F.coalesce(F.concat(F.lit("s"), F.col(f"`{source}`").cast("string")), F.lit("n")))
    rows = rows.withColumn("size", count_words(F.col(f"`{text}`")) if text else F.col("size"))
    rows = rows.withColumn(hashed, F.xxhash64(*(F.col(f"`{c}`") for c in order), F.lit(SEED)))
    rows = rows if not text else rows.drop(text)
    rows = staged(rows, "sizes")
    totals = rows.groupBy(src).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).collect()
    names = {r[src]: (r[src][1:] if r[src][0] == "s" else None) for r in totals}
    target = shares([(names[r[src]], r["size"]) for r in totals], weights, limit)
    ranked = {s: i for i, s in enumerate(sorted(target, key=lambda s: (s is None, [ord(c) for c in s or ""])))}
    per_source = spark.createDataFrame(
        [(r[src], r["size"], target[names[r[src]]], max(1, -(-r["n"] // cell)), *map(float, schedules[ranked[names[r[src]]] % len(schedules)])) for r in totals],
        f"`{src}` string, source_size long, target double, `{made['__n']}` int, `{made['__a']}` double, `{made['__b']}` double")
    rows = rows.join(F.broadcast(per_source), src).withColumn(cell_no, F.pmod(F.shiftright(hashed, 8), F.col(made["__n"])))

    cells = rows.groupBy(src, cell_no).agg(F.sum("size").alias(made["__n"]))
    w_cells = Window.partitionBy(src).orderBy(cell_no).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(src, cell_no, F.coalesce(F.sum(made["__n"]).over(w_cells), F.lit(0)).alias(made["__base"]))
    inside = Window.partitionBy(src, cell_no).orderBy(hashed, *(F.col(f"`{c}`") for c in order), "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(made["__before"], F.coalesce(F.sum("size").over(inside), F.lit(0))).join(cells, [src, cell_no])
    before, size, total = F.col(made["__base"]) + F.col(made["__before"]), F.col("size"), F.col("source_size")
    goal = F.round("target").cast("long")

    def words(k):       # the k-th reading: whole, in part at the end of the target, or none
        return F.greatest(F.lit(0), F.least(size, goal - k * total - before)).cast("long")

    a, b = F.col(made["__a"]), F.col(made["__b"])
    mean = (a + b) / 2

    def position(k):    # time t with (a t + (b - a) t^2 / 2) / mean equal to the part of the demand met so far
        part = (k * total + before).cast("double") / F.greatest(goal, F.lit(1))
        return F.when(a == b, part).otherwise((F.sqrt(F.greatest(F.lit(0.0), a * a + 2 * (b - a) * mean * part)) - a) / (b - a))

    readings = F.transform(F.sequence(F.lit(0), F.lit(int(-(-limit // 1)) - 1)), lambda k: F.struct(
        words(k.cast("long")).alias("words"), position(k.cast("long")).alias("position")))
    rows = rows.withColumn("passes", F.filter(readings, lambda p: p["words"] > 0))
    rows = rows.withColumn("taken", F.aggregate("passes", F.lit(0).cast("long"), lambda s, p: s + p["words"]))
    return rows.drop(src, hashed, cell_no, *(made[n] for n in ("__before", "__base", "__n", "__a", "__b")))


def mixed(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Per document its size, target and taken words, range-sorted by its first position."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), F.col(f"`{text}`").alias("text"))
    out = planned(narrow, order=("doc_id",)).select(
        "doc_id", "size", "source_size", "target", "taken", F.get("passes", F.lit(0))["position"].alias("position"))
    return out.repartitionByRange(F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


def training_order(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", limit: float = LIMIT) -> DataFrame:
    """The documents as the mix reads them, in training order.

    A document appears once for each reading; a part reading counts as one if it takes at least
    half of the document and is left out otherwise, so texts stay whole.
    """
    row = fresh(docs, "__row")
    marked = staged(docs.withColumn(row, F.monotonically_increasing_id()), "mix")
    narrow = marked.select(F.col(row).alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                           F.col(f"`{text}`").alias("text"))
    plan = planned(narrow, limit=limit, order=("doc_id", "row")).select(
        F.col("row").alias(row), "size", F.explode("passes").alias("__pass"))
    plan = plan.filter(2 * F.col("__pass.words") >= F.col("size")).select(row, F.col("__pass.position").alias("__position"))
    place = fresh(docs, "__position_")
    # few rows of the plan come to the texts; else both are dealt by row
    read = marked.join(sized(staged(plan.withColumnRenamed("__position", place), "plan")), row)
    return read.repartitionByRange(F.col(place), F.col(row)).sortWithinPartitions(place, row).select(*(F.col(f"`{c}`") for c in docs.columns))
