"""Small helpers of the operators: staged tables, free column names, words, exact cut values."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"
BREAK = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, and where it is unset
    (tests) a folder inside the warehouse, which is shared as well."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or spark.conf.get("spark.sql.warehouse.dir") + "/_stage").rstrip("/")


def staged(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back, so that later passes neither repeat
    the work before it nor depend on an executor's disk. The session removes it when it ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_IDS = 2_000_000    # rows of one or two numbers that may be sent to every executor


def sized(narrow: DataFrame) -> DataFrame:
    """A staged table of row numbers for the small side of a join: marked for broadcast when it is counted to be within
    BROADCAST_IDS, so that the large side stays where it is; beyond, Spark joins both by shuffle."""
    return F.broadcast(narrow) if narrow.count() <= BROADCAST_IDS else narrow


def kept(df: DataFrame) -> DataFrame:
    """A small derived table that several passes read: kept on disk, recomputed if lost."""
    return df.persist(StorageLevel.DISK_ONLY)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def renamed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the columns an operator works on, under its own names."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))


def count_words(text) -> F.Column:
    """Maximal runs of characters other than space, tab and the line breaks; null counts 0."""
    n = F.size(F.split(F.coalesce(text, F.lit("")), BREAK))
    edge = (F.when(F.coalesce(text, F.lit("")).rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
            + F.when(F.coalesce(text, F.lit("")).rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0))
    return F.when(F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]"), n - edge).otherwise(0).cast("long")


def kth_largest(df: DataFrame, column: str, k: int, total: int, small: int = 20_000) -> float | None:
    """The exact k-th largest value of a double column without a global sort.

    Approximate percentiles close in on the place; each pass is one aggregate, and only a
    bracket of at most `small` rows (or of equal values) is sorted.
    """
    if k <= 0:
        return float("inf")
    if k >= total:
        return None
    low, high, above, inside = float("-inf"), float("inf"), 0, total
    rest = df.select(F.col(column).cast("double").alias("v"))
    while inside > small:
        part = rest.filter((F.col("v") >= low) & (F.col("v") <= high))
        at = 1 - (k - above - 0.5) / inside
        marks = [min(1.0, max(0.0, at + step)) for step in (-0.002, -0.0001, 0.0001, 0.002)]
        edges = part.agg(F.percentile_approx("v", marks, 100_000)).first()[0]
        cuts = sorted({low, high, *map(float, edges)})
        counts = part.agg(*(F.count_if(F.col("v") > c).alias(f"a{i}") for i, c in enumerate(cuts)),
                          *(F.count_if(F.col("v") >= c).alias(f"b{i}") for i, c in enumerate(cuts))).first()
        more = {c: above + counts[f"a{i}"] for i, c in enumerate(cuts)}
        atleast = {c: above + counts[f"b{i}"] for i, c in enumerate(cuts)}
        for c in cuts:
            if more[c] < k <= atleast[c]:
                return c
        new_low = max(c for c in cuts if atleast[c] >= k)
        new_high = min(c for c in cuts if more[c] < k)
        if (new_low, new_high) == (low, high):
            break
        low, high, above = new_low, new_high, more[new_high]
        inside = atleast[low] - above
    values = rest.filter((F.col("v") >= low) & (F.col("v") <= high)).orderBy(F.desc("v")).limit(k - above)
    return float(values.agg(F.min("v")).first()[0])
