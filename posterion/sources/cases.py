"""Case tables: reading, binding ids and weights, staging, subsets, long format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from posterion.functions.scalars import quoted, state_index, state_text
from posterion.plans.network import Network


def read_csv(spark: SparkSession, path: str, *, schema=None, header: bool = True) -> DataFrame:
    """A CSV table; give a schema for large files, so that nothing is read twice."""
    reader = spark.read.option("header", header)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def read_table(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """A parquet table, optionally with some columns only."""
    df = spark.read.parquet(path)
    return df.select(*[quoted(c) for c in columns]) if columns else df


def check_cases(df: DataFrame, id_col: str, weight_col: str | None = None) -> DataFrame:
    """One row `n_rows, n_ids, n_bad_weight, sum_weight`.

    Ids are counted after grouping by id, so the check is one shuffle of id counts and holds
    no distinct set in one task.
    """
    w = quoted(weight_col).cast("double") if weight_col else F.lit(1.0)
    per_id = df.groupBy(quoted(id_col).alias("__id")).agg(
        F.count(F.lit(1)).alias("c"), F.count_if(w < 0).alias("bad"), F.sum(w).alias("w"))
    return per_id.agg(F.sum("c").alias("n_rows"), F.count("__id").alias("n_ids"),
                      F.sum("bad").alias("n_bad_weight"), F.sum("w").alias("sum_weight"))


def bind(df: DataFrame, id_col: str, weight_col: str | None = None) -> DataFrame:
    """The table itself when its ids are unique and its weights not negative."""
    r = check_cases(df, id_col, weight_col).head()
    if r["n_rows"] != r["n_ids"]:
        raise ValueError(f"{id_col} is not unique")
    if r["n_bad_weight"]:
        raise ValueError(f"{weight_col} has negative weights")
    return df


def stage(df: DataFrame, path: str, *, mode: str = "replace", partition_by=()) -> DataFrame:
    """S3: write the table once and read it back; modes replace, append and skip (if present)."""
    modes = {"replace": "overwrite", "append": "append", "skip": "ignore"}
    df.write.mode(modes[mode]).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def rows_by_id(df: DataFrame, ids: DataFrame, id_col: str, *, ordered: bool = True) -> DataFrame:
    """Rows whose id is in the id frame (semi join, never an IN list)."""
    got = df.join(ids.select(quoted(id_col)), id_col, "left_semi")
    return got.orderBy(quoted(id_col)) if ordered else got


def gapped_ids(df: DataFrame, *, name: str = "ix") -> DataFrame:
    """Distinct ids that increase inside each partition; gaps between partitions."""
    return df.withColumn(name, F.monotonically_increasing_id())


def bind_evidence(df: DataFrame, network: Network, *, keep=(), references=None) -> DataFrame:
    """Columns that are variables of the network; values that are no state become missing."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    chosen = [n for n in network.observed() if n in fields and (references is None or n in references)]
    if not chosen:
        raise ValueError("no column of the table is a variable of the network")
    cols: list[Column] = []
    for n in chosen:
        c, states = quoted(n), network[n].states
        known = not states or network[n].kind == "continuous"
        cols.append(c if known else F.when(state_index(c, states, fields[n]).isNotNull(), c).alias(n))
    return df.select(*[quoted(k) for k in keep], *cols)


def long_format(df: DataFrame, id_col: str, columns) -> DataFrame:
    """(id, variable, value) of the present values, in one pass over the rows."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), state_text(quoted(c), fields[c]).alias("value"))
                      for c in columns])
    long = df.select(quoted(id_col), F.explode(pairs).alias("p"))
    return long.select(quoted(id_col), "p.variable", "p.value").filter(F.col("value").isNotNull())


DEFAULTS = {"string": "", "boolean": False}


def add_values(df: DataFrame, values: DataFrame, id_col: str, name: str) -> DataFrame:
    """A new column given on some ids; '' / False / null elsewhere by type."""
    dtype = values.schema[name].dataType
    default = F.lit(DEFAULTS.get(dtype.simpleString())).cast(dtype)
    v = values.select(quoted(id_col), quoted(name).alias("__new"))
    return df.join(v, id_col, "left").select(*[quoted(c) for c in df.columns if c != name],
                                             F.coalesce("__new", default).alias(name))
