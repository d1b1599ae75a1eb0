"""Readers for the base tables and prepared facts.

Column selection and filters are applied right after the scan so Catalyst
pushes them into the parquet reader (ReadSchema / PushedFilters).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import snake_case

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None,
               where: Column | None = None) -> DataFrame:
    """Parquet scan of one base table with optional projection and predicate."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df


def read_prepared(df: DataFrame, yearstart: int | None = None,
                  yearend: int | None = None) -> DataFrame:
    """A prepared fact with ``year`` normalised to INT and restricted at read.

    On a year-partitioned dataset the predicate prunes partitions.
    """
    out = df.withColumn("year", F.col("year").cast("int"))
    if yearstart is not None:
        out = out.where(F.col("year") >= yearstart)
    if yearend is not None:
        out = out.where(F.col("year") <= yearend)
    return out


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              num_partitions: int, properties: dict | None = None) -> DataFrame:
    """Parallel extract from a warehouse table, split on a numeric/date column.

    Simple predicates applied afterwards (dates, age, sex) are pushed to the
    database by the JDBC source; regular expressions are evaluated by Spark.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """CSV with a header row; column names lower- and snake-cased, then typed.

    Columns are read as text (no inference pass over the data) and cast with
    ``types`` (snake-cased name -> SQL type); unparsable values become NULL.
    """
    df = spark.read.option("header", True).csv(path)
    df = df.toDF(*[snake_case(c) for c in df.columns])
    for c, t in (types or {}).items():
        df = df.withColumn(c, F.col(c).try_cast(t))
    return df


def union_all(frames, allow_missing: bool = False) -> DataFrame:
    """Row append of same-shaped frames (never de-duplicates)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def stack_with_source(frames: dict[str, DataFrame], label: str = "source") -> DataFrame:
    """Union of several extracts, each tagged with a literal column."""
    return union_all([df.withColumn(label, F.lit(name)) for name, df in frames.items()])


def read_tagged(spark: SparkSession, paths: list[str], pattern: str, tag: str = "year", kind: str = "int",
                schema: str | None = None) -> DataFrame:
    """Several files (or folders) as one scan, each row tagged from the path of its file.

    ``pattern``'s first group is the tag.  Files may have more or fewer
    columns than others: ``mergeSchema`` unites them and missing ones are null
    (or pass the ``schema`` and no footer is read for it).
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    df = reader.parquet(*paths)
    return df.withColumn(tag, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast(kind))


def split_predicates(df: DataFrame, key: str, parts: int, accuracy: int = 10_000) -> list[str]:
    """SQL predicates that cut a table into disjoint ranges of ``key`` which hold every row, nulls too.

    The cuts are approximate quantiles, so the ranges are about as large as
    each other whatever the key's distribution; equal quantiles (a key that
    very many rows share) fall together.  The key is a number, date or
    timestamp, as for any partitioned warehouse read.  The list is what a partitioned
    warehouse read takes as its predicates: one task for each.
    """
    shares = [i / parts for i in range(1, parts)]
    kind = df.schema[key].dataType.simpleString()
    if not re.match("tinyint|smallint|int|bigint|float|double|decimal|date|timestamp", kind):
        raise TypeError(f"{key} is {kind}; a read is split on a number, date or timestamp")
    value = F.when(~F.isnan(key), F.col(key)) if kind in ("float", "double") else F.col(key)   # NaN is above every cut
    cuts = df.select(F.percentile_approx(value, F.array(*[F.lit(s) for s in shares]), F.lit(accuracy))
                     .cast("array<string>")).first()[0] if shares else []
    cuts = list(dict.fromkeys(c for c in cuts or [] if c is not None))
    literal = [f"CAST('{c}' AS {kind})" for c in cuts]
    if not literal:
        return [f"{key} IS NOT NULL", f"{key} IS NULL"]
    ranges = [f"{key} <= {literal[0]}"]
    ranges += [f"{key} > {a} AND {key} <= {b}" for a, b in zip(literal, literal[1:])]
    return [*ranges, f"{key} > {literal[-1]}", f"{key} IS NULL"]


def read_split(spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict | None = None) -> DataFrame:
    """Parallel extract from a warehouse table, one task for each predicate of :func:`split_predicates`."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
