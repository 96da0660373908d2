"""Crawl dumps: one folder of parquet files per dump."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .folders import child_folders

CRAWL_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("token_count", T.LongType()),
        T.StructField("language", T.StringType()),
    ]
)


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the file each row came from and its place in that file."""
    return df.select(
        *df.columns,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Add a key that is unique per row and sorts rows by file and place in the file."""
    place = F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0")
    return df.select(*df.columns, F.concat_ws("#", "_metadata.file_path", place).alias(name))


def read_dumps(
    spark: SparkSession,
    root: str,
    dumps: Sequence[str] | None = None,
    schema: T.StructType = CRAWL_SCHEMA,
) -> DataFrame:
    """All parquet files of the given dumps (or of all) under ``root/data/<dump>/``.

    The dump name comes from the path (``<dump>`` or ``dump=<dump>``); files of other dumps are
    never listed. A named dump without a folder is an error.
    """
    names = ["*"]
    if dumps:
        found = {f.removeprefix("dump="): f for f in child_folders(spark, f"{root}/data")}
        missing = sorted(set(dumps) - set(found))
        if missing:
            raise FileNotFoundError(f"no dump folder for {', '.join(missing)} under {root}/data")
        names = [found[d] for d in dict.fromkeys(dumps)]
    folders = [f"{root}/data/{name}/*.parquet" for name in names]
    df = spark.read.schema(schema).parquet(*folders)
    dump = F.regexp_extract(F.col("_metadata.file_path"), "/data/(?:dump=)?([^/]+)/[^/]+$", 1)
    return with_provenance(df).withColumn("dump", dump)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType, by: str = "dump") -> DataFrame:
    """A table written with one partition folder per dump; filters on ``by`` prune folders."""
    return spark.read.schema(schema.add(by, T.StringType()) if by not in schema.names else schema).parquet(path)


def read_patterns(spark: SparkSession, path: str, key: str = "patterns") -> DataFrame:
    """(dump): the dump names listed under ``key`` of a JSON document."""
    schema = T.StructType([T.StructField(key, T.ArrayType(T.StringType()))])
    listed = spark.read.schema(schema).option("multiLine", True).json(path)
    return listed.select(F.explode(key).alias("dump")).distinct()


def pattern_names(patterns: DataFrame) -> list[str]:
    """The listed names: a request someone wrote, which becomes paths and partition filters."""
    return sorted(r["dump"] for r in patterns.select("dump").distinct().collect() if r["dump"])


def select_dumps(df: DataFrame, patterns: DataFrame, dump: str = "dump") -> DataFrame:
    """Rows of the requested dumps only; on a partitioned table only their folders are read."""
    return df.where(F.col(dump).isin(pattern_names(patterns)))
