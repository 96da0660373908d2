"""Partitioned parquet output, merged files, JSON lines, manifests and quarantine."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import whole_div
from ..functions.text import path_part, without_suffix
from ..operators.numbering import number_rows
from ..sources.crawl import read_partitioned
from ..sources.folders import delete_folder, partition_folders

# Fixed value: the largest output shard, 4096 MB.
SHARD_BYTES = 4096 * 1024 * 1024
# Fixed value: the folder Spark gives rows whose partition value is null or empty.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)


def write_dumps(
    df: DataFrame, path: str, by: str = "dump", max_rows_per_file: int = 0
) -> None:
    """One folder per dump in several shards; only the dumps present are replaced.

    The rows are rebalanced by dump: adaptive execution cuts a dump that is far larger than the
    others into as many tasks as its size asks for and merges small ones, so a hot dump neither
    sits in one task nor leaves thousands of tiny files. Shards stay near the session's advisory
    partition size, which must not exceed the 4096 MB of an output shard. Without adaptive
    execution every task writes what it has: more files, but still no hot task.
    """
    settings = df.sparkSession.conf
    if _bytes(settings.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) > SHARD_BYTES:
        raise ValueError("the advisory partition size is larger than an output shard may be")
    adaptive = settings.get("spark.sql.adaptive.enabled") == "true"
    (
        (df.hint("rebalance", by) if adaptive else df)
        .write.partitionBy(by)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .mode("overwrite")
        .parquet(path)
    )


def _bytes(setting: str) -> int:
    """Bytes of a size setting such as ``64MB`` or ``67108864b``."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", setting.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def file_groups(files: DataFrame, per_group: int, path: str = "path") -> DataFrame:
    """(path, grp): the listing in path order, cut in runs of ``per_group`` files."""
    numbered = number_rows(files.select(path), [path], "_row")
    return numbered.select(path, whole_div(F.col("_row"), per_group).alias("grp"))


def group_names(groups: DataFrame, path: str = "path", by_folder: bool = False) -> DataFrame:
    """(grp, n_files, name): each group named after its first and last member.

    The name joins the file names without their suffix by ``_``, or the parent folders by
    ``_to_``.
    """
    part = path_part(F.col(path), 2) if by_folder else without_suffix(path_part(F.col(path), 1))
    joint = "_to_" if by_folder else "_"
    return groups.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.concat(F.min_by(part, path), F.lit(joint), F.max_by(part, path)).alias("name"),
    )


def compact_files(source: DataFrame, kept: Column, per_group: int, path: str) -> None:
    """Filter ``source`` and write one output folder per ``per_group`` of its input files.

    Inputs stay where they are. A group larger than a shard is written as several files. A folder's
    name ends in a hash of the paths of its inputs: files of one name in several folders, merged by
    several calls into one output, replace nothing but the same group of an earlier call.
    """
    file = F.col("_metadata.file_path")
    groups = file_groups(source.select(file.alias("path")).distinct(), per_group)
    members = groups.groupBy("grp").agg(F.md5(F.concat_ws("\n", F.sort_array(F.collect_list("path")))).alias("members"))
    name = F.concat_ws("-", "name", F.left("members", F.lit(12)))
    names = group_names(groups).join(members, "grp").select("grp", name.alias("file_group"))
    rows = source.select(*source.columns, file.alias("path")).where(kept)
    grouped = rows.join(groups, "path").join(names, "grp").drop("path", "grp")
    write_dumps(grouped, path, "file_group")


def export_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, null fields kept."""
    df.write.option("ignoreNullFields", False).mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Finished names; an empty table before the first commit."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def commit_manifest(
    finished: DataFrame, path: str, name: str = "name", rows: str = "rows", mode: str = "append"
) -> None:
    """Append finished names. Call it after their output has been written.

    With ``mode="overwrite"`` the path is the part of a manifest that belongs to one step, which a
    repeated step replaces.
    """
    finished.select(
        F.col(name).alias("name"),
        F.col(rows).cast("bigint").alias("rows"),
        F.current_timestamp().alias("finished_at"),
    ).write.mode(mode).parquet(path)


def pending_folders(spark: SparkSession, source: str, manifest: str, by: str = "dump") -> list[str]:
    """The dumps that have a folder under ``source`` and no row in the manifest.

    Both sides are lists of folder names; no file of the source is opened.
    """
    done = {r["name"] for r in read_manifest(spark, manifest).select("name").collect()}
    return [name for name in partition_folders(spark, source, by) if name not in done]


def of_folders(df: DataFrame, names: Sequence[str], by: str = "dump") -> DataFrame:
    """The rows of the named partition folders; Spark lists and reads no others."""
    chosen = F.col(by).isin([n for n in names if n != NULL_FOLDER])
    return df.where(chosen | F.col(by).isNull() if NULL_FOLDER in names else chosen)


def process_pending(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    step: Callable[[DataFrame], DataFrame],
    output: str,
    manifest: str,
    by: str = "dump",
) -> None:
    """Apply ``step`` to the dump folders of ``source`` that no manifest row names, and commit them.

    Finished folders are not read. What an earlier, broken run left of a pending dump is removed
    first, so a dump of which the step keeps nothing ends with no rows; the manifest is appended
    only after the write returned, with the rows this run wrote. A rerun after success finds
    nothing to do.
    """
    names = pending_folders(spark, source, manifest, by)
    if not names:
        return
    result = step(of_folders(read_partitioned(spark, source, schema, by), names, by))
    left = partition_folders(spark, output, by)
    for name in names:
        if name in left:
            delete_folder(spark, f"{output}/{left[name]}")
    write_dumps(result, output, by)
    written = (
        of_folders(spark.read.schema(result.schema).parquet(output), names, by)
        .groupBy(F.coalesce(by, F.lit(NULL_FOLDER)).alias("name"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    finished = spark.createDataFrame([(n,) for n in names], "name string")
    commit_manifest(finished.join(written, "name", "left").fillna(0, subset=["rows"]), manifest)


def quarantine(rejected: Sequence[DataFrame], path: str) -> None:
    """Append rejected rows (stage, key, reason) of several stages."""
    for rows in rejected:
        rows.select("stage", "key", "reason").write.mode("append").parquet(path)


def rejected_answers(judged: DataFrame, key: str) -> DataFrame:
    """Judged rows without an answer, as quarantine rows with the judge's ``failure`` if it gave one."""
    reason = F.coalesce("failure", F.lit("no answer")) if "failure" in judged.columns else F.lit("no answer")
    return judged.where(F.col("response").isNull()).select(
        F.lit("judge").alias("stage"), F.col(key).cast("string").alias("key"), reason.alias("reason")
    )
