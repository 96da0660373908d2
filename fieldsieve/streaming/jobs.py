"""Incremental filtering and merging of newly arrived files, and summaries of a growing log."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import keywords as kw
from ..functions.text import path_part
from ..sinks.tables import commit_manifest, group_names, read_manifest
from ..sources.folders import delete_folder, partition_folders

#: The time of the row that ends a log; see :func:`close_log`.
END_OF_LOG = datetime.datetime(9999, 1, 1)


def curate_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    output: str,
    checkpoint: str,
    keywords: Iterable[str] = kw.SPORTS_KEYWORDS,
    column: str = "url",
    glob: str = "*.parquet",
    files_per_batch: int = 1000,
) -> None:
    """Filter the files that arrived since the last call into ``output``, each exactly once.

    The checkpoint folder is the manifest: it records finished files, and the file sink's own log
    names the output files that count, so a run that breaks off is repeated without repeats in the
    output.
    """
    arrived = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    run_appending(arrived.where(kw.contains_any(F.col(column), keywords)), output, checkpoint)


def merge_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    kept: Column,
    output: str,
    manifest: str,
    checkpoint: str,
    glob: str = "*.parquet",
    files_per_group: int = 100,
) -> None:
    """Merge the files that arrived since the last call, ``files_per_group`` to a named group.

    A group is one batch of the stream: its kept rows are the folder ``file_group=…`` of
    ``output``, named after the batch and its first and last file, and its files are the names of
    the manifest, with the rows kept of each. Both are replaced when a batch is run again, and the
    checkpoint repeats a broken batch with the same files, so each row and each name is there once
    wherever a run breaks off. A file without any row has no part in a group and no name.
    """
    arrived = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_group)
        .parquet(source)
        .select("*", F.col("_metadata.file_path").alias("_path"))
    )

    def merge(rows: DataFrame, batch: int) -> None:
        files = rows.groupBy(F.col("_path").alias("path")).agg(F.count_if(kept).alias("rows"))
        group = group_names(files.withColumn("grp", F.lit(batch))).first()
        if group is None:
            return
        folder = f"{output}/file_group={batch:09d}-{group['name']}"
        rows.where(kept).drop("_path").write.mode("overwrite").parquet(folder)
        _name_files(files, f"{manifest}/batch={batch}")

    _run(arrived.writeStream.foreachBatch(merge), checkpoint)


def _name_files(files: DataFrame, path: str) -> None:
    """Write (path, rows) as the manifest rows of one group, in place of an earlier attempt's."""
    named = files.select(path_part(F.col("path"), 1).alias("name"), "rows")
    commit_manifest(named, path, mode="overwrite")


def _run(writer, checkpoint: str) -> None:
    """Process everything that is there and return."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_metrics(
    log: DataFrame, time: str = "ts", loss: str = "loss", width: str = "1 day"
) -> DataFrame:
    """Streaming per time window: steps, mean loss and its exponential.

    All windows are kept as state, one small row each, so late rows still count and the last,
    open window is given out like the others. A loss that is not a number makes its window's mean
    one too.
    """
    return (
        log.withColumn("_ts", F.col(time).cast("timestamp"))
        .groupBy(F.window("_ts", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_steps"), F.avg(F.col(loss).cast("double")).alias("mean_loss"))
        .select(
            F.col("w.start").alias("window_start"),
            "n_steps",
            "mean_loss",
            F.exp("mean_loss").alias("exp_loss"),
        )
    )


def closed_windows(
    log: DataFrame, time: str = "ts", loss: str = "loss", width: str = "1 day", delay: str = "1 day"
) -> DataFrame:
    """Streaming per time window that is over: steps, mean loss and its exponential.

    A window is over once a time ``delay`` beyond its end has been seen. It is given out one time
    and leaves the state, which so holds the windows of the last ``delay`` and no more. Rows for it
    that come afterwards are left out; :func:`late_rows` counts them. Rows without a loss are no
    steps. The windows still open at the end are given out after :func:`close_log`.
    """
    steps = log.select(F.col(time).cast("timestamp").alias("_ts"), F.col(loss).cast("double").alias("_loss"))
    over = (
        steps.withWatermark("_ts", delay)
        .groupBy(F.window("_ts", width).alias("w"))
        .agg(F.count("_loss").alias("n_steps"), F.avg("_loss").alias("mean_loss"))
    )
    return over.select(
        F.col("w.start").alias("window_start"), "n_steps", "mean_loss", F.exp("mean_loss").alias("exp_loss")
    ).where(F.col("window_start") < F.lit(END_OF_LOG - datetime.timedelta(days=366)))


def close_log(spark: SparkSession, source: str, schema: T.StructType, time: str = "ts") -> None:
    """Append the row that ends a log: the latest of times and nothing else.

    With it every window is over. Calling it again, after a break, changes nothing.
    """
    row = {f.name: END_OF_LOG if f.name == time else None for f in schema.fields}
    open_to_null = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    spark.createDataFrame([tuple(row.values())], open_to_null).coalesce(1).write.mode("append").parquet(source)


def late_rows(
    log: DataFrame, closed: DataFrame, time: str = "ts", loss: str = "loss", width: str = "1 day"
) -> DataFrame:
    """(window_start, n_late): per window of the whole, ended log the steps that came too late."""
    steps = log.select(F.col(time).cast("timestamp").alias("_ts"), loss).where(F.col("_ts") < F.lit(END_OF_LOG))
    arrived = (
        steps.groupBy(F.window("_ts", width).alias("w"))
        .agg(F.count(loss).alias("n_arrived"))
        .select(F.col("w.start").alias("window_start"), "n_arrived")
    )
    counted = arrived.join(closed.select("window_start", "n_steps"), "window_start", "left")
    return counted.select("window_start", (F.col("n_arrived") - F.coalesce("n_steps", F.lit(0))).alias("n_late"))


def run_appending(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Process everything available and append what is final to a parquet table, each row once."""
    _run(stream.writeStream.format("parquet").option("path", output).outputMode("append"), checkpoint)


def run_to_table(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Process everything available and bring :func:`current_table` to the whole, updated result.

    Each batch writes a version beside the last one and names it once it is written; versions
    older than the one before are then removed. Whenever a run breaks off, a whole version is
    named, and a batch that is run again writes its own version anew.
    """

    def add_version(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        rows.write.mode("overwrite").parquet(f"{output}/rows/version={batch}")
        named = spark.createDataFrame([(str(batch), None)], "name string, rows long")
        commit_manifest(named, f"{output}/finished/batch={batch}", mode="overwrite")
        for version, folder in partition_folders(spark, f"{output}/rows", "version").items():
            if int(version) < batch - 1:
                delete_folder(spark, f"{output}/rows/{folder}")

    _run(stream.writeStream.foreachBatch(add_version).outputMode("complete"), checkpoint)


def current_table(spark: SparkSession, output: str) -> DataFrame:
    """The last whole version that :func:`run_to_table` named."""
    finished = read_manifest(spark, f"{output}/finished")
    last = finished.agg(F.max(F.col("name").cast("bigint"))).first()[0]
    if last is None:
        raise ValueError(f"no version of {output} is finished")
    return spark.read.parquet(f"{output}/rows/version={last}")
