"""Session defaults and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .sources.folders import delete_folder

_LOCAL_FOLDERS: dict[str, str] = {}
_OWNERS: list[list[str]] = []


def local_session(app: str = "fieldsieve", cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    n = str(cores)
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{n}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting: there one machine-local folder is made per
    application. On a cluster a missing setting is an error, because a table written to one
    machine's disk would be lost to the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="fieldsieve-")
    return _LOCAL_FOLDERS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/fieldsieve/{label}-{uuid.uuid4().hex}"


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the tables that were pinned inside.

    For jobs whose results are written when the block ends. Tables pinned outside any such block
    stay until someone clears the shared folder, because DataFrames may still read them.
    """
    mine: list[str] = []
    _OWNERS.append(mine)
    try:
        yield
    finally:
        _OWNERS.remove(mine)
        for path in mine:
            delete_folder(spark, path)


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts lineage, so values that depend on the physical layout (partition numbers) or on an
    outside service (judge answers) are computed once and survive a lost executor. The innermost
    :func:`owned` block removes the table.
    """
    path = scratch_path(df.sparkSession, label)
    if _OWNERS:
        _OWNERS[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
