"""JSON lines, listing pages and plain text corpora."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_spaces
from ..operators.numbering import number_rows

TEXT_SCHEMA = T.StructType([T.StructField("text", T.StringType())])
ANSWER_SCHEMA = T.StructType(
    [T.StructField("prompt", T.StringType()), T.StructField("response", T.StringType())]
)

# The mark-up of entries on the two levels of a dump listing.
FOLDER_ENTRY = '<span[^>]*\\bclass="(?:[^"]*\\s)?truncate(?:\\s[^"]*)?"[^>]*>([^<]*)</span>'
FILE_ENTRY = '<span[^>]*\\bclass="truncate group-hover:underline"[^>]*>([^<]*)</span>'
DUMP_PREFIX = "CC-MAIN"


def parse_json_lines(
    lines: DataFrame,
    schema: T.StructType = TEXT_SCHEMA,
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Non-blank lines parsed as JSON, with ``_corrupt_record`` set on lines that are not JSON."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    stripped = lines.select(*keep, strip_spaces(F.col(value)).alias("line")).where(
        F.length("line") > 0
    )
    parsed = F.from_json(
        "line", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    )
    return stripped.select(*keep, parsed.alias("row"), "line").select(*keep, "row.*", "line")


def unbroken(parsed: DataFrame) -> DataFrame:
    """Parsed lines without the bookkeeping; a line that is not JSON fails the job."""
    message = F.concat(F.lit("not JSON: "), F.left("line", F.lit(200)))
    sound = F.when(F.col("_corrupt_record").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return parsed.where(sound).drop("_corrupt_record", "line")


def rejected_json(parsed: DataFrame) -> DataFrame:
    """Lines that were not JSON, as quarantine rows keyed by the line's md5."""
    return parsed.where(F.col("_corrupt_record").isNotNull()).select(
        F.lit("parse_json").alias("stage"), F.md5("line").alias("key"), F.lit("not JSON").alias("reason")
    )


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType = TEXT_SCHEMA, rejects: str | None = None
) -> DataFrame:
    """The rows of JSON-lines files.

    A broken line fails the job, or, with ``rejects``, becomes a quarantine row there, written
    before this returns.
    """
    parsed = parse_json_lines(spark.read.text(path), schema)
    if rejects is None:
        return unbroken(parsed)
    rejected_json(parsed).write.mode("append").parquet(rejects)
    return parsed.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record", "line")


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the block they were read from, and their order in the task."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_read"),
    )


_PLACE = ["_file", "_block", "_read"]


def read_numbered_lines(spark: SparkSession, path: str, name: str = "line_no") -> DataFrame:
    """(value, line_no): lines with their 0-based number, files taken in path order."""
    return number_rows(_placed_lines(spark, path), _PLACE, name).select("value", name)


def read_answers(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """(prompt_id, model, prompt, response) of line-aligned answer files, one per model.

    The line number is the prompt's id; lines past the end of the shortest file are left out. The
    model column holds the place of the file in ``files``. A broken line fails the job: without it
    the answers behind it would belong to other prompts.
    """
    parts = [
        _placed_lines(spark, path).withColumn("model", F.lit(place))
        for place, path in enumerate(files.values())
    ]
    lines = number_rows(reduce(DataFrame.unionByName, parts), _PLACE, "prompt_id", by=["model"])
    lengths = lines.groupBy("model").agg(F.max("prompt_id").alias("last"))
    shortest = lengths.agg(F.when(F.count(F.lit(1)) == len(files), F.min("last"))).first()[0]
    aligned = lines.where(F.col("prompt_id") <= F.lit(shortest))
    keys = ["prompt_id", "model"]
    return unbroken(parse_json_lines(aligned, ANSWER_SCHEMA, keep=keys)).select(*keys, "prompt", "response")


def read_vocabulary_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_mixture(spark: SparkSession, path: str) -> DataFrame:
    """(part, count, prev, cutoff) from lines ``path count … cutoff``.

    A sub-dataset begins where the one with the next smaller cutoff ends. The list is a file that
    people write: its few lines are ordered in one task.
    """
    words = F.split(strip_spaces(F.col("value")), " ")
    before = F.lag("cutoff", 1, 0).over(Window.orderBy("cutoff", "part"))
    listed = (
        spark.read.text(path)
        .where(F.length(strip_spaces(F.col("value"))) > 0)
        .select(
            F.element_at(words, 1).alias("part"),
            F.element_at(words, 2).cast("bigint").alias("count"),
            F.element_at(words, -1).cast("bigint").alias("cutoff"),
        )
    )
    return listed.select("part", "count", before.alias("prev"), "cutoff")


def listing_entries(
    pages: DataFrame,
    key: str,
    html: str = "html",
    entry: str = FOLDER_ENTRY,
    prefix: str = DUMP_PREFIX,
    base: Column | None = None,
) -> DataFrame:
    """(key, entry, child): marked-up entries that start with ``prefix``, and their addresses."""
    found = pages.select(
        key,
        *([base.alias("_base")] if base is not None else []),
        F.explode(F.regexp_extract_all(html, F.lit(entry), F.lit(1))).alias("entry"),
    ).where(F.col("entry").startswith(prefix))
    if base is None:
        return found
    return found.select(key, "entry", F.concat_ws("/", "_base", "entry").alias("child"))


def read_corpus_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """The lines of text files in ``encoding``, read in splits like any text source.

    Multi-byte encodings are cut at the bytes of an encoded newline. Two neighbouring characters
    can hold these bytes by chance; the pieces of such a cut have a broken length, which fails the
    job: such files go through :func:`read_corpus_files`.
    """
    if encoding.lower().replace("_", "-") in ("utf-8", "utf8"):
        return spark.read.option("lineSep", "\n").text(path)
    raw = (
        spark.read.option("lineSep", "\n").option("encoding", encoding).text(path)
        .select(F.col("value").cast("binary").alias("raw"))
    )
    unit = len("\n".encode(encoding))
    broken = F.octet_length("raw") % unit != 0
    checked = F.when(
        broken, F.raise_error(F.lit("a newline's bytes were found inside characters"))
    ).otherwise(F.decode("raw", encoding.upper()))
    return raw.select(checked.cast("string").alias("value"))


def read_corpus_files(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """One row per text file, decoded as a whole."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.decode("content", encoding.upper()).alias("value"))
