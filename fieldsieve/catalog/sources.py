"""Readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.tables import export_jsonl, write_dumps
from ..sources import crawl as dumps
from ..sources import text as tx
from .registry import CRAWL, crawl, query, table


@query(f"WITH {CRAWL} SELECT page_id, dump, token_count, 1 AS has_source FROM crawl")
def scan_dump(spark, folder):
    """Pages laid out as dump folders and read back with dump, file and row provenance."""
    root = scratch_path(spark, "dumps")
    pages = crawl(spark, folder).select("page_id", "dump", "token_count")
    write_dumps(pages, f"{root}/data")
    schema = pages.drop("dump").schema
    found = dumps.read_dumps(spark, root, schema=schema)
    known = F.col("file_name").endswith(".parquet") & (F.col("row_index") >= 0)
    return found.select("page_id", "dump", "token_count", known.cast("int").alias("has_source"))


@query(f"WITH {CRAWL} SELECT page_id, dump, token_count FROM crawl WHERE dump IN ('de', 'fr')")
def scan_named_dumps(spark, folder):
    """Two dumps read by name from the folders that the writer makes."""
    root = scratch_path(spark, "dumps")
    pages = crawl(spark, folder).select("page_id", "dump", "token_count")
    write_dumps(pages, f"{root}/data")
    found = dumps.read_dumps(spark, root, ["de", "fr"], pages.drop("dump").schema)
    return found.select("page_id", "dump", "token_count")


def _lines_with_broken(spark, folder) -> str:
    """The documents as JSON lines, the long ones cut off after their id."""
    path = scratch_path(spark, "jsonl")
    line = F.when(
        F.col("n_chars") > 2000, F.concat(F.lit('{"text": '), F.col("doc_id").cast("string"))
    ).otherwise(F.to_json(F.struct("text")))
    table(spark, folder, "documents").select(line.alias("value")).write.text(path)
    return path


@query("SELECT text FROM documents WHERE n_chars <= 2000")
def read_jsonl(spark, folder):
    """The good lines; the broken ones are set aside."""
    path = _lines_with_broken(spark, folder)
    return tx.read_jsonl(spark, path, rejects=scratch_path(spark, "rejects"))


@query("""SELECT 'parse_json' AS stage, md5('{"text": ' || doc_id) AS key, 'not JSON' AS reason
FROM documents WHERE n_chars > 2000""")
def read_jsonl_rejects(spark, folder):
    """The broken lines that reading set aside."""
    path, rejects = _lines_with_broken(spark, folder), scratch_path(spark, "rejects")
    tx.read_jsonl(spark, path, rejects=rejects)
    return spark.read.parquet(rejects)


@query("""SELECT page_id, entry, url || '/' || entry AS child FROM
(SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS entry FROM pages)
WHERE starts_with(entry, '/th')""")
def listing_extract(spark, folder):
    pages = table(spark, folder, "pages")
    return tx.listing_entries(
        pages, "page_id", entry='href="([^"]*)"', prefix="/th", base=F.col("url")
    )


@query("SELECT page_id, 'CC-MAIN-' || page_id AS entry, url || '/CC-MAIN-' || page_id AS child FROM pages")
def listing_folders(spark, folder):
    """Folder entries as a dump listing marks them up, among entries of other kinds."""
    name = F.col("page_id").cast("string")
    html = F.concat(
        F.lit('<a href="/d"><span class="block truncate">CC-MAIN-'), name,
        F.lit('</span></a><span class="size">CC-MAIN-9</span><span class="truncate">README</span>'),
    )
    pages = table(spark, folder, "pages").select("page_id", "url", html.alias("html"))
    return tx.listing_entries(pages, "page_id", base=F.col("url"))


@query("SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def text_corpus(spark, folder):
    """The documents written as a UTF-16LE text corpus and read back line by line."""
    path = scratch_path(spark, "utf16")
    raw = F.encode(F.col("text"), "UTF-16LE").cast("string")
    (
        table(spark, folder, "documents").select(raw.alias("value"))
        .write.option("lineSep", "\n").option("encoding", "UTF-16LE").text(path)
    )
    return tx.read_corpus_lines(spark, path, "utf-16le")
