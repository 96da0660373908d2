"""Command line: ``spark-submit -m fieldsieve JOB …`` or ``python -m fieldsieve JOB …``."""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.keywords import SPORTS_KEYWORDS, contains_any
from .operators import evaluate as ev
from .operators.labels import any_sentence_judge, majority_judge
from .plans import crawl, tokens
from .plans.classifier import train_classifier
from .plans.evaluation import grade_answer_files
from .plans.labels import label_set
from .session import owned
from .sinks.tables import compact_files, export_jsonl, quarantine
from .sources.crawl import CRAWL_SCHEMA, pattern_names, read_patterns, with_row_key
from .sources.text import parse_json_lines, read_answers, read_numbered_lines, unbroken
from .streaming.jobs import curate_new_files


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fieldsieve")
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("filter", help="keep crawl pages whose URL holds a sports keyword")
    job.add_argument("root")
    job.add_argument("output")
    job.add_argument("-j", "--json", help='JSON file {"patterns": [dump, …]}')
    job.add_argument("-n", "--name", help="one dump")
    job = jobs.add_parser("train", help="train and report the document classifier")
    job.add_argument("annotation", help="parquet with text and label")
    job.add_argument("model", help="folder for the model")
    job = jobs.add_parser("clean", help="keep filtered pages the classifier calls positive")
    job.add_argument("filtered")
    job.add_argument("output")
    job.add_argument("manifest")
    job.add_argument("model")
    job = jobs.add_parser("label", help="build one side of a labelled set with the rule judge")
    job.add_argument("crawl", help="parquet with text, url, token_count, language")
    job.add_argument("output")
    job.add_argument("--label", type=int, choices=(0, 1), required=True)
    job.add_argument("--max-counter", type=int, default=20000)
    job = jobs.add_parser("tokens", help="shuffle, tokenize and shard JSON-lines documents")
    job.add_argument("jsonl")
    job.add_argument("output")
    job.add_argument("epochs", type=int)
    job.add_argument("--seed", type=int, default=0)
    job = jobs.add_parser("combine", help="join the answers of several models per prompt")
    job.add_argument("output")
    job.add_argument("files", nargs="+")
    job = jobs.add_parser("grade", help="combine answer files and grade them with the rule judges")
    job.add_argument("output", help="folder for the scores")
    job.add_argument("rejects", help="folder for answers without usable scores")
    job.add_argument("files", nargs="+")
    job = jobs.add_parser("compact", help="keep matching rows and merge small files by groups")
    job.add_argument("source")
    job.add_argument("output")
    job.add_argument("--files-per-group", type=int, default=100)
    job = jobs.add_parser("stream", help="filter the files that arrived since the last call")
    job.add_argument("source")
    job.add_argument("output")
    job.add_argument("checkpoint")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"fieldsieve-{args.job}").getOrCreate()
    with owned(spark):
        run(spark, args)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """One job; its intermediate tables go when it ends."""
    if args.job == "filter":
        names = [args.name] if args.name else None
        if args.json:
            names = pattern_names(read_patterns(spark, args.json))
        crawl.filter_crawl(spark, args.root, args.output, names)
    elif args.job == "train":
        result = train_classifier(spark.read.parquet(args.annotation))
        result.model.write().overwrite().save(args.model)
        for table in (result.metrics, result.report, result.matrix):
            table.show(truncate=False)
    elif args.job == "clean":
        scorer = crawl.model_scorer(PipelineModel.load(args.model))
        crawl.clean_crawl(spark, args.filtered, args.output, args.manifest, scorer)
    elif args.job == "label":
        pages = with_row_key(spark.read.schema(CRAWL_SCHEMA).parquet(args.crawl))
        judge = (majority_judge if args.label else any_sentence_judge)(SPORTS_KEYWORDS)
        accepted = label_set(pages, "row_key", args.label, judge, args.max_counter)
        accepted.drop("row_key").write.parquet(args.output)
    elif args.job == "tokens":
        lines = read_numbered_lines(spark, args.jsonl, "doc")
        parsed = unbroken(parse_json_lines(lines, keep=["doc"]))
        missing = F.raise_error(F.concat(F.lit("no text in line "), F.col("doc").cast("string")))
        docs = parsed.withColumn("text", F.coalesce("text", missing.cast("string")))
        tokens.write_epochs(docs, "doc", args.output, args.epochs, seed=args.seed)
    elif args.job == "grade":
        files = {str(i): path for i, path in enumerate(args.files)}
        rubrics = {"accuracy": ev.length_judge(), "relevance": ev.overlap_judge()}
        scores, rejected = grade_answer_files(spark, files, rubrics)
        scores.write.parquet(args.output)
        quarantine([rejected], args.rejects)
    elif args.job == "compact":
        source = spark.read.parquet(args.source)
        keep = contains_any(F.col("url"), SPORTS_KEYWORDS)
        compact_files(source, keep, args.files_per_group, args.output)
    elif args.job == "stream":
        schema = spark.read.parquet(args.source).schema
        curate_new_files(spark, args.source, schema, args.output, args.checkpoint)
    else:
        files = {str(i): path for i, path in enumerate(args.files)}
        combined = ev.combine_answers(read_answers(spark, files))
        export_jsonl(combined.select("prompt", "response"), args.output)


if __name__ == "__main__":
    main()
