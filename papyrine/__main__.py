"""Run one stage from the command line: `spark-submit` this file, or `python -m papyrine <stage> ...`.

Tables are Parquet folders. Each stage reports the rows it wrote, the time it took, and what more rows would take.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrine.functions.paths import rebase_path
from papyrine.operators import outcome
from papyrine.operators.pages import MAX_PAGES, MIN_PAGES
from papyrine.operators.relevance import mark_by_language
from papyrine.operators.subsets import SUBSET_SIZE
from papyrine.plans import stages
from papyrine.sources.files import walk_files
from papyrine.sources.tables import EXTRACTION_SCHEMA, QUALITY_SCHEMA, read_stage, write_csv, write_stage


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="papyrine", description=__doc__)
    commands = parser.add_subparsers(dest="stage", required=True)

    def command(name: str, about: str, *inputs: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=about)
        for one in inputs:
            added.add_argument(one)
        added.add_argument("out", help="Parquet table to write")
        added.add_argument("--csv", help="also export as CSV to this folder")
        return added

    collate = command("collate", "manifest of the files with text", "source", "pages")
    collate.add_argument("--max-files", type=int)
    split = command("split", "number the files of a manifest into subsets", "manifest")
    split.add_argument("--size", type=int, default=SUBSET_SIZE)
    quality = command("quality", "assemble documents from pages and mark the relevant ones", "pages")
    quality.add_argument("--language", default="id")
    quality.add_argument("--threshold", type=float, default=0.8)
    quality.add_argument("--above", type=int, default=MIN_PAGES, help="keep documents with more pages than this")
    quality.add_argument("--below", type=int, default=MAX_PAGES, help="keep documents with fewer pages than this")
    quality.add_argument("--subsets", help="what split wrote: divide the table by its subsets")
    rebase = command("rebase", "move the paths of a quality table to another base", "quality", "pattern", "replacement")
    extract = command("extract", "clean the texts of relevant documents", "quality")
    for one in (rebase, extract):
        one.add_argument("--subset", type=int, help="only this subset of the table")
    finish = command("finish", "drop the rows with errors", "extraction")
    finish.add_argument("--base", required=True, help="what good paths begin with")
    return parser.parse_args(argv)


def result(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.stage == "collate":
        return stages.collate(walk_files(spark, args.source), spark.read.parquet(args.pages), args.max_files)
    if args.stage == "split":
        return stages.split(spark.read.parquet(args.manifest), args.size)
    if args.stage == "quality":
        pages = spark.read.parquet(args.pages)
        marked = stages.mark_quality(
            pages, lambda df: mark_by_language(df, args.language, args.threshold), args.above, args.below
        )
        return stages.with_subset(marked, spark.read.parquet(args.subsets)) if args.subsets else marked
    if args.stage == "finish":
        return stages.finish(read_stage(spark, args.extraction, EXTRACTION_SCHEMA), args.base)
    divided = args.subset is None and "subset_id" in spark.read.parquet(args.quality).columns
    schema = T.StructType([*QUALITY_SCHEMA.fields, T.StructField("subset_id", T.LongType())]) if divided else QUALITY_SCHEMA
    quality = read_stage(spark, args.quality, schema, args.subset)
    if args.stage == "extract":
        return stages.extract(quality)
    return quality.withColumn("pdf_path", rebase_path(F.col("pdf_path"), args.pattern, args.replacement))


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"papyrine {args.stage}").getOrCreate()
    table = result(spark, args)
    written = write_stage(table, args.out, [name for name in table.columns if name == "subset_id"])
    if args.csv:
        write_csv(spark.read.parquet(args.out), args.csv)
    estimate = outcome.throughput_estimate(outcome.run_metrics(spark, {args.stage: written}))
    print(estimate.first().asDict())


if __name__ == "__main__":
    main()
