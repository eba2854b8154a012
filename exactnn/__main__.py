"""Command line: build a ground truth from two text tables.

    spark-submit --py-files exactnn.zip exactnn/__main__.py sentences 1000 10000 \\
        --query-table q.parquet --base-table b.parquet -m hashing -ods 64 -k 100

A model other than the built-in ones comes from ``--embedder module``, a module that calls
``register_embedder`` when it is imported, or for tokens from ``--embedder module:factory``.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from exactnn.functions.models import TOKEN_MODEL
from exactnn.functions.vectors import METRICS
from exactnn.operators.embed import HASHING_MODEL, hashing_token_embedder
from exactnn.plans.ground_truth import Corpus, sentence_ground_truth, token_ground_truth


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="exactnn", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)
    for name, metric in (("sentences", "sqeuclidean"), ("tokens", "inner")):
        job = commands.add_parser(name)
        job.add_argument("query_count", type=int, help="query vectors to make")
        job.add_argument("base_count", type=int, help="base vectors to make")
        job.add_argument("--query-table", required=True)
        job.add_argument("--base-table", required=True)
        job.add_argument("--query-text", default="question")
        job.add_argument("--base-text", default="text")
        job.add_argument("--title", default="title", help="title column of both tables")
        job.add_argument("--order", default="row_id", help="unique order key of both tables")
        job.add_argument("-k", type=int, default=100)
        job.add_argument("--metric", choices=METRICS, default=metric)
        job.add_argument("--data-dir", default="knn_dataset")
        job.add_argument("--embedder")
        job.add_argument("--bundle", action=argparse.BooleanOptionalAction, default=True)
        job.add_argument("--post-validation", action=argparse.BooleanOptionalAction, default=False)
        job.add_argument("--single-file", action=argparse.BooleanOptionalAction, default=False)
        if name == "sentences":
            job.add_argument("-m", "--model", default=HASHING_MODEL)
            job.add_argument("-ods", "--output-dimension", type=int)
            job.add_argument("-odt", "--output-dtype")
        else:
            job.add_argument("-m", "--model", default=TOKEN_MODEL)
            job.add_argument("--dim", type=int, default=128)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("exactnn").getOrCreate()
    sides = [
        Corpus(spark.read.parquet(path), text, [args.order], args.title)
        for path, text in (
            (args.query_table, args.query_text), (args.base_table, args.base_text)
        )
    ]
    shared = dict(
        k=args.k, metric=args.metric, bundle=args.bundle, validate=args.post_validation,
        single_file=args.single_file,
    )
    if args.command == "sentences":
        if args.embedder:
            importlib.import_module(args.embedder)
        truth = sentence_ground_truth(
            spark, *sides, args.data_dir, args.model, args.query_count, args.base_count,
            output_dimension=args.output_dimension, output_dtype=args.output_dtype, **shared,
        )
    else:
        factory = hashing_token_embedder(args.dim) if not args.embedder else _load(args.embedder)
        truth = token_ground_truth(
            spark, *sides, args.data_dir, factory, args.dim, args.query_count, args.base_count,
            model=args.model, **shared,
        )
    truth.manifest.show(truncate=False)
    if truth.checks is not None:
        truth.checks.show(truncate=False)


def _load(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


if __name__ == "__main__":
    main()
