"""``python -m variantflow rewrite|generate|score``; also for spark-submit."""

from __future__ import annotations

import argparse

from variantflow.operators.inference import RetryPolicy
from variantflow.plans import jobs
from variantflow.plans.session import build_session


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="variantflow")
    stages = parser.add_subparsers(dest="stage", required=True)

    rewrite = stages.add_parser("rewrite", help="rewrite each text in every variant")
    rewrite.add_argument("source", help="table with a text column: .csv or Parquet")
    rewrite.add_argument("out", help="folder of log, wide, state and dead tables")
    rewrite.add_argument("--client", required=True, help="service URL or package.module:factory")
    rewrite.add_argument("--key", default="row_idx")
    rewrite.add_argument("--text", default="Description")
    rewrite.add_argument("--redo", action="store_true", help="call finished pairs again")
    rewrite.add_argument("--spread-to", type=int, help="tasks to spread the rows over")
    rewrite.add_argument("--slice-rows", type=int, default=jobs.SLICE_ROWS, help="rows that are called before they are kept")
    rewrite.add_argument("--incremental", action="store_true", help="new files of a folder only")
    rewrite.add_argument("--format", choices=("csv", "parquet"), help="of the files of --incremental; else by the folder's name")
    rewrite.add_argument("--max-files", type=int, help="files in a micro-batch")
    rewrite.add_argument("--pause", type=float, default=RetryPolicy.pause_s)
    rewrite.add_argument("--in-flight", type=int, default=RetryPolicy.in_flight)

    generate = stages.add_parser("generate", help="manifest with an artifact path for each variant")
    generate.add_argument("source", help="wide table")
    generate.add_argument("out", help="routed manifest: a .csv name or a Parquet folder")
    generate.add_argument("--artifacts", required=True, help="folder of the artifacts")
    generate.add_argument("--key", default="row_idx")
    generate.add_argument("--start-tag", default="<begin_of_image>", help="end of each prompt")

    score = stages.add_parser("score", help="scores of every artifact")
    score.add_argument("source", help="routed manifest of generate: .csv or Parquet")
    score.add_argument("out", help="routed result: a .csv name or a Parquet folder")
    score.add_argument("--features", required=True, help="Parquet with row_idx, variant, features")
    score.add_argument("--heads", required=True, help="JSON file with the weights of each score")
    score.add_argument("--images", help="folder of image files; those that can't be read get no scores")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"variantflow {args.stage}")
    if args.stage == "rewrite":
        policy = RetryPolicy(pause_s=args.pause, in_flight=args.in_flight)
        common = {"key": args.key, "text": args.text, "policy": policy}
        client = jobs.client_of(args.client)
        if args.incremental:
            counters = jobs.incremental_rewrite_job(
                spark, args.source, args.out, client, max_files=args.max_files, fmt=args.format, **common
            )
        else:
            counters = jobs.rewrite_job(
                spark, args.source, args.out, client, redo=args.redo, spread_to=args.spread_to,
                slice_rows=args.slice_rows, **common
            )
        counters.orderBy("variant", "outcome").show(truncate=False)
    elif args.stage == "generate":
        told = {"key": args.key, "start_tag": args.start_tag}
        jobs.generate_job(spark, args.source, args.out, args.artifacts, **told).show(truncate=False)
    else:
        heads = jobs.read_heads(args.heads, spark)
        run = jobs.score_job(spark, args.source, args.out, args.features, heads, images=args.images)
        run.show(truncate=False)


if __name__ == "__main__":
    main()
