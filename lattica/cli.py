"""Command line: ingest, stage, materialize, validate."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from .plans.pipeline import Run
from .plans.scope import parse_only


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lattica")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("ingest", "stage", "materialize", "validate"):
        p = commands.add_parser(name)
        p.add_argument("--raw", type=Path, required=True)
        p.add_argument("--staging", type=Path, required=True)
        p.add_argument("--batch-id")
        p.add_argument("--class-scope", choices=("part", "dataset"), default="part")
        if name != "stage":
            p.add_argument("--only")
        if name == "materialize":
            p.add_argument("--validate", action="store_true")
    args = parser.parse_args(argv)
    run = Run(spark or SparkSession.builder.appName("lattica").getOrCreate(), args.raw, args.staging, batch_id=args.batch_id, class_scope=args.class_scope)
    only = parse_only(getattr(args, "only", None))
    if args.command in ("materialize", "validate") and not run.dir.is_dir():
        print(f"there is no batch at {run.dir}", file=sys.stderr)
        return 1
    if args.command == "ingest":
        result = run.ingest(only)
        print(f"batch_id={result['batch_id']} triples={result['total_triples']:,}")
        print(f"provenance={result['provenance_path']}")
    elif args.command == "stage":
        run.stage()
        run.finalize()
        print(f"batch_id={run.batch_id} manifest={run.dir / 'manifest.json'}")
    elif args.command == "materialize":
        run.templates(only)
        made = run.materialize(only)
        if args.validate:
            run.validate(only)
        print(f"batch_id={run.batch_id} triples={sum(m['total_triples'] for m in made):,} provenance={run.finalize()}")
    else:
        reports = run.validate(only)
        for r in reports:
            print(f"{r['transform_id']}: {r['status']} ({r['parts_conformant']} of {r['parts_total']} parts)")
        run.finalize()
    return 0


if __name__ == "__main__":
    sys.exit(main())
