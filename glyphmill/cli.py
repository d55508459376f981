"""Command line: inspect inputs, build a bundle, validate one, compare two.  Exit status 0, 1 for an invalid bundle or one
that differs, 2 for bad arguments."""

from __future__ import annotations

import argparse
import json
import os
import resource
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from glyphmill.functions import text as T
from glyphmill.operators import compare, validate
from glyphmill.plans import build
from glyphmill.sources import bundle, records

VERSION = "1.0"
CSS = '[data-sc-content="record-entry"] { font-family: sans-serif; }\n'
#: Environment variable with a revision to be used as it is; and the base of those that are made.
REVISION, BASE = "GLYPHMILL_REVISION", "1"
#: Files of a folder of schemas.
SCHEMAS = {"index": "index-schema.json", "term-bank": "term-bank-schema.json"}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="glyphmill", description=__doc__)
    commands = out.add_subparsers(dest="command", required=True)
    look = commands.add_parser("inspect")
    look.add_argument("--input", required=True)
    make = commands.add_parser("build")
    make.add_argument("--input", required=True, help="folder with one file of records and at least one of resources")
    make.add_argument("--output", required=True)
    make.add_argument("--corrections")
    make.add_argument("--report")
    make.add_argument("--schemas", help="folder of JSON Schemas that the bundle is validated by once it is built")
    make.add_argument("--url", help="where the bundle's index and archive are published")
    make.add_argument("--edition", choices=sorted(build.EDITIONS), default="full")
    check = commands.add_parser("validate")
    check.add_argument("path")
    check.add_argument("--schemas", help=f"folder with {' and '.join(SCHEMAS.values())}")
    check.add_argument("--report")
    check.add_argument("--url", help="where the light edition has to say that it is published")
    check.add_argument("--edition", choices=sorted(build.EDITIONS), default="full")
    mode = check.add_mutually_exclusive_group()
    mode.add_argument("--exhaustive", action="store_true")
    mode.add_argument("--archive-only", action="store_true")
    other = commands.add_parser("compare")
    other.add_argument("old")
    other.add_argument("new")
    other.add_argument("--input", required=True, help="folder or file of the records that both were made from")
    other.add_argument("--report")
    return out


def schemas(folder: str | None) -> dict[str, dict]:
    """The schemas in a folder; both have to be there."""
    return {name: json.loads((Path(folder) / file).read_text()) for name, file in SCHEMAS.items()} if folder else {}


def identity(edition: build.Edition, url: str | None) -> dict:
    """What an edition's index says about itself."""
    where = {"isUpdatable": True, "indexUrl": f"{url.rstrip('/')}/{edition.index}", "downloadUrl": f"{url.rstrip('/')}/{edition.archive}"} if url else {}
    return {"title": edition.title, **where}


def _checked(args: argparse.Namespace, path: str, mode: str = "targeted") -> dict:
    own = identity(build.edition(args.edition), args.url)
    return validate.validate_bundle(SparkSession.active(), path, args.edition, mode, identity=own, schemas=schemas(args.schemas))


def _built(spark: SparkSession, args: argparse.Namespace) -> int:
    began = time.monotonic()
    edition = build.edition(args.edition)
    inputs = records.discover(args.input)
    known = records.described(spark, inputs)
    rules = records.read_rules(spark, args.corrections) if args.corrections else None
    files = records.read_resources(spark, *inputs.resources) if args.edition == "full" else None
    run = build.build(records.read_records(spark, inputs.main), rules, args.edition, files=files)
    source = next((f["sha256"] for f in known["files"] if f["sha256"]), "")
    revision = T.revision(BASE, VERSION, source, os.environ.get(REVISION))
    own = identity(edition, args.url)
    index = bundle.index(own["title"], revision, (own["indexUrl"], own["downloadUrl"]) if args.url else None)
    digest = build.write(run, args.output, index, CSS)
    status = 0
    if args.schemas:
        result = _checked(args, args.output)
        sys.stdout.write(validate.report(result) + "\n")
        status = 0 if result["valid"] else 1
    if args.report:
        banks = run.terms.groupBy("bank_no").count().collect()
        told = build.report(run, args.edition) | {
            "converter_version": VERSION, "revision": revision, "input": known,
            "output": {"path": args.output, "size": os.path.getsize(args.output), "sha256": digest, "term_banks": len(banks), "terms": sum(r["count"] for r in banks)},
            "performance": {"build_seconds": round(time.monotonic() - began, 3), "driver_peak_rss_bytes": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024},
        }
        Path(args.report).write_text(bundle.pretty(told))
    sys.stdout.write(f"{digest}  {args.output}\n")
    return status


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.command == "inspect":
        sys.stdout.write(bundle.pretty(records.described(spark, records.discover(args.input))))
        return 0
    if args.command == "build":
        return _built(spark, args)
    if args.command == "compare":
        main_file = args.input if args.input.endswith((records.MAIN, ".parquet")) else records.discover(args.input).main
        result = compare.compare_bundles(spark, args.old, args.new, records.read_records(spark, main_file))
        if args.report:
            Path(args.report).write_text(bundle.pretty(result))
        sys.stdout.write(bundle.pretty(result))
        return 0 if result["passed"] else 1
    result = _checked(args, args.path, "exhaustive" if args.exhaustive else "archive-only" if args.archive_only else "targeted")
    if args.report:
        Path(args.report).write_text(bundle.pretty(result))
    sys.stdout.write(validate.report(result) + "\n")
    return 0 if result["valid"] else 1


if __name__ == "__main__":
    sys.exit(main())
