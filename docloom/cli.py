"""Thin command line (L7): list and run registered queries, check a source configuration, create, list, inspect and publish
snapshots, extract archived bodies, parse archived responses again.

Exit codes: 0 done, 1 refused, 2 wrong arguments.
"""

from __future__ import annotations

import argparse
import json
import sys

from docloom.sources.config import ConfigError, load


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="docloom")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("queries")
    run = commands.add_parser("run")
    run.add_argument("query")
    run.add_argument("folder")
    run.add_argument("--out", help="write Parquet there instead of showing rows")
    check = commands.add_parser("check-config")
    check.add_argument("path")
    snapshot = commands.add_parser("publish")
    snapshot.add_argument("root")
    snapshot.add_argument("name")
    create = commands.add_parser("snapshot-create", help="from Parquet tables resources, overrides, versions and rows in a folder")
    create.add_argument("root")
    create.add_argument("name")
    create.add_argument("tables")
    inspect = commands.add_parser("snapshot-inspect")
    inspect.add_argument("root")
    inspect.add_argument("name")
    listed = commands.add_parser("snapshot-list")
    listed.add_argument("root")
    for name, told in (("extract", "texts of archived bodies: refs are a Parquet table with archive_ref and state"), ("reparse", "rows of archived responses by an adapter: refs have request_url, too")):
        again = commands.add_parser(name, help=told)
        again.add_argument("archive")
        again.add_argument("refs")
        again.add_argument("out")
        if name == "reparse":
            again.add_argument("adapter")
            again.add_argument("--options", default="{}", help="the adapter's options as JSON")
    args = parser.parse_args(argv)
    from docloom.plans import registry
    from docloom.session import session

    try:
        if args.command == "queries":
            print("\n".join(sorted(registry.queries())))
        elif args.command == "check-config":
            print(load(args.path).id)
        elif args.command == "run":
            if args.query not in registry.queries():
                raise ConfigError("unknown_query")
            out = registry.queries()[args.query](session("docloom run"), args.folder)
            out.write.mode("errorifexists").parquet(args.out) if args.out else out.show(20, False)
        elif args.command == "snapshot-create":
            from docloom.operators.snapshots import create as create_snapshot

            spark = session("docloom snapshot-create")
            create_snapshot(f"{args.root}/{args.name}", *[spark.read.parquet(f"{args.tables}/{t}") for t in ("resources", "overrides", "versions", "rows")]).show()
        elif args.command in ("snapshot-inspect", "snapshot-list"):
            from docloom.operators.snapshots import inspect as inspect_snapshot
            from docloom.operators.snapshots import snapshots

            spark = session("docloom snapshots")
            for name in snapshots(spark, args.root) if args.command == "snapshot-list" else [args.name]:
                print(name, json.dumps(inspect_snapshot(spark, f"{args.root}/{name}")))
        elif args.command in ("extract", "reparse"):
            _archived(args, session(f"docloom {args.command}"))
        else:
            from docloom.operators.snapshots import publish

            print("changed" if publish(session("docloom publish"), f"{args.root}/log", args.name, f"{args.root}/{args.name}") else "unchanged")
    except ConfigError as e:
        print(f"refused: {e}", file=sys.stderr)
        return 1
    return 0


def _archived(args: argparse.Namespace, spark) -> None:
    from pyspark.sql import functions as F

    from docloom.sources.adapters import adapter
    from docloom.sources.archive import Archive, Context

    context = Context(Archive(spark, args.archive), mode="reparse")
    if args.command == "extract":
        context.extract(context.read(spark.read.parquet(args.refs))).drop("body").write.mode("errorifexists").parquet(args.out)
        return
    try:
        options = json.loads(args.options)
    except ValueError:
        raise ConfigError("invalid_adapter_options") from None
    reader = adapter(args.adapter, **options)
    responses = context.read(spark.read.parquet(args.refs)).where("error IS NULL").withColumn("body", F.decode("body", "utf-8"))
    reader.build(reader.parse(responses)).write.mode("errorifexists").parquet(args.out)


if __name__ == "__main__":
    sys.exit(main())
