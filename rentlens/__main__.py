"""python -m rentlens COMMAND: thin commands over the registry in a folder."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import functions as F

from . import schema
from .operators import monthly_index, registry, resolve
from .plans import publish
from .session import cut, local_session
from .sources import sinks, state, tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="rentlens")
    parser.add_argument("command", choices=["stats", "export", "import", "seed", "dedupe", "build"])
    parser.add_argument("folder", help="registry folder; for dedupe, a CSV path")
    parser.add_argument("path", nargs="?", help="CSV to read or write, or the folder to publish to")
    parser.add_argument("--series", help="index series file (build)")
    parser.add_argument("--dry-run", action="store_true", help="only report (seed, dedupe)")
    parser.add_argument("--no-backup", action="store_true", help="dedupe a file in place without a copy of it")
    args = parser.parse_args(argv)
    spark, now = local_session(), datetime.now(UTC).isoformat(timespec="seconds")
    if args.command == "dedupe":
        rows = registry.coerced(tables.known_columns(tables.read_csv(spark, args.folder))[0])
        kept, _ = resolve.dedupe(rows)
        for r in resolve.audit(rows).orderBy("kind", "key").toLocalIterator():
            print(r["kind"], r["key"], r["text"], sep="\t")
        if args.path and not args.dry_run:
            if args.path == args.folder and not args.no_backup:
                print("backup:", sinks.backup(spark, args.folder))
            sinks.export_csv(cut(kept), args.path)
        return
    old = state.load(spark, args.folder)
    if args.command == "stats":
        print(registry.stats(old["listings"]).first().asDict())
    elif args.command == "export":
        sinks.export_csv(old["listings"], args.path, schema.LISTING_COLUMNS)
    elif args.command == "build":
        series = tables.read_series(spark, args.series) if args.series else spark.createDataFrame([], "ordinal int, month string, value string")
        print(publish.build(old["listings"], series, args.path, now))
        print(monthly_index.describe(monthly_index.levels(series)).first().asDict())
    else:
        rows, unknown = tables.known_columns(tables.read_csv(spark, args.path))
        print("unknown columns:", unknown)
        rows = registry.latest_wins(rows.filter("id <> ''").withColumn("__o", F.monotonically_increasing_id()), "id", F.col("__o")).drop("__o")
        new = registry.import_rows(old["listings"], rows, now) if args.command == "import" else registry.seed(old["listings"], rows, now)
        print("rows:", new.count())
        if not args.dry_run:
            print("generation:", state.commit(spark, args.folder, old | {"listings": new}))


if __name__ == "__main__":
    main()
