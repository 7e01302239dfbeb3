"""``spark-submit`` entry: sync the tables given as arguments or as a JSON list."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Sequence

from tablesync.plans.pipeline import run_many, run_pipeline
from tablesync.session import builder
from tablesync.sinks.audit import AuditTable
from tablesync.sources.frames import FileLocation
from tablesync.sources.jdbc import JdbcLocation
from tablesync.spec import SyncConfig, TableConfig, load_config


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description="Incremental table sync")
    args.add_argument("--table", help="source table")
    args.add_argument("--target-table", help="target table (default: as the source)")
    args.add_argument("--mode", choices=["timestamp", "rowversion"], default="timestamp")
    args.add_argument("--watermark-col", help="column that tracks changes")
    args.add_argument("--conflict-cols", nargs="+", help="key columns of the target")
    args.add_argument("--tables", help="JSON list of tables, in place of the options above")
    args.add_argument("--source", help="folder of the source tables")
    args.add_argument("--target", help="folder of the target tables")
    args.add_argument("--options", help="JSON file with database options; else the environment")
    args.add_argument("--watermarks", help="path of the watermark store of a database target (default: a table there)")
    args.add_argument("--target-schema", default="public")
    args.add_argument("--audit", help="path of the audit table")
    args.add_argument("--batches", type=int, default=1)
    return args


def _tables(args: argparse.Namespace) -> list[TableConfig]:
    if args.tables is not None:
        return TableConfig.from_json(args.tables)
    if not (args.table and args.watermark_col and args.conflict_cols):
        parser().error("give --table, --watermark-col and --conflict-cols, or --tables")
    keys = tuple(args.conflict_cols)
    return [TableConfig(args.table, args.watermark_col, keys, args.mode, args.target_table)]


def _config(args: argparse.Namespace) -> SyncConfig:
    if args.source and args.target:
        source, target = FileLocation(args.source), FileLocation(args.target)
        return SyncConfig(source=source, target=target, batches=args.batches)
    options = dict(os.environ)
    if args.options:
        with open(args.options, encoding="utf-8") as handle:
            options.update(json.load(handle))
    loaded = load_config(options)

    def by_table(name: str) -> dict[str, str]:
        """A mapping by table: an object in the options file, or one as JSON text, as in the environment."""
        value = options.get(name) or {}
        value = json.loads(value) if isinstance(value, str) else value
        if not isinstance(value, dict):
            raise ValueError(f"{name} maps tables to text.")
        return value

    return SyncConfig(
        chunk_size=loaded.chunk_size,
        max_workers=loaded.max_workers,
        retry_attempts=loaded.retry_attempts,
        batches=args.batches,
        source=JdbcLocation(
            loaded.source,
            partition_columns=by_table("PARTITION_COLUMNS"),
            custom_schemas=by_table("CUSTOM_SCHEMAS"),
            num_partitions=loaded.max_workers,
        ),
        target=JdbcLocation(loaded.target, args.watermarks, num_partitions=loaded.max_workers),
    )


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    tables, config = _tables(args), _config(args)
    spark = builder("tablesync").getOrCreate()
    audit = AuditTable(spark, args.audit) if args.audit else None

    def run(table: TableConfig):
        return run_pipeline(
            spark,
            table.table,
            table.mode,
            table.watermark_col,
            table.conflict_columns,
            table.target_table,
            config,
            target_schema=args.target_schema,
            audit=audit,
        )

    results = run_many(spark, tables, run, config.max_workers)
    results.show(truncate=False)
    return 1 if results.filter("status != 'success'").count() else 0


if __name__ == "__main__":
    sys.exit(main())
