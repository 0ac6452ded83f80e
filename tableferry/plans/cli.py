"""Command line for moving one table or a batch: ``spark-submit move_tables.py ...``.

Exits with 1 when a table failed and with 2 on wrong arguments.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from tableferry.leases import sweep
from tableferry.operators.load import MODES
from tableferry.plans.move import METHODS, Job, batch_totals, move_all, move_table
from tableferry.session import build_session


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tableferry", description="Move log tables into warehouse tables")
    parser.add_argument("--source-path", "--delta-path", help="table folder, optionally with @vN")
    parser.add_argument("--catalog", help="catalog of the target table")
    parser.add_argument("--project", "--bq-project", help="project of the target table, for connectors")
    parser.add_argument("--schema", "--bq-dataset", help="schema of the target table")
    parser.add_argument("--table", "--bq-table", help="name of the target table")
    parser.add_argument("--stage-root", "--temp-bucket", help="folder for staged copies")
    parser.add_argument("--method", choices=list(METHODS), default="staged")
    parser.add_argument("--mode", choices=list(MODES), default="overwrite")
    parser.add_argument("--nested", choices=["json", "keep"], default="json")
    parser.add_argument("--keep-nulls", action="store_true", help="JSON text keeps null fields and microseconds")
    parser.add_argument("--version", type=int, help="version of the source table")
    parser.add_argument("--map-types", action="store_true", help="widen types to those of the target system")
    parser.add_argument("--date-column", action="append", default=[], help="text column to load as a date")
    parser.add_argument("--time-column", action="append", default=[], help="text column to load as a timestamp")
    parser.add_argument("--rejects", help="table for rows that do not fit the mapped types, which else stop the load")
    parser.add_argument("--format", help="data source of the target instead of the session catalog")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="option for --format")
    parser.add_argument("--partition-by", action="append", default=[])
    parser.add_argument("--cluster-by", action="append", default=[])
    parser.add_argument("--key", action="append", default=[], help="append only rows whose key the target lacks")
    parser.add_argument("--incremental-column", help="append only rows above the target's largest value")
    parser.add_argument("--since", help="append only rows of commits after this time")
    parser.add_argument("--switch", action="store_true", help="let a new target be a view that shows each load in one step and remembers the source version")
    parser.add_argument("--config-file", help="JSON array of tables to move")
    parser.add_argument("--parallel", type=int, default=1, help="tables moved at the same time")
    parser.add_argument("--ledger", help="folder of finished tables; a batch run again with it moves only the others")
    parser.add_argument("--sweep", action="store_true", help="first remove what dead runs left in the shared folders")
    parser.add_argument("--no-verify", action="store_true")
    parser.add_argument("--strict-verify", action="store_true", help="a failed check fails the table")
    parser.add_argument("--checksum", action="store_true", help="after an overwrite, also compare the content")
    parser.add_argument("--no-cleanup", action="store_true", help="keep staged copies")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run the command in a session of its own, or in the one given."""
    parser = build_parser()
    args = parser.parse_args(argv)
    if not args.config_file and not (args.source_path and args.schema and args.table):
        parser.error("give --config-file, or --source-path, --schema and --table")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = spark or build_session("tableferry")
    flags = {
        "verify": not args.no_verify,
        "cleanup": not args.no_cleanup,
        "strict_verify": args.strict_verify,
        "checksum": args.checksum,
    }
    if args.sweep:
        for thing in sweep(spark):
            logging.getLogger("tableferry").info("swept %s", thing)
    if args.config_file:
        results = move_all(spark, args.config_file, args.method, args.mode, args.parallel, args.ledger, **flags)
    else:
        job = Job(
            source_path=args.source_path,
            table=args.table,
            schema=args.schema,
            catalog=args.catalog,
            project=args.project,
            stage_root=args.stage_root,
            method=args.method,
            mode=args.mode,
            nested=args.nested,
            format=args.format,
            options=dict(pair.split("=", 1) for pair in args.option),
            partition_by=tuple(args.partition_by),
            cluster_by=tuple(args.cluster_by),
            key=tuple(args.key),
            incremental_column=args.incremental_column,
            since=args.since,
            keep_nulls=args.keep_nulls,
            version=args.version,
            map_types=args.map_types,
            date_columns=tuple(args.date_column),
            time_columns=tuple(args.time_column),
            rejects=args.rejects,
            switch=args.switch,
        )
        results = move_table(spark, job, **flags)
    for row in results.collect():  # one line per table of the batch
        print("\t".join(f"{name}={value}" for name, value in row.asDict().items() if value is not None))
    totals = batch_totals(results).first()
    print(f"{totals.succeeded}/{totals.tables} tables moved")
    return 0 if totals.succeeded == totals.tables else 1


if __name__ == "__main__":
    sys.exit(main())
