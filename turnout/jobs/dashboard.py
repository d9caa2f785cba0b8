"""Print the newest batch of the count table in both dashboard shapes."""

from argparse import ArgumentParser, Namespace
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from turnout.jobs.options import add_option
from turnout.operators.newest import head_rows, json_records, top_groups
from turnout.plans.dashboard import dashboard_of
from turnout.session import job_session
from turnout.sources.results import (
    catalog_newest_batch,
    database_top_groups,
    marked_newest_batch,
)

# Fixed value: the rows of the first shape.
HEAD = 5


def arguments() -> ArgumentParser:
    parser = ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--count-path", help="folder of the count table")
    source.add_argument("--count-table", help="catalog table of counts")
    source.add_argument("--database-url")
    parser.add_argument("--database-table")
    parser.add_argument("--database-connector", default="jdbc")
    parser.add_argument(
        "--database-exact", default="BINARY", help="the database's type for text by its bytes"
    )
    add_option(parser, "--database-option", "the database reader")
    parser.add_argument("--rows", type=int, default=10)
    parser.add_argument("--json", action="store_true", help="print the rows as JSON records")
    return parser


def newest(spark: SparkSession, args: Namespace) -> DataFrame:
    """The newest batch, of a database its top rows only."""
    if args.count_path:
        return marked_newest_batch(spark, args.count_path)
    if args.count_table:
        return catalog_newest_batch(spark, args.count_table)
    return database_top_groups(
        spark,
        args.database_url,
        args.database_table,
        max(args.rows, HEAD),
        connector=args.database_connector,
        exact=args.database_exact,
        **dict(args.database_option),
    )


def main(argv: Sequence[str] | None = None) -> None:
    parser = arguments()
    args = parser.parse_args(argv)
    if args.database_url and not args.database_table:
        parser.error("--database-url needs --database-table")
    spark = job_session("dashboard")
    # One read: all shapes come from the same rows, whatever is written meanwhile.
    batch = top_groups(newest(spark, args), max(args.rows, HEAD)).persist()
    try:
        shapes = dashboard_of(batch, args.rows)
        head_rows(batch, HEAD).show(truncate=False)
        shapes.bars.show(args.rows, truncate=False)
        rows = json_records(top_groups(batch, args.rows)) if args.json else shapes.rows
        rows.show(args.rows, truncate=False)
    finally:
        batch.unpersist()


if __name__ == "__main__":
    main()
