"""Write the sample tables as log tables: ``spark-submit make_sample_tables.py --output-dir DIR``."""

from __future__ import annotations

import argparse
import sys

from tableferry.plans.sample_tables import BASE_DATE, sample_customers, sample_orders, sample_products
from tableferry.session import build_session
from tableferry.sources.log_table import structure_report, write_log_table

# The folder and the numbers of rows when none are given.
OUTPUT_DIR = "./sample_delta_tables"
CUSTOMERS, ORDERS, PRODUCTS = 1000, 5000, 500


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tableferry-samples", description="Write sample log tables")
    parser.add_argument("--output-dir", default=OUTPUT_DIR)
    parser.add_argument("--customers", type=int, default=CUSTOMERS)
    parser.add_argument("--orders", type=int, default=ORDERS)
    parser.add_argument("--products", type=int, default=PRODUCTS)
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--base-date", default=BASE_DATE)
    args = parser.parse_args(argv)
    spark = build_session("tableferry-samples")
    tables = {
        "customers": sample_customers(spark, args.customers, args.seed, args.base_date),
        "orders": sample_orders(spark, args.orders, args.seed, args.base_date, args.customers),
        "products": sample_products(spark, args.products, args.seed, args.base_date),
    }
    for name, frame in tables.items():
        path = f"{args.output_dir.rstrip('/')}/{name}"
        version = write_log_table(frame, path)
        found = structure_report(spark, path).first()
        print(f"{name}: version {version}, {found.commit_files} commits, {found.data_files} data files at {path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
