"""``python -m ludomart INPUT OUTPUT``: raw dumps to published tables."""

from __future__ import annotations

import argparse

from ludomart.plans import pipeline
from ludomart.session import get_spark


def main() -> None:
    parser = argparse.ArgumentParser(prog="ludomart", description=__doc__)
    parser.add_argument("input", help="folder of the raw dumps (any Hadoop path)")
    parser.add_argument("output", help="folder of the tables (any Hadoop path)")
    parser.add_argument("--table", action="append", choices=list(pipeline.DEPENDS), help="build this table only; may be repeated")
    parser.add_argument("--downstream", action="store_true", help="and all tables that depend on those")
    args = parser.parse_args()
    tables = pipeline.downstream(args.table) if args.table and args.downstream else args.table
    for table, rows in pipeline.run(get_spark(), args.input, args.output, tables).items():
        print(f"{table}: {rows} rows")


if __name__ == "__main__":
    main()
