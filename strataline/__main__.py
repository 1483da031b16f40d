"""Run the whole job: ``spark-submit`` this module, or ``python -m strataline``."""

from __future__ import annotations

import argparse

from strataline.plans import flows
from strataline.plans.lake import Lake
from strataline.session import session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="strataline", description=__doc__)
    parser.add_argument("root", help="folder of the tables")
    parser.add_argument("--customers", required=True, help="folder of workbooks")
    parser.add_argument("--products", required=True, help="folder of CSV files")
    parser.add_argument("--orders", required=True, help="folder of JSON files")
    parser.add_argument("--lines", action="store_true", help="orders are JSON lines")
    parser.add_argument("--prefix", default="", help="goes before the schema names")
    parser.add_argument("--buckets", type=int, default=32, help="of each keyed table")
    parser.add_argument("--attach", action="store_true", help="the catalog is new, the data not")
    given = parser.parse_args(arguments)

    lake = Lake(session(), given.root, given.prefix, given.buckets)
    lake.attach() if given.attach else lake.create()
    reports = flows.run_all(
        lake, given.customers, given.products, given.orders, lines=given.lines
    )
    for name, report in reports.items():
        print(name)
        report.show(truncate=False)


if __name__ == "__main__":
    main()
