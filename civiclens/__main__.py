"""Command line, for ``spark-submit`` or ``python -m civiclens``.

    build RAW ROOT               write all stage tables below ROOT from the raw Parquet table RAW
    report RAW ROOT NAME         print all rows of a query over them, or write them (--output FOLDER);
                                 builds only what is missing or no longer up to date
    summaries RAW ROOT FOLDER    write the exploratory summaries
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from civiclens.plans.catalog import QUERIES
from civiclens.plans.summaries import write_summaries
from civiclens.plans.workspace import TABLES, Workspace


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="civiclens")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("build", "report", "summaries"):
        command = commands.add_parser(name)
        command.add_argument("raw")
        command.add_argument("root")
        if name == "report":
            command.add_argument("name", choices=sorted(QUERIES))
            command.add_argument("--output", help="folder for the rows as Parquet, instead of printing all of them")
        if name == "summaries":
            command.add_argument("folder")
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("civiclens").getOrCreate()
    ws = Workspace(spark, spark.read.parquet(chosen.raw), chosen.root, reuse=chosen.command != "build")
    if chosen.command == "build":
        for name in TABLES[1:]:
            ws.table(name)
    elif chosen.command == "report":
        rows = QUERIES[chosen.name](ws)
        if chosen.output:
            rows.write.mode("overwrite").parquet(chosen.output)
        else:
            print("\t".join(rows.columns))
            for row in rows.toLocalIterator():
                print("\t".join("" if value is None else str(value) for value in row))
    else:
        write_summaries(ws, chosen.folder)


if __name__ == "__main__":
    main()
