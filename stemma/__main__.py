"""Documents to Turtle from the command line: a file or a folder of XML files."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stemma.functions.text import DEFAULT_HOST
from stemma.plans.jobs import transform
from stemma.sinks.files import write_status, write_turtle
from stemma.sources.files import read_documents


def main(arguments: list[str] | None = None) -> int:
    """Exit code 0, or 1 if a document failed."""
    parser = argparse.ArgumentParser(prog="stemma", description=__doc__)
    parser.add_argument("input", help="an XML file, or a folder of XML files")
    parser.add_argument("-o", "--output", required=True, help="the folder of the Turtle files and the status table")
    parser.add_argument("--host", default=DEFAULT_HOST, help="the host of the addresses that are made")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("stemma").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    documents = read_documents(spark, given.input)
    text, status = transform(spark, documents, given.host)
    write_turtle(text, given.output)
    write_status(status, given.output)
    return 1 if status.where("status = 3").limit(1).count() else 0


if __name__ == "__main__":
    raise SystemExit(main())
