"""``python -m snapsync settings.json``: copy tables, print the report.

The report goes to standard output, one JSON object per table, and to a folder of
JSON files if one is given.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from snapsync.operators.copy import copy_all
from snapsync.operators.schema import load_schema
from snapsync.options import DECLARED_SCHEMAS, load_settings


def run(spark: SparkSession, settings: str) -> DataFrame:
    """Copy what the settings (JSON text) say -> report."""
    parsed = json.loads(settings)
    source, target, options = load_settings(parsed)
    declared = {
        table: load_schema(json.dumps(columns))
        for table, columns in parsed.get(DECLARED_SCHEMAS, {}).items()
    }
    return copy_all(spark, source, target, options, declared)


def main() -> None:
    parser = argparse.ArgumentParser(prog="snapsync", description=__doc__)
    parser.add_argument("settings", type=Path, help="JSON file of settings")
    parser.add_argument("--report", help="folder to write the report to")
    arguments = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = (
        SparkSession.builder.appName("snapsync")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    report = run(spark, arguments.settings.read_text())
    if arguments.report:
        report.coalesce(1).write.mode("overwrite").json(arguments.report)
    for row in report.collect():
        print(json.dumps(row.asDict()))
    spark.stop()


if __name__ == "__main__":
    main()
