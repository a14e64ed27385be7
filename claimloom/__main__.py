"""python -m claimloom run|ingest|validate|snapshot: the command line over the library."""

from __future__ import annotations

import argparse
import shutil

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="claimloom")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="filings and payloads to tables and a proof")
    run.add_argument("--filings", required=True, help="folder of <slug>/raw.md with manifest.json, or of markdown files with --examples")
    run.add_argument("--examples", action="store_true")
    run.add_argument("--payloads", required=True, help="JSON lines of request_id and payload")
    run.add_argument("--out", required=True)
    run.add_argument("--run-id", required=True)
    run.add_argument("--on-error", choices=("raise", "quarantine"), default="raise")
    ingest = sub.add_parser("ingest", help="filings to paragraphs and spans; of a repeated one, only what changed")
    ingest.add_argument("--filings", required=True)
    ingest.add_argument("--examples", action="store_true")
    ingest.add_argument("--out", required=True)
    validate = sub.add_parser("validate", help="ingested tables against the files as they are now; prints the failures")
    validate.add_argument("--filings", required=True)
    validate.add_argument("--out", required=True)
    snapshot = sub.add_parser("snapshot", help="copies a run's folder")
    snapshot.add_argument("source")
    snapshot.add_argument("target")
    a = parser.parse_args(args)
    if a.command == "snapshot":
        shutil.copytree(a.source, a.target)
        return
    from claimloom.plans import incremental
    from claimloom.plans import run as kernel
    from claimloom.sources import tables

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "validate":
        failures = incremental.validate_sources(a.out, incremental.source_files(spark, a.filings), a.filings)
        for r in failures.toLocalIterator():
            print(r["table_name"], r["row_id"], r["detail"])
        return
    filings = tables.example_filings(spark, a.filings) if a.examples else tables.filings(spark, a.filings)
    if a.command == "ingest":
        filings = filings if "form_type" in filings.columns else filings.withColumn("form_type", F.lit(""))
        for r in incremental.ingest(filings, a.out).groupBy("change").count().collect():
            print(r["change"], r["count"])
        return
    payloads = tables.ledger(spark, a.payloads, "request_id string, payload string")
    proof = kernel.run(spark, filings, lambda requests: payloads, a.out, a.run_id, a.on_error)
    print(proof["verdict"])


if __name__ == "__main__":
    main()
