"""Command line: ``python -m tidewell.cli diff --config FILE``, ``mirror --config FILE --log PATH --relations FILE`` and ``follow``, which goes on."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tidewell import config, model
from tidewell.operators import diff
from tidewell.plans import mirror


def relations_of(path: str) -> dict[str, model.Relation]:
    """Relations by table from a JSON list of {rel_id, namespace, name, fields: [{name, oid, key}]}."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    return {r["name"]: model.Relation(r["rel_id"], r["namespace"], r["name"], tuple(model.Field(**x) for x in r["fields"])) for r in found}


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidewell")
    parser.add_argument("command", choices=("mirror", "follow", "diff"))
    parser.add_argument("--config", required=True)
    parser.add_argument("--log", help="folder of log frames (mirror, follow)")
    parser.add_argument("--relations", help="JSON file of relation descriptions (mirror, follow)")
    parser.add_argument("--checkpoint", help="folder of the stream's state (follow)")
    parser.add_argument("--plain", action="store_true", help="one line a table instead of JSON")
    given = parser.parse_args(args)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.scheduler.mode", "FAIR").getOrCreate()
    run = config.load(given.config)
    if given.command == "mirror":
        print(json.dumps(mirror.mirror(spark, run, relations_of(given.relations), given.log), default=str))
        return 0
    if given.command == "follow":
        mirror.follow(spark, run, relations_of(given.relations), given.log, given.checkpoint)
        return 0
    results = mirror.compare(spark, run)
    for r in results:
        print(f"{r.table} {r.level} {r.status}: {r.detail}" if given.plain else json.dumps(vars(r)))
    return diff.exit_status(results)


if __name__ == "__main__":
    sys.exit(main())
