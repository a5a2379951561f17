"""Seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tidewell.plans.catalog import QUERIES

HEADLINE = ("lww_current_state", "lww_composite_key", "pk_update_fanout", "snapshot_plus_cdc", "replay_idempotent", "bind_relation_asof", "stale_identity_filter", "unchanged_carry_forward", "change_counters", "diff_exact_count", "diff_primary_keys", "diff_top_mismatches", "canonical_key_text", "pk_hash32", "decode_roundtrip", "decode_binary_roundtrip", "streaming_drain")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
    spark = builder.config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["lww_current_state"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the executors
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
