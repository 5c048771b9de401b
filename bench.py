"""Headline timings: one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_WARM=0 to skip the untimed pass over the smallest
sibling folder that loads and compiles the JVM code. Every stage is timed on its own, so a query's figure does not contain
the tables it reads; the stages that build those tables have figures of their own.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from kinweave.catalog import QUERIES
from kinweave.catalog.context import Context
from kinweave.plans import tables

QUERY_NAMES = (
    "summary_report", "golden_records", "secondary_values", "email_match", "weighted_match", "trigram_name_match",
    "edit_distance_match", "scored_profiles", "campaign_attribution", "abandoned_carts", "segment_performance", "idle_sessions",
    "rfm_tiles", "lineage", "match_quality", "run_differences", "customer_360", "similar_products", "assembled_context",
    "sanitized_pages", "document_uuids", "stream_ingest",
)


def stages(spark: SparkSession, folder: str) -> dict[str, float]:
    c = Context(spark, folder)
    seconds = {}

    def timed(name, run):
        start = time.time()
        out = run()
        seconds[name] = round(time.time() - start, 3)
        return out

    timed("write_documents", lambda: tables.tracking_documents(spark, folder))
    events = timed("ingest_events", c.accepted)
    raw = timed("stage_raw_profiles", c.raw)
    timed("resolve_transitive", c.transitive)
    timed("resolve_sequential", c.sequential)
    timed("golden_records_build", lambda: (c.golden(), c.identifiers()))
    timed("stitch_events", lambda: (c.events(), c.purchases()))
    timed("prior_masters_build", c.prior_masters)
    timed("scores_build", c.scored)
    seconds["_raws"], seconds["_events"] = raw.count(), events.count()
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kinweave-")).config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    small = str(Path(folder).parent / "sf0.001")
    if os.environ.get("BENCH_WARM", "1") != "0" and Path(small).exists():
        stages(spark, small)
        for name in QUERY_NAMES:
            QUERIES[name].run(spark, small).write.format("noop").mode("overwrite").save()
    seconds = stages(spark, folder)
    raws, events = seconds.pop("_raws"), seconds.pop("_events")
    for name in QUERY_NAMES:
        start = time.time()
        QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "total of headline stages and queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").split("sf")[-1], "cpus": int(cpus), "spark": spark.version,
        "raws_per_second_transitive": round(raws / seconds["resolve_transitive"], 1),
        "raws_per_second_sequential": round(raws / seconds["resolve_sequential"], 1),
        "events_per_second_ingest": round(events / seconds["ingest_events"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
