"""Benchmark: headline queries on the derived topics and tables, one JSON line at the end.

Landing the derived topics and tables is reported as `prepare`: they stand for data that already exists. Every query
then starts from raw records or landed stages; the first run of a stage is part of `stage_*`. `cold` has the times of some
queries from raw records to the result, with no stage landed before; they are not part of the total.
"""

from __future__ import annotations

import json
import os
import time

from assetweave.plans import stages
from assetweave.plans.queries import QUERIES
from assetweave.session import build_session
from assetweave.sources.derived import RECIPES, load

HEADLINE = (
    "table_scan", "latest_by_version", "write_status_counts", "guarded_upsert", "type_counts", "duplicate_stats",
    "vector_type_counts", "vector_type_status", "table_profile", "relation_summary", "relation_report", "merge_report",
    "chart_upsert", "chart_content_upsert", "version_gate", "status_fanout",
)
COLD = ("latest_by_version", "guarded_upsert", "duplicate_stats", "chart_upsert", "version_gate")
STAGES = {"stage_decode": stages.decoded, "stage_documents": stages.documents, "stage_profile": stages.messages}


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    prepare = timed(lambda: [load(spark, sf_dir, name) for name in RECIPES])
    times = {name: timed(lambda build=build: build(spark, sf_dir)) for name, build in STAGES.items()}
    for name in HEADLINE:
        times[name] = timed(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    cold = {}
    for name in COLD:  # from raw records again, nothing landed before
        stages.forget()
        cold[name] = timed(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "prepare": prepare, "cold": cold, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
