"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line with the median of three runs after a warm-up."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "item_window_counts", "item_event_panes", "item_window_sketches", "user_hour_counts", "user_scored_lists", "user_action_lists", "user_author_hour", "post_session_summaries", "session_user_day", "session_post_day", "anchor_window_counts", "user_anchor_quarter", "cohort_interactions", "cf_index",
    "tag_label_picks", "state_machine_replay", "parsed_feature_events", "kv_writes",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from tidemark.plans.registry import QUERIES

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    out = {}
    for name in os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE:
        took = []
        for _ in range(runs + 1):
            t = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t)
        out[name] = round(statistics.median(took[1:]), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(out.values()), 3), "unit": "sec", "queries": out, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
