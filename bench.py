"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from larkspur.plans.queries import QUERIES  # noqa: E402
from larkspur.session import local_session  # noqa: E402

HEADLINE = [
    "raw_scan", "range_train", "clean_all", "clean_event_time", "impute_saved_median", "column_medians",
    "encode_apply", "unseen_report", "split_rows", "split_rows_bucketed", "split_copies", "class_report",
    "evaluation_report", "risk_score", "latest_features", "features_as_of", "infer_without_train",
    "registry_versions", "csv_roundtrip", "published_table", "feature_group_append", "feature_group_latest",
    "parse_csv_requests", "json_answers", "requests_per_minute", "stream_ingest", "forest_train_eval",
    "batch_inference", "search_best",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, partitions=int(cpus) if cpus.isdigit() else 8, name="bench")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["raw_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(os.path.normpath(sf_dir))}))


if __name__ == "__main__":
    main()
