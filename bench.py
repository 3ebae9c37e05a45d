"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from brickfolio.plans import load_catalog
from brickfolio.session import build_session

HEADLINE = [
    "panel_scan", "price_movements", "discontinuities", "apply_reviews", "adjusted_prices", "adjusted_from_registry",
    "price_history", "session_gaps", "price_quality", "ml_features", "temporal_signals", "ml_eligibility",
    "training_dataset", "temporal_split", "split_checks", "walk_forward_folds", "fold_metrics", "feature_stats",
    "feature_drift", "trimmed_mean", "path_metrics", "core_name", "fii_master", "ticker_history", "master_quality",
    "daily_snapshot", "content_fingerprint", "publish_partitioned", "context_records", "dataset_health",
    "trading_calendar", "zip_xml_ingest", "csv_register_scan", "html_field_extract", "stream_raw_to_silver",
    "walk_forward_fit", "land_trades", "stored_latest", "publish_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_catalog()
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # the first job pays for starting up
    times = {}
    for key in HEADLINE:
        start = time.perf_counter()
        queries[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
