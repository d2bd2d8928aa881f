"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every query is planned
and run in full; its rows go to a sink that discards them. Stage tables are stored
first, and storing them is timed as queries of its own.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tollgate.plans import registry, stages  # noqa: E402
from tollgate.session import build_session  # noqa: E402
from tollgate.sources.shared import remove_run_folder  # noqa: E402

HEADLINE = [
    "b11_staged_table", "c08_enriched_table", "d_card_features_table", "d08_distinct_merchants_last_24h",
    "e_all_features_fused", "e06_history_joined_ledger", "e08_history_on_recent_slice",
    "f05_extract", "g01_filters", "g08_page", "h01_fraud_trends", "h03_top_merchants", "h04_top_cards",
    "i01_dataset_overview", "i02_filtered_statistics", "j02_risk_band", "j07_ensemble_score",
    "k01_rule_explanation", "k05_contribution_texts", "l01_train_test_split", "l03_roc_auc", "l05_roc_curve",
    "l09_score_boxes", "m04_most_missing", "m09_pareto", "n04_card_activity_statistics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false",
        spark_driver_memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    for stage in ("enriched", "features", "risk", "ledger"):
        timed(f"store_{stage}", lambda: stages.stage_table(spark, sf_dir, stage))
    timed("j05_fit_ensemble", lambda: registry.fitted(spark, sf_dir))
    for name in HEADLINE:
        build = registry.QUERIES[name]
        timed(name, lambda: build(spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))
    remove_run_folder(spark)
    spark.stop()


if __name__ == "__main__":
    main()
