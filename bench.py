"""Benchmark: headline plans at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion through the ``noop`` sink (every row is
produced, nothing is collected). The first query also pays session warm-up
(JVM, Python workers), so a warm-up query runs before timing starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from patrolcast.plans import load_all  # noqa: E402
from patrolcast.plans.flagship import flagship  # noqa: E402
from patrolcast.session import local_session  # noqa: E402

HEADLINE = [
    ("repair", "d4_handle_outliers"),
    ("features", "h17_main_clean"),
    ("describe", "b1_describe"),
    ("class_moments", "e7_class_moments"),
    ("lda", "k1_lda"),
    ("qda", "k2_qda"),
    ("logistic_multinomial", "k3_logistic_multinomial"),
    ("logistic_ova", "k4_logistic_ova"),
    ("modified_huber_ova", "k5_modified_huber_ova"),
    ("hinge_calibrated", "k6_hinge_ova"),
    ("svc_hinge_calibrated", "k7_linear_svc_hinge"),
    ("svc_squared_hinge_calibrated", "k8_linear_svc_squared_hinge"),
    ("grid_search", "j3_grid_search"),
    ("random_forest", "k11_random_forest"),
    ("boost_depthwise", "k12_boosted_trees_depthwise"),
    ("boost_leafwise", "k13_boosted_trees_leafwise"),
    ("boost_symmetric", "k14_boosted_trees_symmetric"),
    ("boost_cv", "j4_boost_cv"),
    ("rbf_svm", "k9_rbf_svm"),
    ("cross_val_score", "j2_cross_val_score"),
    ("grid_search_calibrated", "j3b_grid_search_calibrated"),
    ("random_search", "j5_random_search"),
    ("oob_log_loss", "j7_oob_log_loss"),
]


def run(df) -> None:
    df.write.mode("overwrite").format("noop").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, driver_memory="16g")
    reg = load_all()
    run(reg["g1_trig"].build(spark, sf_dir))  # warm-up
    times = {}
    t0 = time.time()
    for name, key in HEADLINE:
        t = time.time()
        run(reg[key].build(spark, sf_dir))
        times[name] = round(time.time() - t, 3)
    t = time.time()
    run(flagship(spark, sf_dir))
    times["flagship"] = round(time.time() - t, 3)
    total = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
