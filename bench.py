"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed in full (every column computed) into Spark's ``noop``
sink and timed; prints ONE JSON line.  The feature table is first computed
directly (``feature_table``: book -> 255 features), then stored once
(``feature_store``) and read by the downstream queries, the way the engine
runs them.

Every query runs twice in the same session: ``queries`` reports the second
(warm) run, ``cold`` the first, which also pays JIT and code generation for
the plan -- a fixed cost per executor JVM that does not grow with the data.
``feature_store`` writes the table, so it runs once.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from volspark.plans import queries as Q  # noqa: E402
from volspark.plans import registry_extra  # noqa: E402,F401
from volspark.session import local_session  # noqa: E402

HEADLINE = [
    "book_regular_grid",
    "window_target",
    "feature_table",
    "feature_store",
    "baseline_forecasts",
    "metrics_by_fold",
    "universe_summary",
    "model_comparison",
    "stock_similarity",
    "realised_series",
    "prediction_curves",
    "legacy_window_features",
    "har_lags",
    "cluster_variance",
    "ml_linear",
    "ml_tree",
    "garch_window",
    "gjr_garch_window",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus != "*" else 16, app="volspark-bench")
    # a fresh feature table for this run (never one left by an earlier run)
    spark.conf.set("volspark.store.salt", f"bench-{time.time_ns()}")
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(1 if name == "feature_store" else 2):
            t0 = time.perf_counter()
            if name == "feature_store":
                Q.stored(spark, sf_dir)
            else:
                Q.run(spark, name, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - t0, 3))
        cold[name] = runs[0]
        times[name] = runs[-1]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
