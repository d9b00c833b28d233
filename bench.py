"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores. One query and
one scoring run warm the session up; then each query is run to its end once, its rows
going to no sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from tastegrid.session import build_session  # noqa: E402
from tastegrid.workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "train_movie", "training_matrix_movie", "watch_counts", "split_counts", "item_rules",
    "item_rules_division", "score_crossnet", "roc_auc", "tri_bce_weighted", "topn_crossnet",
    "topn_meta", "rule_content", "gradient_pass", "validation_pass",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in ("train_movie", "score_crossnet"):
        run(spark, name, sf_dir)
    for name in HEADLINE:
        times[name] = round(run(spark, name, sf_dir), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
