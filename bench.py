"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

The raw and the cleaned layer are built once and reported as queries of their own; the others read them, as the
features of a warehouse do. Results go to Spark's noop sink, so every row is computed."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from checks.compare import session
from checks.layers import dwd, ods
from checks.queries import QUERIES
from rankhouse.plans.features import FEATURES

HEADLINE = [
    "clean_all",
    "agg_global_means",
    "agg_global_quartiles",
    "win_dedup_latest",
    "win_category_avg",
    "win_dense_rank",
    *FEATURES,
    "q_heat_growth_top",
    "q_category_avg_heat",
    "q_ip_value_top",
    "q_payment_power",
    "doc_heat_trapezoid",
    "x_ranklist_flatten",
    "x_upsert_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        started = time.monotonic()
        action()
        seconds[name] = round(time.monotonic() - started, 3)

    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    timed("layer_ods", lambda: ods(spark, sf_dir))
    timed("layer_dwd", lambda: dwd(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda name=name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
