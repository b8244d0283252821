"""Times the daily job, the indicators and pair models, and prints one JSON line.

``daily_job`` cleans the raw Parquet files, checks them and writes the star schema once; the indicators after it
read those tables, as they would in production. ``from_raw:*`` plan everything from the raw files instead.
"""

from __future__ import annotations

import json
import os
import sys
import time

from emporia.plans.daily import run_daily
from emporia.plans.warehouse import MODELS, Warehouse, build_order
from emporia.session import local_session
from emporia.sources.projections import RawTables
from emporia.sources.shared import new_path
from workload import learning as _learning  # noqa: F401  registers its queries
from workload import models, relational  # noqa: F401
from workload.registry import QUERIES

LEARNING = [
    "ml_correlation_matrix",
    "ml_multiple_regression",
    "ml_split_ordered",
    "ml_boosted_trees",
    "ml_grid_search",
    "ml_random_forest",
    "pattern_affinity_pairs",
    "pattern_global_rank",
    "pattern_median_segmentation",
    "pattern_following_count",
]

FROM_RAW = [
    "mrt_fct_commandes",
    "v_segmentation_produits",
    "v_produits_achetes_ensemble",
    "v_effets_promotions",
    "impacts_reseaux_sur_business",
    "performance_retard_satisfaction",
]


def run(df) -> None:
    """Compute every row and column without bringing them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "*"), os.environ.get("BENCH_MEMORY", "8g"))
    made = models.queries()
    run(made["v_effets_promotions"](spark, folder))  # start-up of the JVM is not part of any query
    seconds: dict[str, float] = {}
    built: list[Warehouse] = []
    store = new_path(spark, "bench-store")
    seconds["daily_job"] = timed(lambda: built.append(run_daily(spark, RawTables(spark, folder), store, calendar=None)))
    for name in sys.argv[1:] or build_order():
        if not name.startswith("stg_") and not MODELS[name].table:
            seconds[name] = timed(lambda n=name: run(built[0].ref(n)))
    for name in FROM_RAW:
        seconds[f"from_raw:{name}"] = timed(lambda n=name: run(made[n](spark, folder)))
    learning = {name: timed(lambda n=name: run(QUERIES[n](spark, folder))) for name in LEARNING if name in QUERIES}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "learning_and_patterns": learning,  # not part of the total, which stays comparable between rounds
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
