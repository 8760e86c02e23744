"""Headline timings. Prints one JSON line.

Three groups of queries, at $BENCH_SF_DIR on local[$BENCH_CPUS]:

* ``stage_*``  one stage of the batch over the whole tables;
* ``vw_*``     an analytical view over the stored warehouse, as dashboards use it;
* ``plan_*``   a view from raw tables through the star schema in one plan.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from tillmart.operators import infer, profile
from tillmart.plans.gold import GoldLayer, build_gold_layer
from tillmart.plans.views import VIEWS, view
from tillmart.registry import fixtures as fx
from tillmart.registry.raw import raw_headers
from tillmart.operators.silver import silver_pipeline
from tillmart.session import configure, scratch_path
from tillmart.sinks.warehouse import open_warehouse, write_warehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    """Local session with one shuffle partition per core."""
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tillmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def run(df: DataFrame) -> None:
    """Compute every row without keeping it."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    """Time everything."""
    spark = session()
    times: dict[str, float] = {}

    def timed(name: str, work):
        # Twice, the better one counts: the first run also compiles its code.
        for _ in range(2):
            started = time.perf_counter()
            result = work()
            spent = round(time.perf_counter() - started, 3)
            times[name] = min(spent, times.get(name, spent))
        return result

    timed("stage_enrich", lambda: run(fx.enriched(spark, SF_DIR)))
    timed("stage_silver", lambda: run(silver_pipeline(raw_headers(spark, SF_DIR)).rows))
    timed("stage_infer", lambda: infer.infer_types(raw_headers(spark, SF_DIR)))

    def gold() -> GoldLayer:
        return build_gold_layer(
            fx.enriched(spark, SF_DIR), fx.lines(spark, SF_DIR), fx.tickets(spark, SF_DIR)
        )

    root = scratch_path(spark, "bench")
    built = timed("stage_dimensions", gold)
    timed("stage_warehouse", lambda: write_warehouse(built.tables(), root))
    stored = open_warehouse(spark, root, tuple(built.tables()), "bench_")
    for name in VIEWS:
        timed(name, lambda name=name: run(view(stored, name)))
    for name in ("vw_daily_sales", "vw_item_performance", "vw_order_status_analysis"):
        timed(f"plan_{name}", lambda name=name: run(view(built.tables(), name)))
    timed("stage_profile_columns", lambda: run(profile.profile_columns(fx.lines(spark, SF_DIR))))
    timed("stage_profile_numeric", lambda: run(profile.profile_numeric(fx.lines(spark, SF_DIR))))
    print(
        json.dumps(
            {
                "metric": "total seconds for batch stages and sixteen views",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
