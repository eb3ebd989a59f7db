"""Benchmark: build the whole medallion (10 models + stock history) at one scale.

Each model is built in dependency order from its upstream tables and written
as a table (parquet under the shared checkpoint folder), like one model run of
the reference. One warm-up run, then the median of ``BENCH_RUNS`` timed runs;
every run uses a fresh sink so nothing is reused between runs. The quality
checks and the data dictionary are timed after the build and are not part of
its total.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from retail_lake.lake import Lake  # noqa: E402
from retail_lake.params import FIXTURE_PARAMS  # noqa: E402
from retail_lake.plans.dictionary import DICTIONARY_TABLES, data_dictionary  # noqa: E402
from retail_lake.plans.pipeline import LAYERS  # noqa: E402
from retail_lake.plans.quality import layer_checks, model_table, run_checks  # noqa: E402
from retail_lake.session import build_session  # noqa: E402
from retail_lake.sources.sinks import CheckpointSink  # noqa: E402

MODELS = [
    ("stg_amazon_sales", lambda lake: lake.stg_amazon_sales),
    ("stg_international_sales", lambda lake: lake.stg_international_sales),
    ("stg_stock_levels", lambda lake: lake.stg_stock_levels),
    ("stg_stock_history", lambda lake: lake.stg_stock_history),
    ("dim_customers", lambda lake: lake.dim_customers()),
    ("dim_products", lambda lake: lake.dim_products()),
    ("fct_inventory", lambda lake: lake.fct_inventory),
    ("fct_sales", lambda lake: lake.fct_sales()),
    ("inventory_analysis", lambda lake: lake.inventory_analysis(sort=False)),
    ("sales_summary_by_product", lambda lake: lake.sales_summary_by_product(sort=False)),
    ("sales_summary_by_region", lambda lake: lake.sales_summary_by_region(sort=False)),
]
CHECKS = "quality_checks"                       # all checks in one result, as the layer runner asks them
GOLD = {"inventory_analysis", "sales_summary_by_product", "sales_summary_by_region"}


def one_run(spark, sf_dir: str) -> dict[str, float]:
    sink = CheckpointSink(spark, f"bench-{uuid.uuid4().hex[:8]}")
    lake = Lake(spark, sf_dir, FIXTURE_PARAMS, sink=sink)
    times = {}
    for name, build in MODELS:
        t0 = time.perf_counter()
        df = build(lake)
        if name in GOLD:                      # gold models are written by the run, not cached by the Lake
            lake.provide(name, sink.write(name, df))
        times[name] = time.perf_counter() - t0
    for name, build in ((CHECKS, lambda: run_checks(lake, [c for layer in LAYERS for c in layer_checks(layer)])),
                        ("data_dictionary", lambda: data_dictionary({t: model_table(lake, t) for t in DICTIONARY_TABLES}))):
        t0 = time.perf_counter()
        sink.write(name, build())
        times[name] = time.perf_counter() - t0
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="retail_lake_bench")
    spark.sparkContext.setLogLevel("ERROR")
    one_run(spark, sf_dir)                                    # warm-up (JIT, codegen cache)
    samples = [one_run(spark, sf_dir) for _ in range(runs)]
    per_model = {name: round(statistics.median(s[name] for s in samples), 3) for name in samples[0]}
    total = round(statistics.median(sum(s[name] for name, _ in MODELS) for s in samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "medallion_build_seconds", "value": total, "unit": "sec",
                      "queries": per_model, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
