"""Layer runner: seed -> bronze -> checks -> silver -> checks -> gold -> checks.

Models are built in dependency order; each is written as a table (one
database per layer) and read back by the next, as in the reference's table
materialisation. After each layer its quality checks run as Spark aggregates;
a check with status 'failed' stops the run (the reference only logged
failures). Models are published after their layer's checks: write, audit,
publish. A layer that fails, or a run that stops half-way, leaves the tables of
the run before in place. Every model step appends a row to the run log, a failing one with
status 'failed'. With ``resume`` every built model leaves a commit record, and a later attempt of the same run
takes the recorded models over (status 'reused') and builds the others (plans/commits.py). A layer that is not selected is not touched: the layers above
read the tables that an earlier run wrote.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.lake import Lake
from retail_lake.operators.stages import stage, staged_for_block
from retail_lake.params import RunParams
from retail_lake.plans import quality
from retail_lake.plans.commits import Commits, run_key
from retail_lake.plans.dictionary import data_dictionary
from retail_lake.session import ensure_checkpoint_dir
from retail_lake.sources.sinks import CatalogSink

RAW_TABLES = ("raw_amazon_sales", "raw_international_sales", "raw_stock_levels")
# Models of each layer in dependency order, with how a Lake produces them.
BRONZE = {"stg_amazon_sales": lambda lake: lake.stg_amazon_sales,
          "stg_international_sales": lambda lake: lake.stg_international_sales,
          "stg_stock_levels": lambda lake: lake.stg_stock_levels}
SILVER = {"dim_customers": lambda lake: lake.dim_customers(),
          "dim_products": lambda lake: lake.dim_products(),
          "fct_sales": lambda lake: lake.fct_sales(),
          "fct_inventory": lambda lake: lake.fct_inventory}
# The models' final order is for readers; a table build does not sort.
GOLD = {"inventory_analysis": lambda lake: lake.inventory_analysis(sort=False),
        "sales_summary_by_product": lambda lake: lake.sales_summary_by_product(sort=False),
        "sales_summary_by_region": lambda lake: lake.sales_summary_by_region(sort=False)}
LAYERS = ("bronze", "silver", "gold")
RUN_LOG_SCHEMA = ("pipeline_id string, layer string, model string, status string, row_count bigint, "
                  "started_at timestamp_ntz, seconds double")


class QualityGateError(RuntimeError):
    def __init__(self, layer: str, failures: list):
        self.layer, self.failures = layer, failures
        super().__init__(f"{layer} checks failed: " + "; ".join(
            f"{r.table_name}.{r.check_name}={r.violations}" for r in failures))


@dataclass
class RunResult:
    pipeline_id: str
    run_log: DataFrame
    quality: DataFrame


def run_pipeline(spark: SparkSession, params: RunParams, raw: dict[str, DataFrame] | None = None,
                 sf_dir: str | None = None, layers: tuple[str, ...] = LAYERS, fmt: str = "parquet",
                 location: str | None = None, corrected: bool = True, gate: bool = True,
                 malformed: DataFrame | None = None, resume: bool = False, prefix: str = "") -> RunResult:
    """Build the selected layers. ``raw``: raw DataFrames (e.g. from seed CSVs);
    otherwise the fixture mapping over ``sf_dir`` plays the raw files.
    ``malformed``: counts of ``sources.seeds.malformed_values``, recorded with the bronze checks.
    ``resume``: models that an earlier attempt with the same files and parameters recorded are not built again.
    ``prefix`` stands before the databases' names. What the models stage on the way is removed at the end."""
    with staged_for_block(spark):
        return _run(spark, params, raw, sf_dir, layers, CatalogSink(spark, fmt, location, prefix), corrected, gate,
                    malformed, resume)


def _run(spark: SparkSession, params: RunParams, raw: dict[str, DataFrame] | None, sf_dir: str | None,
         layers: tuple[str, ...], sink: CatalogSink, corrected: bool, gate: bool,
         malformed: DataFrame | None, resume: bool) -> RunResult:
    pipeline_id = f"run_{params.load_ts:%Y%m%d%H%M%S}_{uuid.uuid4().hex[:6]}"
    lake = Lake(spark, sf_dir, params, raw=raw, sink=sink, corrected=corrected)
    log: list[tuple] = []
    checks: list[DataFrame] = []
    from_bronze = set(layers) == set(LAYERS[:len(set(layers))])     # nothing is read that another run published
    commits = Commits(sink, run_key([getattr(lake, t) for t in RAW_TABLES], params, corrected, sink.fmt)
                      if resume and from_bronze else None)

    def step(layer: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        started, t0 = dt.datetime.now().replace(microsecond=0), time.time()
        if (built := commits.find(name)) is not None:
            df = sink.adopt(name, built.table_name)
            lake.provide(name, df)
            log.append((pipeline_id, layer, name, "reused", built.row_count, started, round(time.time() - t0, 3)))
            return df
        try:
            df = build()
            rows = df.count()
        except Exception:
            log.append((pipeline_id, layer, name, "failed", None, started, round(time.time() - t0, 3)))
            _write_log(spark, sink, log)
            raise
        commits.add(layer, name, sink.written_as(name), rows)
        log.append((pipeline_id, layer, name, "success", rows, started, round(time.time() - t0, 3)))
        return df

    def check(layer: str) -> None:
        results = quality.run_checks(lake, quality.layer_checks(layer))
        if layer == "bronze" and malformed is not None:
            results = results.unionByName(quality.seed_value_results(malformed))
        written = sink.append("quality_results", results.withColumn("pipeline_id", F.lit(pipeline_id))
                              .withColumn("checked_layer", F.lit(layer)))
        written = written.where((F.col("pipeline_id") == pipeline_id) & (F.col("checked_layer") == layer)) \
                         .drop("checked_layer")
        checks.append(written)
        failed = written.where("status = 'failed'").collect()   # at most one row per check
        if gate and failed:
            _write_log(spark, sink, log)
            raise QualityGateError(layer, failed)
        sink.publish()

    if "bronze" in layers:
        # seed: land the raw files as bronze tables, then read them back
        landed = {t: step("seed", t, lambda t=t: sink.write(t, getattr(lake, t))) for t in RAW_TABLES}
        lake.raw.update(landed)
        for name, build in BRONZE.items():
            step("bronze", name, lambda build=build: build(lake))
        check("bronze")
        history = step("bronze", "stg_stock_history", lambda: sink.append_partition(
            "stg_stock_history",
            lake.stg_stock_levels.withColumn("load_id", F.date_format("loaded_timestamp", "yyyyMMddHHmmss")),
            "load_id"))
        lake.provide("stg_stock_history", history.drop("load_id"))
    else:
        for name in BRONZE:
            lake.provide(name, sink.table(name))
        lake.provide("stg_stock_history", sink.table("stg_stock_history").drop("load_id"))
    if "silver" in layers:
        for name, build in SILVER.items():
            step("silver", name, lambda build=build: build(lake))
        check("silver")
    elif "gold" in layers:
        for name in SILVER:
            lake.provide(name, sink.table(name))
    if "gold" in layers:
        for name, build in GOLD.items():
            lake.provide(name, step("gold", name, lambda name=name, build=build: sink.write(name, build(lake))))
        check("gold")
        step("docs", "data_dictionary", lambda: sink.write("data_dictionary", data_dictionary(
            {name: build(lake) for name, build in SILVER.items()})))
        sink.publish()
    run_log = _write_log(spark, sink, log)
    quality_rows = reduce(DataFrame.unionByName, checks) if checks else None
    return RunResult(pipeline_id, run_log, quality_rows)


def _write_log(spark: SparkSession, sink: CatalogSink, log: list[tuple]) -> DataFrame:
    """Append this run's step rows to ops.run_log (a small, bounded driver-side list)."""
    return sink.append("run_log", spark.createDataFrame(log, RUN_LOG_SCHEMA))


def layer_run(lake: Lake) -> DataFrame:
    """One scheduled run over the folder in two attempts, as rows (attempt, layer, model, status, row_count).

    The first attempt builds bronze and silver; the second is asked for every layer, takes those over and builds
    gold. The run has databases of its own under the shared checkpoint folder, which go at the end. Failed checks
    do not stop it: the ``dq_*`` queries report them.
    """
    spark, prefix = lake.spark, f"run_{uuid.uuid4().hex[:8]}_"
    location = f"{ensure_checkpoint_dir(spark).rstrip('/')}/retail_lake/{prefix}"
    attempts = [run_pipeline(spark, lake.params, sf_dir=lake.sf_dir, layers=layers, location=location, gate=False,
                             resume=True, prefix=prefix) for layers in (("bronze", "silver"), LAYERS)]
    rows = reduce(DataFrame.unionByName, [
        run.run_log.where((F.col("pipeline_id") == run.pipeline_id) & (F.col("layer") != "docs"))
           .select(F.lit(n).alias("attempt"), "layer", "model", "status", "row_count")
        for n, run in enumerate(attempts, 1)])
    written = stage(rows, "layer_run")
    for row in spark.sql(f"SHOW DATABASES LIKE '{prefix}*'").collect():
        spark.sql(f"DROP DATABASE {row.namespace} CASCADE")
    return written
