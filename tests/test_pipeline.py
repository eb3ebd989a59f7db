"""Layer runner: tables, gates, run log, idempotent history, CSV seeds."""

import datetime as dt

import pytest

from retail_lake.params import RunParams
from retail_lake.plans.pipeline import QualityGateError, run_pipeline
from retail_lake.plans.starter import starter_filter, starter_rows
from retail_lake.sources import fixtures
from retail_lake.sources.seeds import read_seeds

from conftest import SF_SMALL

PARAMS = RunParams(load_ts=dt.datetime(2001, 8, 1, 6), as_of=dt.date(2001, 8, 1))


def test_full_run_writes_layers_and_passes_gates(spark, tmp_path):
    res = run_pipeline(spark, PARAMS, sf_dir=SF_SMALL, location=str(tmp_path / "wh"))
    models = {r.model for r in res.run_log.where(f"pipeline_id = '{res.pipeline_id}'").collect()}
    assert {"stg_amazon_sales", "dim_products", "fct_sales", "sales_summary_by_region",
            "data_dictionary"} <= models
    assert res.quality.where("status = 'failed'").count() == 0
    for t in ("bronze.stg_amazon_sales", "silver.fct_sales", "gold.sales_summary_by_product"):
        assert spark.table(t).count() > 0
    # corrected variant: one product row per SKU, no fan-out
    assert spark.table("silver.dim_products").select("product_sku").distinct().count() == \
        spark.table("silver.dim_products").count()


def test_history_append_is_idempotent(spark, tmp_path):
    loc = str(tmp_path / "wh2")
    spark.sql("DROP TABLE IF EXISTS bronze.stg_stock_history")      # tests share one catalog
    run_pipeline(spark, PARAMS, sf_dir=SF_SMALL, layers=("bronze",), location=loc)
    n1 = spark.table("bronze.stg_stock_history").count()
    run_pipeline(spark, PARAMS, sf_dir=SF_SMALL, layers=("bronze",), location=loc)
    assert spark.table("bronze.stg_stock_history").count() == n1
    later = RunParams(load_ts=dt.datetime(2001, 8, 1, 12), as_of=dt.date(2001, 8, 1))
    run_pipeline(spark, later, sf_dir=SF_SMALL, layers=("bronze",), location=loc)
    assert spark.table("bronze.stg_stock_history").count() == 2 * n1


def test_reference_variant_is_stopped_by_the_silver_gate(spark, tmp_path):
    with pytest.raises(QualityGateError) as err:
        run_pipeline(spark, PARAMS, sf_dir=SF_SMALL, location=str(tmp_path / "wh3"), corrected=False)
    assert err.value.layer == "silver"
    assert any(r.check_name == "row_count_preserved" for r in err.value.failures)


def test_csv_seeds_give_the_same_bronze(spark, tmp_path):
    paths = {}
    for t, build in [("raw_amazon_sales", fixtures.raw_amazon_sales),
                     ("raw_international_sales", fixtures.raw_international_sales),
                     ("raw_stock_levels", fixtures.raw_stock_levels)]:
        p = str(tmp_path / t)
        build(spark, SF_SMALL).write.option("header", True).csv(p)
        paths[t] = p
    raw = read_seeds(spark, paths)
    assert raw["raw_amazon_sales"].columns[4] == "Sales Channel "
    from retail_lake.lake import Lake
    a = Lake(spark, SF_SMALL, PARAMS, materialize=False).stg_amazon_sales
    b = Lake(spark, None, PARAMS, materialize=False, raw=raw).stg_amazon_sales
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_starter_models_and_column_tests(spark):
    first = starter_rows(spark)
    assert first.where("id IS NULL").count() == 1          # not_null test fails on the starter row
    assert first.where("id IS NOT NULL").groupBy("id").count().where("count > 1").count() == 0  # unique
    assert [r.id for r in starter_filter(first).collect()] == [1]


def test_view_sink_registers_a_session_view(spark):
    from retail_lake.lake import Lake
    from retail_lake.sources.sinks import register_view
    df = Lake(spark, SF_SMALL).sales_summary_by_region()
    register_view(df, "gold_region_view")
    assert spark.table("gold_region_view").count() == df.count()


def test_command_line_run(spark, tmp_path, capsys):
    from retail_lake.__main__ import main
    code = main(["--sf-dir", SF_SMALL, "--layers", "bronze", "--load-ts", "2001-08-01T06:00:00",
                 "--as-of", "2001-08-01", "--warehouse", str(tmp_path / "cli")], spark=spark)
    assert code == 0
    assert '"model": "stg_amazon_sales"' in capsys.readouterr().out


def test_command_line_run_from_seed_csvs(spark, tmp_path, capsys):
    from retail_lake.__main__ import main
    paths = []
    for build in (fixtures.raw_amazon_sales, fixtures.raw_international_sales, fixtures.raw_stock_levels):
        p = str(tmp_path / build.__name__)
        build(spark, SF_SMALL).write.option("header", True).csv(p)
        paths.append(p)
    code = main(["--seeds", *paths, "--layers", "bronze", "silver", "--load-ts", "2001-08-01T06:00:00",
                 "--as-of", "2001-08-01", "--warehouse", str(tmp_path / "cli2")], spark=spark)
    out = capsys.readouterr().out
    assert code == 0 and '"model": "fct_sales"' in out and '"model": "raw_amazon_sales"' in out
    # corrected variant: the sales fact keeps exactly the staged sales rows (no fan-out)
    staged = (spark.table("bronze.stg_amazon_sales").where("order_status NOT IN ('Cancelled')").count()
              + spark.table("bronze.stg_international_sales").where("transaction_id IS NOT NULL").count())
    assert spark.table("silver.fct_sales").count() == staged


def test_layers_read_what_was_written_and_keep_the_history(spark, tmp_path):
    loc = str(tmp_path / "wh4")
    spark.sql("DROP TABLE IF EXISTS bronze.stg_stock_history")
    run_pipeline(spark, PARAMS, sf_dir=SF_SMALL, location=loc)
    before = spark.table("bronze.stg_stock_history").count()
    for layers in (("silver",), ("gold",)):
        res = run_pipeline(spark, PARAMS, layers=layers, location=loc)       # no input: upstream comes from the tables
        own = {r.layer for r in res.run_log.where(f"pipeline_id = '{res.pipeline_id}'").collect()}
        assert own == set(layers) | ({"docs"} if layers == ("gold",) else set())
        assert res.quality.where("status = 'failed'").count() == 0
    assert spark.table("bronze.stg_stock_history").count() == before
    runs = spark.table("ops.quality_results").select("pipeline_id").distinct().count()
    assert runs >= 3                                                         # results are appended


def test_a_failing_model_is_logged(spark, tmp_path, monkeypatch):
    from retail_lake.plans import pipeline

    def broken(lake):
        raise RuntimeError("broken model")

    monkeypatch.setitem(pipeline.BRONZE, "stg_amazon_sales", broken)
    n = spark.table("ops.run_log").where("status = 'failed'").count()
    with pytest.raises(RuntimeError, match="broken model"):
        run_pipeline(spark, PARAMS, sf_dir=SF_SMALL, layers=("bronze",), location=str(tmp_path / "wh5"))
    assert spark.table("ops.run_log").where("status = 'failed'").count() == n + 1


def _rows(spark, table):
    return sorted(map(str, spark.table(table).collect()))


def test_a_failing_layer_is_never_public(spark, tmp_path, monkeypatch):
    """Write, audit, publish: after a failed gate, or a run that stops half-way, the tables before read unchanged."""
    from retail_lake.plans import pipeline
    loc = str(tmp_path / "wh6")
    run_pipeline(spark, PARAMS, sf_dir=SF_SMALL, location=loc)
    names = ("silver.fct_sales", "silver.dim_products", "gold.sales_summary_by_region")
    before = {t: _rows(spark, t) for t in names}
    public = max(t.name for t in spark.catalog.listTables("silver_versions") if t.name.startswith("fct_sales__"))
    with pytest.raises(QualityGateError):
        run_pipeline(spark, PARAMS, sf_dir=SF_SMALL, location=loc, corrected=False)
    assert {t: _rows(spark, t) for t in names} == before
    later = RunParams(load_ts=dt.datetime(2001, 8, 1, 12), as_of=dt.date(2001, 8, 1), usd_inr=1.0)

    def stopped(lake):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setitem(pipeline.SILVER, "fct_inventory", stopped)     # fct_sales of that run is already written aside
        with pytest.raises(RuntimeError, match="stopped"):
            run_pipeline(spark, later, sf_dir=SF_SMALL, layers=("silver",), location=loc)
    assert {t: _rows(spark, t) for t in names} == before
    run_pipeline(spark, later, layers=("silver",), location=loc)
    assert _rows(spark, "silver.fct_sales") != before["silver.fct_sales"]
    kept = [t.name for t in spark.catalog.listTables("silver_versions") if t.name.startswith("fct_sales__")]
    assert len(kept) == 2 and public in kept                     # the public version and the one before


def test_lakes_over_other_frames_share_nothing(spark):
    from retail_lake.lake import Lake
    frame = lambda *skus: spark.createDataFrame(
        [(k, "D", 1, "C", "S", "Red") for k in skus],
        "`SKU Code` string, `Design No.` string, Stock int, Category string, Size string, Color string")
    first = Lake(spark, params=PARAMS, raw={"raw_stock_levels": frame("SKU1")}).stg_stock_levels
    second = Lake(spark, params=PARAMS, raw={"raw_stock_levels": frame("SKU2", "SKU3")}).stg_stock_levels
    assert [r.sku_code for r in first.collect()] == ["SKU1"]
    assert sorted(r.sku_code for r in second.collect()) == ["SKU2", "SKU3"]


def test_seeds_are_read_by_header_name(spark, tmp_path):
    from retail_lake.sources.seeds import malformed_values, read_seed
    f = tmp_path / "stock.csv"
    f.write_text("index,Stock,SKU Code,Color,Design No.,Category,Size\n"
                 "0,5,SKU1,Red,D,C,S\n1,twelve,SKU2,Blue,D,C,M\n")
    rows = read_seed(spark, "raw_stock_levels", str(f)).select("`SKU Code`", "Stock").collect()
    assert [tuple(r) for r in rows] == [("SKU1", 5), ("SKU2", None)]
    counts = {r.column_name: r.malformed for r in malformed_values(spark, "raw_stock_levels", str(f)).collect()}
    assert counts["Stock"] == 1 and sum(counts.values()) == 1
    g = tmp_path / "short.csv"
    g.write_text("SKU Code,Stock\nSKU1,5\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        read_seed(spark, "raw_stock_levels", str(g))
