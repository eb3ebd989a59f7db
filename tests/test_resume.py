"""Commit records: a later attempt of a run builds only what the earlier one left."""

import datetime as dt
import shutil

import pytest

from retail_lake.params import RunParams
from retail_lake.plans import pipeline
from retail_lake.plans.commits import files_digest
from retail_lake.plans.pipeline import run_pipeline

from conftest import SF_SMALL

PARAMS = RunParams(load_ts=dt.datetime(2001, 8, 1, 6), as_of=dt.date(2001, 8, 1))


def _statuses(res):
    return {r.model: r.status for r in res.run_log.where(f"pipeline_id = '{res.pipeline_id}'").collect()}


def _rows(spark, table):
    return sorted(map(str, spark.table(table).collect()))


def test_a_second_attempt_builds_only_what_is_left(spark, tmp_path, monkeypatch):
    loc = str(tmp_path / "wh")
    run = lambda params=PARAMS, **kw: run_pipeline(
        spark, params, sf_dir=SF_SMALL, location=loc, prefix="resumed_", resume=True, **kw)

    def stopped(lake):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setitem(pipeline.SILVER, "fct_inventory", stopped)
        with pytest.raises(RuntimeError, match="stopped"):
            run()
    assert not spark.catalog.tableExists("resumed_silver.fct_sales")        # written aside, not public
    second = _statuses(run())
    assert {m for m, s in second.items() if s == "success"} == {
        "fct_inventory", "inventory_analysis", "sales_summary_by_product", "sales_summary_by_region", "data_dictionary"}
    assert {second[m] for m in ("raw_stock_levels", "stg_amazon_sales", "stg_stock_history", "fct_sales")} == {"reused"}
    # the resumed run gives what a run in one go gives
    run_pipeline(spark, PARAMS, sf_dir=SF_SMALL, location=str(tmp_path / "whole"), prefix="whole_")
    for t in ("silver.fct_sales", "silver.fct_inventory", "gold.inventory_analysis", "gold.sales_summary_by_product"):
        assert _rows(spark, f"resumed_{t}") == _rows(spark, f"whole_{t}"), t
    assert set(_statuses(run()).values()) == {"reused"}                      # nothing is left
    other = RunParams(load_ts=PARAMS.load_ts, as_of=PARAMS.as_of, usd_inr=1.0)
    assert set(_statuses(run(other)).values()) == {"success"}                # other parameters, another run


def test_a_record_without_its_table_does_not_count(spark, tmp_path):
    run = lambda: run_pipeline(spark, PARAMS, sf_dir=SF_SMALL, layers=("bronze",), prefix="gone_",
                               location=str(tmp_path / "wh"), resume=True)
    run()
    table = spark.table("gone_ops.model_commits").where("model = 'stg_stock_levels'").first().table_name
    spark.sql("DROP VIEW gone_bronze.stg_stock_levels")
    spark.sql(f"DROP TABLE {table}")
    got = _statuses(run())
    assert got.pop("stg_stock_levels") == "success" and set(got.values()) == {"reused"}
    assert spark.table("gone_bronze.stg_stock_levels").count() > 0


def test_a_run_above_bronze_or_over_frames_leaves_no_records(spark, tmp_path):
    from retail_lake.sources import fixtures
    loc = str(tmp_path / "wh")
    raw = {t: spark.createDataFrame(getattr(fixtures, t)(spark, SF_SMALL).limit(50).collect(),
                                    getattr(fixtures, t)(spark, SF_SMALL).schema) for t in pipeline.RAW_TABLES}
    for layers, given in ((("bronze",), raw), (("silver",), None)):
        for _ in range(2):
            res = run_pipeline(spark, PARAMS, raw=given, layers=layers, location=loc, prefix="norec_", gate=False,
                               resume=True)
            assert raw["raw_stock_levels"].inputFiles() == []               # the caller's frames stay as given
            assert set(_statuses(res).values()) == {"success"}
    assert not spark.catalog.tableExists("norec_ops.model_commits")


def test_the_digest_follows_the_files(spark, tmp_path):
    folder = tmp_path / "in [1] {a} b%20c"                                   # names that are patterns or escapes
    folder.mkdir()
    for t in ("nation", "region"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", folder / f"{t}.parquet")
    # the folder's name is a pattern to Spark's reader, so its signs are escaped here as well
    path = str(folder).replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}")
    read = lambda: [spark.read.parquet(f"{path}/nation.parquet")]
    first = files_digest(read())
    assert first is not None and files_digest(read()) == first
    shutil.copyfile(f"{SF_SMALL}/region.parquet", folder / "nation.parquet")
    assert files_digest(read()) != first
    assert files_digest([spark.range(3)]) is None and files_digest([]) is None
