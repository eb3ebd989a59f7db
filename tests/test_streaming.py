"""Stock-file intake stream: each new file is one load, replays are no-ops."""

import datetime as dt

from retail_lake.sources import fixtures
from retail_lake.sources.sinks import CatalogSink
from retail_lake.streaming.stock_intake import ingest_stock_files

from conftest import SF_SMALL


def test_files_become_history_exactly_once(spark, tmp_path):
    landing, ckpt = tmp_path / "landing", str(tmp_path / "ckpt")
    raw = fixtures.raw_stock_levels(spark, SF_SMALL)
    raw.coalesce(1).write.option("header", True).csv(str(landing / "load1"))
    sink = CatalogSink(spark, location=str(tmp_path / "wh"))
    spark.sql("DROP TABLE IF EXISTS bronze.stg_stock_history")
    expected = raw.where("`SKU Code` IS NOT NULL").count()
    ingest_stock_files(spark, str(landing), sink, dt.datetime(2001, 8, 2, 0), ckpt)
    assert spark.table("bronze.stg_stock_history").count() == expected
    # same files again: the stream checkpoint already has them
    ingest_stock_files(spark, str(landing), sink, dt.datetime(2001, 8, 2, 6), ckpt)
    assert spark.table("bronze.stg_stock_history").count() == expected
    # a new file is a new load
    raw.coalesce(1).write.option("header", True).csv(str(landing / "load2"))
    ingest_stock_files(spark, str(landing), sink, dt.datetime(2001, 8, 2, 12), ckpt)
    loads = spark.table("bronze.stg_stock_history").select("load_id").distinct().count()
    assert spark.table("bronze.stg_stock_history").count() == 2 * expected and loads == 2


def _stock_file(folder, n: int) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"f{n:04d}.csv").write_text("SKU Code,Design No.,Stock,Category,Size,Color\n" f"SKU{n},D,1,C,S,Red\n")


def test_no_batch_replaces_another(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS bronze.stg_stock_history")
    sink = CatalogSink(spark, location=str(tmp_path / "wh"))
    for n in range(130):                                   # more than one micro-batch, one load time
        _stock_file(tmp_path / "landing", n)
    ingest_stock_files(spark, str(tmp_path / "landing"), sink, dt.datetime(2001, 8, 2), str(tmp_path / "ckpt"))
    assert spark.table("bronze.stg_stock_history").count() == 130
    _stock_file(tmp_path / "landing", 130)                 # another load in the same second
    ingest_stock_files(spark, str(tmp_path / "landing"), sink, dt.datetime(2001, 8, 2), str(tmp_path / "ckpt"))
    assert spark.table("bronze.stg_stock_history").count() == 131


def test_a_replayed_batch_is_not_doubled(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS bronze.stg_stock_history")
    sink = CatalogSink(spark, location=str(tmp_path / "wh"))
    ckpt = tmp_path / "ckpt"
    _stock_file(tmp_path / "landing", 1)
    ingest_stock_files(spark, str(tmp_path / "landing"), sink, None, str(ckpt))
    for f in (ckpt / "commits").iterdir():                 # as after a crash between write and commit
        f.unlink()
    ingest_stock_files(spark, str(tmp_path / "landing"), sink, None, str(ckpt))
    assert spark.table("bronze.stg_stock_history").count() == 1
