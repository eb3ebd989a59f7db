"""Column sketches: kept per load, merged without reading the tables, within their bounds."""

from retail_lake.plans.sketches import DISTINCT_BOUND, RANK_BOUND, SketchStore, load_sketches, merged_dictionary


def _table(spark, rows: int):
    return spark.range(rows).selectExpr(
        "CAST(id % 5 AS STRING) AS load_day", "id AS key", "CAST(id * 7919 % 20011 AS INT) AS spread",
        "CASE WHEN id % 3 > 0 THEN CAST(id % 4 AS STRING) END AS few", "IF(id % 2 = 0, '', 'x') AS blank",
        "CAST(NULL AS DOUBLE) AS nothing")


def _by_column(df):
    return {r.column_name: r for r in df.collect()}


def test_loads_added_one_by_one_equal_all_at_once(spark, tmp_path):
    df = _table(spark, 60_000)
    whole, steps = SketchStore(spark, str(tmp_path / "a")), SketchStore(spark, str(tmp_path / "b"))
    whole.add("t", df, "load_day")
    for day in ("0", "1", "2", "3", "4", "2"):                   # day 2 is sent twice and replaces itself
        steps.add("t", df.where(f"load_day = '{day}'"), "load_day")
    steps.add("u", df.where("key < 10"))                           # another table beside it
    one, many = (_by_column(merged_dictionary(s.read().where("table_name = 't'"))) for s in (whole, steps))
    for name, row in one.items():
        assert (row.row_count, row.null_count, row.distinct_estimate) == (
            many[name].row_count, many[name].null_count, many[name].distinct_estimate), name
    assert steps.read().select("load").distinct().count() == 6
    exact = {"key": 60_000, "spread": 20_011, "few": 4, "blank": 2, "load_day": 5, "nothing": 0}
    for name, n in exact.items():
        assert many[name].row_count == 60_000
        assert abs(many[name].distinct_estimate - n) <= DISTINCT_BOUND * n, name
    assert many["few"].null_count == 20_000 and many["nothing"].null_count == 60_000
    assert many["nothing"].median is None and many["blank"].median is None
    for name in ("key", "spread"):
        for at, value in ((0.25, many[name].quartile_1), (0.5, many[name].median), (0.75, many[name].quartile_3)):
            rank = df.where(f"{name} <= {value}").count() / 60_000
            assert abs(rank - at) <= RANK_BOUND, (name, at)


def test_a_load_reads_its_rows_once_and_a_merge_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    _table(spark, 1_000).write.partitionBy("load_day").parquet(path)
    plan = load_sketches(spark.read.parquet(path).where("load_day = 3"), "load_day") \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(load_day" in plan and "Expand" not in plan
    store = SketchStore(spark, str(tmp_path / "s"))
    store.add("t", spark.read.parquet(path), "load_day")
    merged = merged_dictionary(store.read())
    assert all("/s/" in f for f in merged.inputFiles()) and len(merged.inputFiles()) == 5


def test_empty_tables_and_null_loads(spark, tmp_path):
    store = SketchStore(spark, str(tmp_path / "s"))
    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "load string, v int")
    store.add("t", df, "load")
    store.add("empty", df.where("v > 5"), "load")                  # no load, no rows
    got = _by_column(merged_dictionary(store.read()))
    assert got["v"].row_count == 3 and got["v"].distinct_estimate == 3 and got["load"].null_count == 2
