"""The starter example models (M11, M12) and their column tests.

They read only literal rows, so they are covered by unit tests and are not
registered as queries (every registered query reads the input tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def starter_rows(spark: SparkSession) -> DataFrame:
    """``select 1 as id union all select null as id`` (materialised as a table)."""
    return spark.createDataFrame([(1,), (None,)], "id int")


def starter_filter(first: DataFrame) -> DataFrame:
    """``select * from my_first_dbt_model where id = 1``."""
    return first.where("id = 1")
