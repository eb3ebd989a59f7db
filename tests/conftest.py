import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from retail_lake.session import build_session, ensure_checkpoint_dir
    warehouse = tmp_path_factory.mktemp("warehouse")
    spark = build_session("local[4]", 8, app_name="retail_lake_tests",
                          extra={"spark.sql.warehouse.dir": str(warehouse)})
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, str(tmp_path_factory.mktemp("checkpoints")))
    yield spark
    spark.stop()
