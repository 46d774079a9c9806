import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("lendnet-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.driver.memory", "6g")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lendnet-test-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lendnet-test-ckpt-"))
    yield s


def edges_df(spark, pairs, types=None):
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows.append((i, a, b, None if types is None else types[i]))
    return spark.createDataFrame(rows, "edge_ord long, src_customer_id string, dst_customer_id string, edge_type string")


def customers_df(spark, rows=()):
    return spark.createDataFrame(list(rows), "customer_id string, person_income double, loan_amnt double, "
                                             "cb_person_default_on_file string")
