import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").appName("siltgate-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from siltgate.sources.inputs import Inputs

    return Inputs(spark, FOLDER)


CUSTOMER = ("customer_id string, customer_unique_id string, customer_zip_code_prefix bigint, "
            "customer_city string, customer_state string")
PAYMENT = ("order_id string, payment_sequential int, payment_type string, "
           "payment_installments int, payment_value double")


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([
        ("c1", "u1", 1310, "sao paulo", "SP"), ("c2", "u2", 20040, "rio de janeiro", "RJ"),
        ("c3", "u3", 30130, "belo horizonte", "MG"), ("c4", "u4", 80010, "curitiba", "PR"),
        ("c5", "u5", 90010, "porto alegre", "RS")], CUSTOMER)


@pytest.fixture
def dirty_customers(spark):
    return spark.createDataFrame([
        ("c1", "u1", 1310, "sao paulo", "SP"), (None, "u2", 20040, "rio de janeiro", "INVALID"),
        ("c3", "u3", 30130, "belo horizonte", "MG"), ("c4", "u4", 80010, "curitiba", "PR"),
        ("c1", "u5", 90010, "porto alegre", "RS")], CUSTOMER)


@pytest.fixture
def payments(spark):
    return spark.createDataFrame([
        ("o1", 1, "credit_card", 3, 150.0), ("o2", 1, "boleto", 1, 89.9), ("o3", 2, "voucher", 1, 45.0)], PAYMENT)


@pytest.fixture
def dirty_payments(spark):
    return spark.createDataFrame([
        ("o1", 1, "credit_card", 3, 150.0), (None, 1, "INVALID_TYPE", 1, -50.0), ("o3", 2, "voucher", 1, 45.0)],
        PAYMENT)
