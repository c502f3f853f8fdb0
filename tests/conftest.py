import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("siltstone-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def customer_df(spark):
    return spark.createDataFrame(
        [("C001", "Alice", "USA"), ("C002", "Bob", "Canada")],
        "customer_id string, customer_name string, country string",
    )


@pytest.fixture
def product_df(spark):
    return spark.createDataFrame(
        [("P001", "Furniture", "Chair"), ("P002", "Technology", "Laptop")],
        "product_id string, category string, sub_category string",
    )


@pytest.fixture
def order_df(spark):
    return spark.createDataFrame(
        [("O001", "C001", "P001", 2024, 100.50, 2), ("O002", "C002", "P002", 2024, 250.75, 1)],
        "order_id string, customer_id string, product_id string, year bigint, profit double, quantity bigint",
    )
