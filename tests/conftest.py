import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A session as a user has it: none of the library's own settings.
    builder = SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
    session = builder.getOrCreate()
    if not session.conf.get("spark.checkpoint.dir", None):  # it can only be given when a session is built
        session.stop()
        session = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcasts(spark):
    """Joins as they are planned when neither side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)
