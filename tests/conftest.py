import pytest
from pyspark.sql import SparkSession

from peoplemart.plans.reload import Mart, Settings
from peoplemart.sources.storage import new_folder
from tests import people

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def settings():
    return Settings(people.AS_OF, people.CALENDAR_START, people.CALENDAR_END)


@pytest.fixture(scope="session")
def source(spark):
    return people.source_tables(spark)


@pytest.fixture(scope="session")
def mart(spark, source, settings):
    loaded = Mart(spark, source, new_folder(spark, "test"), settings)
    loaded.load_all()
    return loaded
