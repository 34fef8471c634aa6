import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("checkpoint")
    session = (
        SparkSession.builder.master("local[4]").appName("surveyspark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(folder))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a column expression over literal input: rows(schema, data, {name: column})."""
    def run(schema, data, columns):
        df = spark.createDataFrame(data, schema)
        return [tuple(r) for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]
    return run
