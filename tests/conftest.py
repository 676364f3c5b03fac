import pytest

from marketframe import builder


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests")
        .master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect
