import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def records(spark):
    """A record DataFrame from hex strings."""

    def make(*hexes):
        rows = [("f", i + 1, len(bytes.fromhex(h)), bytes.fromhex(h)) for i, h in enumerate(hexes)]
        return spark.createDataFrame(rows, "file string, rec_no bigint, rec_len int, rec binary")

    return make


@pytest.fixture
def record_file(tmp_path):
    """Write bytes to a new file; gives its path."""

    def write(data, name="data.vb"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
        return str(path)

    return write
