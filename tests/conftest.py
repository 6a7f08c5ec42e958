import tempfile

import pytest

from gridtables.session import session


@pytest.fixture(scope="session")
def spark():
    s = session(
        "gridtables-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="/tmp/run-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="/tmp/run-"),
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1 -XX:ReservedCodeCacheSize=512m",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def write(tmp_path):
    """Writes files by name into a folder of the test and gives the folder."""

    def put(files: dict[str, str]) -> str:
        for name, text in files.items():
            (tmp_path / name).write_text(text)
        return str(tmp_path)

    return put
