import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Build raw events from dicts; fields not given are null."""
    from tidelog import schemas as S

    def build(*rows: dict):
        names = [f.name for f in S.RAW_EVENT.fields]
        base = {"server_id": 1, "event_len": 10, "log_pos": 100, "flags": 0}
        return spark.createDataFrame(
            [tuple({**base, **r}.get(n) for n in names) for r in rows], S.RAW_EVENT)

    return build
