import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pitchlake.session import build_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("pitchlake-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def raw(spark, tmp_path_factory):
    from tests.snapshots import write_snapshots
    from pitchlake.plans.warehouse import read_sources

    root = tmp_path_factory.mktemp("raw")
    write_snapshots(root)
    return read_sources(spark, f"{root}/scraper", f"{root}/api", f"{root}/plain")


@pytest.fixture(scope="session")
def tables(raw, tmp_path_factory):
    from pitchlake.plans.settings import Settings
    from pitchlake.plans.warehouse import run

    settings = Settings(site_root="https://example.org", as_of="2025-06-30")
    return run(raw, str(tmp_path_factory.mktemp("tables")), settings=settings)


@pytest.fixture
def column(spark):
    """Evaluate a column function over a list of texts."""
    from pyspark.sql import functions as F

    def evaluate(fn, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
        return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]

    return evaluate
