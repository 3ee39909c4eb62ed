import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetgauge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    derby = tmp_path_factory.mktemp("derby")
    session = local_session(
        "fleetgauge-tests",
        8,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={derby}",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    def load(name, sf="0.01"):
        return spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")

    return load


def rows(df, *cols):
    """Collected tuples in key order, for small expected tables."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is None, str(type(x)), x) for x in t))
