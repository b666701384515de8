import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from geoloom import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.build(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sample_nodes(spark):
    rows = [
        (1, 48.5, 12.25, {"amenity": "hospital", "name": "Hill Clinic"}, 3, None),
        (2, -3.5, 7.75, {"shop": "bakery", "name": "Corner Bread"}, 1, None),
    ]
    return spark.createDataFrame(rows, _schema("NODE"))


@pytest.fixture(scope="session")
def sample_ways(spark):
    rows = [
        (31, [1, 2, 3, 4], {"highway": "tertiary", "name": "Mill Lane"}, None, 2, None),
        (32, [5, 6, 7, 8, 5], {"building": "house"}, None, 1, None),
    ]
    return spark.createDataFrame(rows, _schema("WAY"))


@pytest.fixture(scope="session")
def sample_relations(spark):
    members = [("way", 32, "outer"), ("way", 31, "")]
    rows = [(9, members, {"type": "multipolygon", "natural": "water"}, 4, None)]
    return spark.createDataFrame(rows, _schema("RELATION"))


def _schema(name):
    from geoloom import schemas

    return getattr(schemas, name)
