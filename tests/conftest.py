from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shapes import square  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("parcella-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def outlines(spark):
    """Two adjacent squares and a commune of two islands."""
    return spark.createDataFrame(
        [
            ("01001", "Alpha", [square(0.0, 0.0, 1.0, 1.0)], 10.0),
            ("01002", "Beta", [square(1.0, 0.0, 2.0, 1.0)], 12.0),
            ("2A004", "Iles", [square(3.0, 0.0, 4.0, 1.0), square(5.0, 0.0, 6.0, 1.0)], 8.0),
        ],
        "code_commune string, nom_commune string, "
        "geom array<array<array<array<double>>>>, surface_km2 double",
    )


@pytest.fixture(scope="session")
def zones(spark):
    return spark.createDataFrame(
        [
            ("010010000", "01001", "Alpha", "Alpha", "Z", 1, [square(0.0, 0.0, 1.0, 1.0)]),
            ("010020101", "01002", "Beta", "Beta Ouest", "H", 2, [square(1.0, 0.0, 1.5, 1.0)]),
            ("010020102", "01002", "Beta", "Beta Est", "H", 2, [square(1.5, 0.0, 2.0, 1.0)]),
            ("751080301", "75108", "Paris 8e", "Europe", "H", 1, [square(9.0, 9.0, 9.5, 9.5)]),
            ("974110102", "97411", "Saint-Denis", "Centre", "H", 2, [square(3.0, 3.0, 4.0, 4.0)]),
        ],
        "code_iris string, code_commune string, nom_commune string, nom_iris string, "
        "type_iris string, nb_iris_commune int, geom array<array<array<array<double>>>>",
    )
