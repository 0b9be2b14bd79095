"""Registered queries against their SQL twins.

The suite checks one query per family on the smallest tables; set ``ALL_QUERIES=1``
for all of them, or run ``python tests/compare.py``.
"""

from __future__ import annotations

import os

import pytest
from compare import compare

import __spark_entry__ as contract
from parcella.plans import oracle, registry

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
FAMILIES = (
    "commune_agg",
    "dept_agg",
    "mutations",
    "latest_period_rates",
    "nearest_station",
    "stops_per_cell",
    "assign_points_to_zones",
    "price_histogram",
    "points_sample",
    "review_segments",
    "segment_tokens",
    "verbatims",
    "station_sheets",
    "land_new_files",
    "validate_rules",
    "csv_semicolon_scan",
    "feature_split_sink",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not at hand")


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(oracle.oracle_sql())
    assert set(registry.QUERIES) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", sorted(registry.QUERIES) if os.environ.get("ALL_QUERIES") else FAMILIES
)
def test_query_matches_sql(spark, name):
    ok, message, _ = compare(
        spark, name, contract.queries()[name], contract.oracle_sql()[name], SF_DIR
    )
    assert ok, message
