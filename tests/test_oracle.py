"""Every registered query against its DuckDB oracle on sf0.01 (the driver's gate)."""
import pytest

import __spark_entry__ as E
from compare import compare, duck
from paths import SF01
from ridegrid.plans.registry import ORACLE, QUERIES

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", [n for n in NAMES if n in ORACLE])
def test_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF01), con, ORACLE[name])
    assert ok, msg


def test_every_query_has_oracle_or_is_model_output():
    assert set(NAMES) - set(ORACLE) == {"demand_forecast", "forecast_accuracy"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["pickup_hour", "pickup_location_id", "rides"]
    assert df.count() == 8616  # FIXTURES.md section 3, sf0.001
