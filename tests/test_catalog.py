"""Every registered query against its SQL counterpart."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract  # noqa: E402
import check_oracle  # noqa: E402
from tamiz.plans.catalog import ORACLES, QUERIES  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return check_oracle.connect(DATA)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "region" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    # Also fails if the plan has a cross join.
    assert check_oracle.compare(spark, duck, name, DATA) == ""


@pytest.mark.parametrize(
    "name, column, pruned",
    [("fact_enrich", "l_extendedprice", "l_tax"), ("dedup_latest", "l_shipdate", "l_discount")],
)
def test_scans_read_only_what_is_needed(spark, name, column, pruned):
    plan = contract.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert column in plan and pruned not in plan
