"""Every registered query against its check SQL, at the smallest scale."""

import checks
import pytest

import __spark_entry__ as entry
from retail_lake.plans.all_queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return checks.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_check(spark, con, name):
    problem, _ = checks.compare(spark, SF, con, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None


def test_every_query_has_its_check():
    assert set(QUERIES) == set(CHECKS) and set(QUERIES) <= set(entry.queries())


def test_entry_is_lazy_and_stable(spark):
    df = entry.entry(spark)
    assert df.columns == ["row_index", "found_folder", "file_name", "row_content"]
    assert df.count() > 0


def test_no_query_plans_a_product(spark):
    for name, fn in QUERIES.items():
        if name.startswith(("stream_", "csv_", "xml_", "stored_", "snapshot_", "lake_")):
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
