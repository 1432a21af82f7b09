"""Every query against its SQL, at the smallest scale, and properties of their plans."""

from __future__ import annotations

import re

import pytest

from catalog import fixtures as fx
from catalog.oracles import ORACLES
from catalog.queries import OPTIONS, QUERIES
from check_oracles import compare, connect
from plumbrule import make_rules, row_violations
from plumbrule.operators.profile import date_format_histogram, date_profile


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, small, name):
    assert compare(spark, duck, name, small) is None


def test_oracles_belong_to_queries():
    assert set(ORACLES) == set(QUERIES)


def test_profile_scans_once(projects):
    plan = date_profile(projects)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan


@pytest.mark.parametrize("count", [8, 100])
def test_rules_make_methods_the_jvm_compiles(spark, projects, tmp_path, count):
    """Methods beyond 8,000 bytes are never compiled."""
    definitions = [{**fx.RULE_DEFINITIONS[i % 8], "id": f"R{i}"} for i in range(count)]
    projects.limit(50).write.parquet(str(tmp_path / "projects"))
    table = spark.read.parquet(str(tmp_path / "projects"))
    found = row_violations(table, [rule for rule in make_rules(definitions) if rule.check_type != "unique"], OPTIONS)
    generated = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", generated)]
    assert sizes and max(sizes) < 8000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_histogram_shuffles_shapes_not_values(projects):
    plan = date_format_histogram(projects)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(column_name") == 1 and "hashpartitioning(column_name" in plan and "detected_format" in plan
    assert ", v#" not in plan[plan.index("Exchange hashpartitioning") : plan.index("Exchange hashpartitioning") + 100]


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
