"""Report, summary, SQL rules, reconciling, trace."""

from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog.queries import OPTIONS, RULES, SQL_RULE
from plumbrule import RuleOptions, SqlRule, all_violations, report_sorted, rule_summary, trace_record, violation_report
from plumbrule.constants import REPORT_COLUMNS, REPORT_ORDER
from plumbrule.operators import reconcile as A
from plumbrule.operators.ordering import ordered
from plumbrule.operators.execution import execute_rules, rule_execution_log
from plumbrule.operators.report import full_rule_summary, violation_total
from plumbrule.operators.sql_rules import dedupe_columns, run_sql_rule, sql_rule_check, sql_rule_violations


@pytest.fixture(scope="module")
def report(projects):
    return violation_report(all_violations(projects, RULES, OPTIONS), RULES, "r", "t").cache()


def test_report_columns_and_order(report):
    assert tuple(report.columns) == REPORT_COLUMNS
    assert set(dict(report.dtypes).values()) == {"string"}
    rows = [tuple(row[name] for name in REPORT_ORDER) for row in report_sorted(report).collect()]
    assert rows == sorted(rows) and len(rows) == report.count()


def test_order_splits_runs_of_copies(spark):
    copies = spark.range(0, 40_000, 1, 4).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) k", "1 as one")
    in_order = ordered(copies, "k")
    found = [row["k"] for row in in_order.collect()]
    assert found == sorted(row["k"] for row in copies.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = in_order.groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(row["count"] for row in sizes) < 0.6 * len(found)
    plan = ordered(copies, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_summaries(report):
    summary = {row["rule_id"]: row["violation_count"] for row in rule_summary(report).collect()}
    assert violation_total(rule_summary(report)).first()[0] == report.count() == sum(summary.values())
    only_first = report.where("rule_id = 'F1'")
    zero_filled = {row["rule_id"]: row["violation_count"] for row in full_rule_summary(only_first, RULES).collect()}
    assert zero_filled == {rule.rule_id: summary["F1"] if rule.rule_id == "F1" else 0 for rule in RULES}
    assert violation_total(rule_summary(report.limit(0))).first()[0] == 0


def test_sql_rules(spark, projects):
    projects.createOrReplaceTempView("t_projects")
    assert sql_rule_check(spark, SQL_RULE, OPTIONS, "t_projects") is None
    assert spark.table("t_projects").count() == projects.count()
    columns_swapped = SqlRule("S", "s", "SELECT project_current_phase, project_number FROM t_projects")
    assert "first" in sql_rule_check(spark, columns_swapped, OPTIONS)
    assert "AnalysisException" in sql_rule_check(spark, SqlRule("S", "s", "SELECT nothing FROM t_projects"), OPTIONS)
    assert "ParseException" in sql_rule_check(spark, SqlRule("S", "s", "DROP VIEW t_projects"), OPTIONS)
    failing = SqlRule("S", "s", "SELECT project_number, project_current_phase FROM IDENTIFIER(:subject) WHERE cast(region AS int) > 1")
    assert sql_rule_check(spark, failing, OPTIONS, "t_projects") is not None
    returned = run_sql_rule(spark, SqlRule("S", "s", "SELECT project_number, project_current_phase FROM t_projects -- all\n;"), OPTIONS)
    found = sql_rule_violations(returned, SqlRule("S", "s", "", "f", "why"), OPTIONS)
    assert found.select("failed_field", "failed_value", "explanation").distinct().collect() == [("f", "NULL", "why")]


def test_run_date_is_pinned_in_sql(spark):
    dated = SqlRule("S", "s", "SELECT :run_date AS d")
    assert run_sql_rule(spark, dated, RuleOptions(run_date="2001-02-03")).first()["d"] == date(2001, 2, 3)


def test_dedupe(spark):
    frame = spark.sql("SELECT 1 AS a, 2 AS B, 3 AS b, 4 AS a")
    assert dedupe_columns(frame).collect() == [(1, 2)] and dedupe_columns(frame).columns == ["a", "B"]


def test_execution_log_isolates_failures(spark, projects):
    projects.createOrReplaceTempView("t_projects")
    broken = SqlRule("B", "b", "SELECT cast(project_number AS int) AS n FROM t_projects")
    absent = {**fx.RULE_DEFINITIONS[0], "id": "M", "parameters": {"columns": ["nowhere"]}}
    from plumbrule import make_rules

    log = rule_execution_log(projects, [*make_rules([absent]), *RULES], OPTIONS, [broken, SQL_RULE], "t_projects")
    status = {row["rule_id"]: row["status"] for row in log.collect()}
    assert status["M"] == status["B"] == "ERROR"
    assert all(status[rule.rule_id] == "OK" for rule in (*RULES, SQL_RULE))


def test_a_rule_that_fails_on_the_data_stops_no_other(spark, projects, tmp_path):
    """A declared rule whose column cannot be read is found out by running each rule by itself."""
    faulty = projects.withColumn("bad", F.expr("if(row_key % 10 = 1, raise_error('unreadable'), 'x')"))
    from plumbrule import make_rules

    rules = [*RULES, *make_rules([{**fx.RULE_DEFINITIONS[0], "id": "M", "parameters": {"columns": ["bad"]}}])]
    done = execute_rules(faulty, rules, str(tmp_path / "report"), str(tmp_path / "rows"), OPTIONS, run_id="r", timestamp="t")
    log = {row["rule_id"]: row for row in done.log.collect()}
    assert log["M"]["status"] == "ERROR" and "unreadable" in log["M"]["error"] and log["M"]["row_count"] is None
    whole = violation_report(all_violations(projects, RULES, OPTIONS), RULES, "r", "t")
    assert sorted(map(tuple, done.report.collect())) == sorted(map(tuple, whole.collect()))
    assert all(log[rule.rule_id]["status"] == "OK" for rule in RULES)
    assert sum(row["row_count"] or 0 for row in log.values()) == whole.count()


def test_a_run_without_violations_has_a_report(projects, tmp_path):
    none = execute_rules(projects.limit(0), RULES, str(tmp_path / "a"), str(tmp_path / "b"), OPTIONS)
    assert none.report.count() == 0 and {row["row_count"] for row in none.log.collect()} == {0}
    assert tuple(none.report.columns) == REPORT_COLUMNS
    without_texts = execute_rules(projects, RULES[:1], str(tmp_path / "c"), str(tmp_path / "d"), RuleOptions(run_date=fx.RUN_DATE, explain=False))
    assert without_texts.report.where("explanation IS NOT NULL").count() == 0 < without_texts.report.count()


def test_report_agrees_with_itself(report):
    balance = A.record_balance(report, report)
    comparison = A.compare_counts(balance, RULES).collect()
    assert all(row["count_match"] and row["record_delta"] == 0 for row in comparison)
    assert A.false_negatives(balance).count() == A.false_positives(balance).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.integers(0, 60), max_size=10))
def test_dropped_keys_are_the_false_negatives(report, dropped):
    keys = [tuple(row) for row in report.select(*A.KEY).distinct().orderBy(*A.KEY).limit(61).collect()]
    chosen = sorted(keys[i] for i in dropped)
    key = F.concat_ws("|", *A.KEY)
    kept = report.where(~key.isin(*("|".join(k) for k in chosen))) if chosen else report
    balance = A.record_balance(report, kept)
    missed = sorted(tuple(row) for row in A.false_negatives(balance).collect())
    assert missed == chosen and A.false_positives(balance).count() == 0


def test_null_keys_match_nothing(spark):
    schema = "rule_id string, record_id string"
    one = spark.createDataFrame([("F1", None), ("F1", "a"), ("F1", "a")], schema)
    balance = A.record_balance(one, one)
    assert A.false_negatives(balance).collect() == [("F1", None)]
    row = A.reconcile(balance).first()
    assert (row["gt_fail_report_count"], row["gt_distinct_records"]) == (3, 1)


def test_summary_check(spark, report):
    saved = rule_summary(report).where("rule_id <> 'F8'")
    saved = saved.withColumn("violation_count", F.col("violation_count") + (F.col("rule_id") == "F2").cast("int"))
    balance = A.record_balance(report, report, saved)
    checked = {r["rule_id"]: r["dq_summary_matches_ground_truth"] for r in A.summary_check(balance, RULES).collect()}
    assert checked["F1"] is True and checked["F2"] is False and checked["F8"] is None


def test_trace(projects, report):
    rule = next(r for r in RULES if r.rule_id == "F6")
    record = report.where("rule_id = 'F6'").orderBy("record_id").first()["record_id"].strip()
    stages = {row["stage"] for row in trace_record(projects, rule, record, report, returned=projects).collect()}
    assert stages == {"source", "source_missing", "result", "result_missing", "report"}
    nameless = trace_record(projects, rule, record, returned=projects.drop("project_current_phase"))
    assert [row["missing"] for row in nameless.where("stage LIKE 'result%'").collect()] == [True]
    lacking = trace_record(projects.drop(*fx.GATES), rule, record).where("stage = 'source' AND position > 0")
    assert {row["missing"] for row in lacking.collect()} == {True}
