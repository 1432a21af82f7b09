"""Rule files, edge rows of every check, and the single pass against one pass per rule."""

from __future__ import annotations

import json
from functools import reduce

import pytest
from pyspark.sql import functions as F

from catalog import fixtures as fx
from plumbrule import RuleOptions, all_violations, make_rules, parse_rules, row_violations, unique_violations
from plumbrule.plans.rules import Rule

OPTIONS = RuleOptions(run_date="2001-06-01")
RULES = make_rules(fx.RULE_DEFINITIONS)
SCHEMA = "project_number string, project_current_phase string, v string"


def rule(check_type, **parameters):
    return make_rules([{"id": "X", "name": "n", "check_type": check_type, "description": " d ", "parameters": parameters}])


def flagged(spark, values, rules, options=OPTIONS):
    rows = spark.createDataFrame([(str(i), "1", v) for i, v in enumerate(values)], SCHEMA)
    return sorted(int(row["record_id"]) for row in all_violations(rows, rules, options).collect())


def as_rows(df):
    return sorted(tuple(str(value) for value in row) for row in df.select(sorted(df.columns)).collect())


def test_rule_file_precedence():
    entry = {
        "id": 7, "name": "n", "check_type": "not_null", "fields": "a, b ,", "skip_phases": ["9"],
        "parameters": {"columns": ["c"], "skip_phases": ["8"], "skip_null": "TRUE"},
    }
    parsed = parse_rules(json.dumps({"rules": [entry]}))[0]
    assert (parsed.rule_id, parsed.columns, parsed.skip_phases, parsed.skip_null) == ("7", ("a", "b"), ("8",), True)
    assert (parsed.severity, parsed.dimension, parsed.overdue_days) == ("medium", "unknown", 180)


@pytest.mark.parametrize(
    "entry",
    [
        {"id": "A", "name": "n", "check_type": "not_null"},
        {"id": "A", "name": "n", "check_type": "date_sequence"},
        {"id": "A", "check_type": "not_null", "columns": "v"},
        {"id": "A", "name": "n", "check_type": "unique", "columns": "v", "parameters": {"skip_null": "maybe"}},
    ],
)
def test_bad_rules_are_rejected(entry):
    with pytest.raises(ValueError, match="A"):
        make_rules([entry])


def test_duplicate_ids_absent_columns_and_unknown_checks(spark, projects):
    with pytest.raises(ValueError, match="more than once"):
        make_rules([fx.RULE_DEFINITIONS[0]] * 2)
    with pytest.raises(ValueError, match="X.*nowhere"):
        all_violations(projects, rule("not_null", columns=["nowhere"]), OPTIONS)
    unknown = [Rule("U", "n", "no_such_check")]
    with pytest.raises(ValueError, match="no_such_check"):
        all_violations(projects, unknown, OPTIONS)
    with pytest.warns(UserWarning, match="no_such_check"):
        assert all_violations(projects, unknown, RuleOptions(lenient=True)).count() == 0


def test_positive_value(spark):
    values = ["NaN", "Infinity", "1e3", " 7 ", "0", "-1", "1,000", "n/a", "", None, "01/01/1990"]
    assert flagged(spark, values, rule("positive_value", column="v", skip_null=True)) == [4, 5, 6, 7]
    assert flagged(spark, values, rule("positive_value", column="v")) == [4, 5, 6, 7, 8, 9, 10]


def test_unique(spark):
    values = ["a", " a ", "b", None, None, "", "  ", "01/01/1990", "01/01/1990"]
    assert flagged(spark, values, rule("unique", column="v", skip_null=True)) == [0, 1]
    assert flagged(spark, values, rule("unique", column="v")) == [0, 1, 5, 6, 7, 8]


def test_unique_treats_hot_keys_alike(spark, projects):
    unique = [r for r in RULES if r.check_type == "unique"]
    hot = RuleOptions(run_date="2001-06-01", hot_rows=2)
    assert as_rows(unique_violations(projects, unique, hot)) == as_rows(unique_violations(projects, unique, OPTIONS))
    skewed = spark.range(3000).selectExpr(
        "cast(id as string) project_number", "'1' project_current_phase", "if(id % 3 = 0, 'hot', cast(id div 2 as string)) v"
    )
    expected = skewed.withColumn("n", F.expr("count(*) over (partition by v)")).where("n > 1").count()
    found = unique_violations(skewed, rule("unique", column="v"), RuleOptions(hot_rows=500))
    assert found.count() == expected and found.where("failed_value = 'hot'").count() == 1000


def test_value_in_list(spark):
    values = ["F", " F ", "f", "X", None, "", "01/01/1990"]
    assert flagged(spark, values, rule("value_in_list", column="v", allowed_values=["F"])) == [2, 3]
    assert flagged(spark, values, rule("value_in_list", column="v", values="F", flag_null=True)) == [2, 3, 4, 5, 6]


def test_overdue_is_strict_and_needs_the_phase(spark):
    values = ["2000-12-03", "2000-12-02", "01/01/1990", "TBC", None]
    overdue = rule("active_gate_overdue", phase_to_gate_map={"1": "v"}, overdue_days=180)
    assert flagged(spark, values, overdue) == [1]
    assert flagged(spark, values, rule("active_gate_overdue", phase_to_gate_map={"2": "v"})) == []
    assert flagged(spark, values, overdue, RuleOptions(run_date="2001-06-01", report_unparsed=True)) == [1, 3]


def test_sequence_flags_equal_neighbours_only_when_both_are_present(spark):
    rows = spark.createDataFrame(
        [("0", None, "2020-01-01", "01/01/2020"), ("1", "1", "2020-01-02", "2020-01-01"), ("2", "1", None, "2020-01-01"),
         ("3", "1", "2019-12-31", "2020/01/01")],
        "project_number string, project_current_phase string, a string, b string",
    )
    found = row_violations(rows, rule("date_sequence", sequence=["a", "b"]), OPTIONS).orderBy("record_id").collect()
    assert [(row["record_id"], row["phase"]) for row in found] == [("0", "UNKNOWN"), ("1", "1")]
    assert found[0]["explanation"] == "B date (2020-01-01) should be later than A date (2020-01-01)"


def test_null_ids_and_texts_with_quotes(spark):
    rows = spark.createDataFrame([(None, None, "it's")], SCHEMA)
    quoted = [{"id": "Q'1", "name": "n", "check_type": "value_in_list", "description": "don't \\ x", "columns": "v",
               "allowed_values": ["o'k"]}]
    found = row_violations(rows, make_rules(quoted), OPTIONS).first()
    assert (found["rule_id"], found["record_id"], found["phase"]) == ("Q'1", "UNKNOWN", "UNKNOWN")
    assert found["explanation"] == "Column: v | Found: 'it's' | Expected: don't \\ x"


def test_single_pass_is_the_union_of_all_rules(projects):
    together = all_violations(projects, RULES, OPTIONS)
    apart = reduce(lambda a, b: a.unionByName(b), [all_violations(projects, [r], OPTIONS) for r in RULES])
    assert as_rows(together) == as_rows(apart)
    assert as_rows(all_violations(projects.repartition(7), RULES[::-1], OPTIONS)) == as_rows(together)


def test_skipped_phases(projects):
    skipping = [{**fx.RULE_DEFINITIONS[0], "skip_phases": ["1", "2"]}]
    found = all_violations(projects, make_rules(skipping), OPTIONS)
    assert found.where("trim(phase) IN ('1', '2') OR phase = 'UNKNOWN'").count() == 0
    kept = all_violations(projects, make_rules(skipping), RuleOptions(run_date="2001-06-01", keep_null_phase=True))
    assert kept.where("phase = 'UNKNOWN'").count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_of_row_rules(projects):
    plan = plan_of(row_violations(projects, RULES, OPTIONS))
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan and "Python" not in plan


def test_empty_table(projects):
    assert all_violations(projects.limit(0), RULES, OPTIONS).count() == 0


def test_unique_scans_twice_and_salts_hot_keys(spark, tmp_path, monkeypatch):
    """With many repeated keys rows and keys meet on (key, salt); the result is the same."""
    from plumbrule.operators import unique_rules

    rows = spark.range(0, 6000, 1, 4).selectExpr(
        "cast(id as string) AS project_number", "'1' AS project_current_phase", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id < 3000 THEN concat('k', id div 4) ELSE concat('u', id) END AS v"
    )
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    checked = rule("unique", column="v")
    few = unique_violations(table, checked, RuleOptions())
    monkeypatch.setattr(unique_rules, "BROADCAST_BYTES", 0)
    salted = unique_violations(table, checked, RuleOptions(hot_rows=100))
    assert as_rows(few) == as_rows(salted) and few.count() > 2500
    for frame in (few, salted):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"{tmp_path.name}/t]") <= 1  # the other scan has counted the keys
