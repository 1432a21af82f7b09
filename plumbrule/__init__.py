"""Data-quality checks for wide text tables, as Spark plans."""

from plumbrule.operators.profile import date_format_histogram, date_profile, semantic_schema, table_shape
from plumbrule.operators.reconcile import compare_counts, mismatch_summary, reconcile
from plumbrule.operators.report import all_violations, report_sorted, rule_summary, violation_report
from plumbrule.operators.row_rules import row_violations
from plumbrule.operators.sql_rules import SqlRule
from plumbrule.operators.trace import trace_record
from plumbrule.operators.unique_rules import unique_violations
from plumbrule.plans.options import RuleOptions
from plumbrule.plans.rules import Rule, make_rules, parse_rules
from plumbrule.plans.runs import audit_report, run_checks
from plumbrule.sources.tables import load_rules, scan_csv, scan_report, scan_summary

__all__ = [
    "Rule",
    "RuleOptions",
    "SqlRule",
    "all_violations",
    "audit_report",
    "compare_counts",
    "date_format_histogram",
    "date_profile",
    "load_rules",
    "make_rules",
    "mismatch_summary",
    "parse_rules",
    "reconcile",
    "report_sorted",
    "row_violations",
    "rule_summary",
    "run_checks",
    "scan_csv",
    "scan_report",
    "scan_summary",
    "semantic_schema",
    "table_shape",
    "trace_record",
    "unique_violations",
    "violation_report",
]
