"""Views derived from the given tables, in SQL that Spark and DuckDB both run.

The subject table `projects` is built from every row of `orders`; the arithmetic on
`o_orderkey` only decides which defect a row carries. `actual_report` is the true
list of violations of all rules with known errors put in, so that reconciling has
something to find.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = date(2001, 6, 1)
RUN_ID = "run-0001"
RUN_TIMESTAMP = "2001-06-01T00:00:00"
RUN_DAYS = ("1998-03-01", "2001-06-01")

GATE_NAMES = ("a2", "b", "c", "d", "e")
GATES = tuple(f"project_gate_{g}_milestone_date" for g in GATE_NAMES)

_SHIFTED = "CAST(CAST(o_orderdate AS DATE) + CAST({i}*120 + (o_orderkey*({i}+3))%90 - 40 AS INT) AS STRING)"

_GATE = """CASE WHEN (o_orderkey*7+{i}*5)%41=0 THEN NULL
     WHEN (o_orderkey*7+{i}*5)%41=1 THEN '01/01/1990'
     WHEN (o_orderkey*7+{i}*5)%41=2 THEN '1990-01-01'
     WHEN (o_orderkey*7+{i}*5)%41=3 THEN '   '
     WHEN (o_orderkey*7+{i}*5)%41=4 THEN 'TBC'
     WHEN o_orderkey%53=0 AND {i}>0 THEN {previous}
     WHEN o_orderkey%8=0 THEN substr({d},9,2)||'/'||substr({d},6,2)||'/'||substr({d},1,4)
     WHEN o_orderkey%8=1 THEN substr({d},9,2)||'-'||substr({d},6,2)||'-'||substr({d},1,4)
     WHEN o_orderkey%8=2 THEN substr({d},1,4)||'/'||substr({d},6,2)||'/'||substr({d},9,2)
     WHEN o_orderkey%8=3 THEN {d}||' 00:00:00'
     ELSE {d} END AS {name}"""


def _gate(i: int, name: str, day: str = _SHIFTED) -> str:
    return _GATE.format(i=i, d=day.format(i=i), previous=day.format(i=max(i - 1, 0)), name=name)


def _projects_sql(day: str, source: str) -> str:
    return f"""SELECT o_orderkey AS row_key,
  CASE WHEN o_orderkey%211=0 THEN NULL WHEN o_orderkey%223=0 THEN '  '
       WHEN o_orderkey%97=0 THEN 'P'||CAST(o_orderkey+1 AS STRING)
       ELSE 'P'||CAST(o_orderkey AS STRING) END AS project_number,
  CASE WHEN o_orderkey%307=0 THEN NULL WHEN o_orderkey%5=0 THEN ' '||substr(o_orderpriority,1,1)||' '
       ELSE substr(o_orderpriority,1,1) END AS project_current_phase,
  CASE WHEN o_orderkey%31=0 THEN NULL WHEN o_orderkey%37=0 THEN 'n/a' WHEN o_orderkey%41=0 THEN '0'
       WHEN o_orderkey%43=0 THEN '-'||CAST(o_custkey AS STRING)
       ELSE CAST(o_custkey+1 AS STRING) END AS sanction_amount,
  CASE WHEN o_orderkey%29=0 THEN NULL WHEN o_orderkey%59=0 THEN ' '||o_orderstatus
       WHEN o_orderkey%61=0 THEN 'X' ELSE o_orderstatus END AS region,
  {", ".join(_gate(i, name, day) for i, name in enumerate(GATES))}
FROM {source}"""


PROJECTS_SQL = _projects_sql(_SHIFTED, "orders")

# The same view with each shifted date computed once per row, for Spark.
_DAYS = ", ".join(f"{_SHIFTED.format(i=i)} AS d{i}" for i in range(len(GATES)))
PROJECTS_ONCE_SQL = _projects_sql("d{i}", f"(SELECT *, {_DAYS} FROM {{orders}}) AS dated")

# The report under test: the truth of all rules without a tenth of each rule's records, by the last character of their id, and
# with records that violate nothing.
ACTUAL_REPORT_SQL = """SELECT rule_id, record_id, phase, failed_field, failed_value FROM truth
WHERE (ascii(substr(record_id, length(record_id), 1)) + ascii(substr(rule_id, 2, 1))) % 10 <> 3
UNION ALL
SELECT 'F'||CAST(row_key%400-6 AS STRING), 'X'||CAST(row_key AS STRING), '1', 'region', 'invented' FROM projects
WHERE row_key%400 BETWEEN 7 AND 14"""

# A saved summary of that report: one rule is counted wrong, another one not listed.
SAVED_SUMMARY_SQL = """SELECT rule_id, count(*) + CASE WHEN rule_id = 'F2' THEN 1 ELSE 0 END AS violation_count FROM actual
WHERE rule_id <> 'F8' GROUP BY rule_id"""

SCORES_SQL = """SELECT doc_id, quality AS label, CAST((doc_id*37)%101 AS DOUBLE)/100.0e0 AS probability FROM labels"""

HEADERS_SQL = """SELECT doc_id, source, CASE doc_id%6 WHEN 0 THEN 'FFD8FFE000104A464946' WHEN 1 THEN '89504E470D0A1A0A0000'
  WHEN 2 THEN '424D46000000' WHEN 3 THEN '474946383961' WHEN 4 THEN '49492A000800' ELSE '00000000' END AS header_hex
FROM documents"""

# Rules used with `projects`, in the layout of a rules file.
RULE_DEFINITIONS = [
    {
        "id": "F1",
        "name": "Mandatory fields",
        "check_type": "not_null",
        "description": "Must be filled in",
        "severity": "high",
        "dimension": "completeness",
        "parameters": {"columns": ["project_number", "region", "sanction_amount"]},
    },
    {
        "id": "F2",
        "name": "Positive amount",
        "check_type": "positive_value",
        "description": "A number above zero",
        "severity": "high",
        "dimension": "validity",
        "parameters": {"column": "sanction_amount", "skip_null": True},
    },
    {
        "id": "F3",
        "name": "Unique number",
        "check_type": "unique",
        "description": "Used once",
        "severity": "critical",
        "dimension": "uniqueness",
        "parameters": {"column": "project_number", "skip_null": True},
    },
    {
        "id": "F4",
        "name": "Known region",
        "check_type": "value_in_list",
        "description": "One of F, O, P",
        "parameters": {"column": "region", "allowed_values": ["F", "O", "P"], "flag_null": True},
    },
    {
        "id": "F5",
        "name": "Active gate overdue",
        "check_type": "active_gate_overdue",
        "description": "Not long past",
        "dimension": "timeliness",
        "parameters": {
            "phase_to_gate_map": {str(i + 1): g for i, g in enumerate(GATES)},
            "overdue_days": 180,
        },
    },
    {
        "id": "F6",
        "name": "Earlier gates recorded",
        "check_type": "progressive_gate_completeness",
        "description": "All earlier gates",
        "severity": "high",
        "dimension": "completeness",
        "parameters": {"phase_to_required_gates": {str(i + 1): list(GATES[:i]) for i in range(1, 5)}},
    },
    {
        "id": "F7",
        "name": "Completed gates not ahead",
        "check_type": "completed_gate_not_future",
        "description": "Up to today",
        "dimension": "validity",
        "parameters": {"phase_to_completed_gates": {str(i + 1): list(GATES[:i]) for i in range(1, 5)}},
    },
    {
        "id": "F8",
        "name": "Gates in order",
        "check_type": "date_sequence",
        "description": "Ascending",
        "severity": "low",
        "dimension": "consistency",
        "parameters": {"sequence": list(GATES)},
    },
]


def view(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derived(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    """A derived view over one given table, without registering a name in the session."""
    return spark.sql(sql.replace(f"FROM {table}", "FROM {source}"), source=view(spark, sf_dir, table))


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projects_from(view(spark, sf_dir, "orders"))


def projects_from(orders: DataFrame) -> DataFrame:
    """The subject table of an `orders` table, batch or stream."""
    return orders.sparkSession.sql(PROJECTS_ONCE_SQL, orders=orders)


def actual_report(truth: DataFrame, subject: DataFrame) -> DataFrame:
    sql = ACTUAL_REPORT_SQL.replace("FROM truth", "FROM {truth}").replace("FROM projects", "FROM {projects}")
    return truth.sparkSession.sql(sql, truth=truth, projects=subject)


def saved_summary(actual: DataFrame) -> DataFrame:
    return actual.sparkSession.sql(SAVED_SUMMARY_SQL.replace("FROM actual", "FROM {actual}"), actual=actual)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "labels", SCORES_SQL)


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "documents", HEADERS_SQL)
