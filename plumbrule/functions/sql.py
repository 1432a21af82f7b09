"""SQL functions a rule query can call."""

from __future__ import annotations

from pyspark.sql import SparkSession

from plumbrule.functions import text

DATE_FUNCTION = "dq_to_date"


def register_sql_functions(spark: SparkSession) -> None:
    """Make `dq_to_date(text)` known to the session: the SQL form of `tolerant_date`.

    It is a SQL function, so the analyzer expands it in place and the query keeps its
    generated code; no Python runs.
    """
    day = text.date_of(text.head_of_date(text.cleaned("x")))
    comment = "Date from the first ten characters of trimmed text, NULL if in no known layout"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {DATE_FUNCTION}(x STRING) RETURNS DATE COMMENT '{comment}' RETURN {day}")
