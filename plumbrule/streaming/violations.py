"""Row-level rules on a stream: the batch expressions, unchanged and stateless."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plumbrule.constants import UNIQUE
from plumbrule.operators.row_rules import row_violations
from plumbrule.plans.options import RuleOptions
from plumbrule.plans.rules import Rule


def stream_violations(stream: DataFrame, rules: Sequence[Rule], options: RuleOptions) -> DataFrame:
    """Violations of row-level rules in a streaming table.

    Uniqueness needs all rows and is for batch runs. The run date has to be pinned:
    a restarted query must judge the same rows alike.
    """
    for rule in rules:
        if rule.check_type == UNIQUE:
            raise ValueError(f"rule {rule.rule_id}: uniqueness cannot be checked on a stream")
    if options.run_date is None:
        raise ValueError("a stream needs a pinned run date")
    return row_violations(stream, rules, options)


def write_violation_stream(violations: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the violations of everything that has arrived to Parquet, exactly once, then stop.

    `checkpoint` belongs to this stream and goes on a shared folder.
    """
    writer = violations.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
