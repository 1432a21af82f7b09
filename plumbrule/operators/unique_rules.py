"""The uniqueness rule: all copies of a repeated key, in two scans.

The first scan counts keys with map-side partial aggregation, so a key held by a large share of the rows costs one partial count
per task. The repeated keys are written to the shared folder and counted, rows and bytes. The second scan probes them:

* if they are few, they are broadcast and no row is shuffled, however often its key occurs;
* else rows and keys meet in one shuffled join on (key, salt). A key has as many salts as it has times `hot_rows` copies, so most
  have one; those with more, at most rows / hot_rows, are counted too, and are sent to the probing tasks, which deal
  the rows of such a key over its salts.

All uniqueness rules of a run share these steps. Explanations are built for matched rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrule.constants import UNIQUE
from plumbrule.functions.text import literal
from plumbrule.operators.row_rules import (
    PreparedColumns,
    check_rule,
    in_quotes,
    kept_by_phase,
    no_violations,
    shown_columns,
)
from plumbrule.plans.options import RuleOptions
from plumbrule.plans.rules import Rule
from plumbrule.workspace import BROADCAST_ROWS, scratch_path

RULE, KEY, SALT, COPIES = "__rule", "__key", "__salt", "__copies"
BROADCAST_BYTES = 64 << 20


def rule_keys(df: DataFrame, rules: Sequence[Rule], options: RuleOptions) -> DataFrame:
    """One row per (row, uniqueness rule, by its place) with the trimmed key; rows without key are left out."""
    ready = PreparedColumns(options)
    entries = []
    for number, rule in enumerate(rules):
        key = ready.text(rule.columns[0])
        counted = f"NOT {ready.missing(rule.columns[0])}" if rule.skip_null else f"{key} IS NOT NULL"
        struct = f"named_struct({literal(RULE)}, {number}, {literal(KEY)}, {key})"
        entries.append(f"CASE WHEN {counted} AND {kept_by_phase(rule, ready)} THEN {struct} END")
    exploded = ready.apply(df).selectExpr("record_id", "phase", f"explode(array({', '.join(entries)})) AS v")
    return exploded.where("v IS NOT NULL").select("record_id", "phase", "v.*")


def repeated_keys(keyed: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    counts = keyed.groupBy(RULE, KEY).agg(F.count("*").alias(COPIES))
    return counts.where(F.col(COPIES) > 1)


def with_repeated_key(keyed: DataFrame, options: RuleOptions) -> DataFrame:
    """The rows whose key occurs more than once."""
    spark = keyed.sparkSession
    repeated = repeated_keys(keyed)
    path = scratch_path(spark, "repeated_keys")
    repeated.write.parquet(path)
    repeated = spark.read.schema(repeated.schema).parquet(path)
    is_hot = F.col(COPIES) > options.hot_rows
    measured = repeated.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(KEY)), F.lit(0)).alias("bytes"), F.count_if(is_hot).alias("hot"))
    size = measured.first()
    if size["n"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES:
        return keyed.join(F.broadcast(repeated.select(RULE, KEY)), [RULE, KEY], "left_semi")
    salts = F.ceil(F.col(COPIES) / options.hot_rows).cast("long")
    spread = repeated.withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    row_salt: Column = F.lit(0).cast("long")
    if size["hot"]:
        hot = repeated.where(is_hot).select(RULE, KEY, salts.alias("__salts"))
        keyed = keyed.join(F.broadcast(hot) if size["hot"] <= BROADCAST_ROWS else hot, [RULE, KEY], "left")
        row_salt = F.when(F.col("__salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("record_id", "phase"), "__salts"))
    salted = keyed.withColumn(SALT, row_salt)
    return salted.join(spread.select(RULE, KEY, SALT), [RULE, KEY, SALT], "left_semi").select("record_id", "phase", RULE, KEY)


def unique_violations(df: DataFrame, rules: Sequence[Rule], options: RuleOptions = RuleOptions()) -> DataFrame:
    """Every row whose key is shared with another row, for all uniqueness rules. The keys are counted when this is called."""
    checked = [r for r in rules if r.check_type == UNIQUE and check_rule(r, df.columns, options)]
    if not checked:
        return no_violations(df, options)

    def of_rule(texts: Sequence[str]) -> str:
        return f"get(array({', '.join(literal(text) for text in texts)}), {RULE})"

    befores = [f"Column: {rule.columns[0]} | Found: " for rule in checked]
    afters = [f" | Expected: {rule.description}" for rule in checked]
    shown = {
        "rule_id": of_rule([rule.rule_id for rule in checked]),
        "record_id": "record_id",
        "phase": "phase",
        "failed_field": of_rule([rule.columns[0] for rule in checked]),
        "failed_value": KEY,
        "explanation": f"concat({of_rule(befores)}, {in_quotes(KEY)}, {of_rule(afters)})",
    }
    found = with_repeated_key(rule_keys(df, checked, options), options)
    return found.selectExpr(*(f"{shown[name]} AS {name}" for name in shown_columns(options)))
