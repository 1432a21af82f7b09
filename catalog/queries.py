"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog import fixtures as fx
from plumbrule.constants import REPORT_ORDER, UNIQUE
from plumbrule.functions import columns as C
from plumbrule.functions.sql import register_sql_functions
from plumbrule.operators import classify, execution, images, profile, reconcile, report, splitting
from plumbrule.operators.row_rules import row_violations
from plumbrule.operators.sql_rules import SqlRule, dedupe_columns, run_sql_rule, sql_rule_check, sql_rule_violations
from plumbrule.operators.trace import trace_record
from plumbrule.operators.unique_rules import unique_violations
from plumbrule.plans.options import RuleOptions
from plumbrule.plans.rules import Rule, make_rules
from plumbrule.plans.runs import run_checks
from plumbrule.sources import sinks, tables
from plumbrule.streaming.violations import stream_violations, write_violation_stream
from plumbrule.workspace import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

RULES = make_rules(fx.RULE_DEFINITIONS)
OPTIONS = RuleOptions(run_date=fx.RUN_DATE)
BY_ID: dict[str, Rule] = {rule.rule_id: rule for rule in RULES}
TRACED_RECORD = "P7"

FAR_FUTURE_SQL = """SELECT project_number, project_current_phase, sanction_amount, {first}
FROM IDENTIFIER(:subject)
WHERE dq_to_date({first}) > date_add(:run_date, 60)""".format(first=fx.GATES[4])
SQL_RULE = SqlRule(
    "Q1",
    "Last gate far ahead",
    FAR_FUTURE_SQL,
    failed_field=fx.GATES[4],
    explanation="Last gate lies more than 60 days ahead",
    dimension="timeliness",
)
BROKEN_RULE = SqlRule("Q2", "Broken", "SELECT no_such_column FROM IDENTIFIER(:subject)")
SUBJECT = "plumbrule_projects"


def _long(spark: SparkSession, sf: str) -> DataFrame:
    """All checked text columns of the subject table, one value per row."""
    names = ("project_number", "project_current_phase", "sanction_amount", "region", *fx.GATES)
    table = fx.projects(spark, sf)
    return table.unpivot("row_key", list(names), "column_name", "v")


def _gates(spark: SparkSession, sf: str) -> DataFrame:
    return fx.projects(spark, sf).unpivot("row_key", list(fx.GATES), "column_name", "v")


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return _long(spark, sf).select("row_key", "column_name", C.clean_text("v").alias("cleaned"))


def missing_flag(spark: SparkSession, sf: str) -> DataFrame:
    return _long(spark, sf).select("row_key", "column_name", C.missing_flag("v").alias("missing"))


def missing_kind(spark: SparkSession, sf: str) -> DataFrame:
    return _long(spark, sf).select("row_key", "column_name", C.missing_kind("v").alias("kind"))


def tolerant_date(spark: SparkSession, sf: str) -> DataFrame:
    return _gates(spark, sf).select("row_key", "column_name", C.tolerant_date("v").alias("day"))


def populated_date(spark: SparkSession, sf: str) -> DataFrame:
    return _gates(spark, sf).select("row_key", "column_name", C.populated_date("v").alias("populated"))


def safe_double(spark: SparkSession, sf: str) -> DataFrame:
    return fx.projects(spark, sf).select("row_key", C.safe_double("sanction_amount").alias("amount"))


def display_value(spark: SparkSession, sf: str) -> DataFrame:
    return _long(spark, sf).select("row_key", "column_name", C.display_value("v").alias("shown"))


def gate_label(spark: SparkSession, sf: str) -> DataFrame:
    gates = _gates(spark, sf)
    return gates.groupBy(C.gate_label_column("column_name").alias("label")).agg(F.count("v").alias("present"))


def days_overdue(spark: SparkSession, sf: str) -> DataFrame:
    late = C.days_overdue(fx.RUN_DATE, C.tolerant_date("v"))
    return _gates(spark, sf).select("row_key", "column_name", late.alias("days"))


def any_of(spark: SparkSession, sf: str) -> DataFrame:
    absent = C.any_of(C.missing_flag(name) for name in fx.GATES)
    return fx.projects(spark, sf).select("row_key", absent.alias("some_missing"), C.any_of([]).alias("of_none"))


def skip_phases(spark: SparkSession, sf: str) -> DataFrame:
    kept = C.skip_phases(fx.projects(spark, sf), ["1", "3"])
    return kept.select("row_key", "project_current_phase")


def skip_phases_keep_null(spark: SparkSession, sf: str) -> DataFrame:
    kept = C.skip_phases(fx.projects(spark, sf), ["1", "3"], keep_null_phase=True)
    return kept.select("row_key", "project_current_phase")


def run_date(spark: SparkSession, sf: str) -> DataFrame:
    day = C.tolerant_date("v")
    ahead = _gates(spark, sf).where(day > C.run_date_column("2001-06-01"))
    return ahead.groupBy("column_name").agg(F.count("*").alias("ahead"), F.min(day).alias("first_day"))


def date_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.date_profile(fx.projects(spark, sf))


def date_format_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return profile.date_format_histogram(fx.projects(spark, sf))


def semantic_schema(spark: SparkSession, sf: str) -> DataFrame:
    return profile.semantic_schema(fx.projects(spark, sf))


def table_shape(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_shape(fx.projects(spark, sf))


def _rule(rule_id: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rule = BY_ID[rule_id]
        check = unique_violations if rule.check_type == UNIQUE else row_violations
        return check(fx.projects(spark, sf), [rule], OPTIONS)

    return query


def _variant(check: str, **changes) -> Query:
    """A rule of the fixture with other parameters."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        definition = next(d for d in fx.RULE_DEFINITIONS if d["check_type"] == check)
        changed = {**definition, "parameters": {**definition["parameters"], **changes}}
        return report.all_violations(fx.projects(spark, sf), make_rules([changed]), OPTIONS)

    return query


def _subject(spark: SparkSession, sf: str) -> str:
    fx.projects(spark, sf).createOrReplaceTempView(SUBJECT)
    return SUBJECT


def sql_rule(spark: SparkSession, sf: str) -> DataFrame:
    return run_sql_rule(spark, SQL_RULE, OPTIONS, _subject(spark, sf))


def sql_pinned_date(spark: SparkSession, sf: str) -> DataFrame:
    register_sql_functions(spark)
    query = """SELECT column_name, dq_to_date(v) AS day, datediff(:run_date, dq_to_date(v)) AS days, count(*) AS n
        FROM {gates} GROUP BY ALL"""
    return spark.sql(query, args={"run_date": fx.RUN_DATE}, gates=_gates(spark, sf))


def dedupe(spark: SparkSession, sf: str) -> DataFrame:
    query = "SELECT row_key, region, trim(region) AS region, sanction_amount AS ROW_KEY, project_number FROM {p}"
    return dedupe_columns(spark.sql(query, p=fx.projects(spark, sf)))


def rule_fallback(spark: SparkSession, sf: str) -> DataFrame:
    returned = run_sql_rule(spark, SQL_RULE, OPTIONS, _subject(spark, sf))
    return sql_rule_violations(returned, SQL_RULE, OPTIONS)


def all_violations(spark: SparkSession, sf: str) -> DataFrame:
    return report.all_violations(fx.projects(spark, sf), RULES, OPTIONS, [SQL_RULE], _subject(spark, sf))


def _report(spark: SparkSession, sf: str) -> DataFrame:
    described = [*RULES, SQL_RULE]
    return report.violation_report(all_violations(spark, sf), described, fx.RUN_ID, fx.RUN_TIMESTAMP)


def violation_row(spark: SparkSession, sf: str) -> DataFrame:
    keys = RuleOptions(run_date=fx.RUN_DATE, explain=False)
    return report.all_violations(fx.projects(spark, sf), RULES, keys)


def report_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return report.report_sorted(_report(spark, sf))


def rule_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.rule_summary(_report(spark, sf))


def full_rule_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.full_rule_summary(_report(spark, sf), [*RULES, SQL_RULE])


def violation_total(spark: SparkSession, sf: str) -> DataFrame:
    return report.violation_total(rule_summary(spark, sf))


def rule_execution_log(spark: SparkSession, sf: str) -> DataFrame:
    log = execution.rule_execution_log(fx.projects(spark, sf), RULES, OPTIONS, [BROKEN_RULE, SQL_RULE], _subject(spark, sf))
    return log.select("rule_id", "status", "row_count", F.col("error").isNotNull().alias("failed"))


def _explanations(*rule_ids: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rules = [BY_ID[rule_id] for rule_id in rule_ids]
        found = report.all_violations(fx.projects(spark, sf), rules, OPTIONS)
        return found.select("rule_id", "record_id", "explanation")

    return query


def explain_overdue_unparsed(spark: SparkSession, sf: str) -> DataFrame:
    options = RuleOptions(run_date=fx.RUN_DATE, report_unparsed=True)
    found = row_violations(fx.projects(spark, sf), [BY_ID["F5"]], options)
    return found.select("rule_id", "record_id", "failed_value", "explanation")


def _balance(spark: SparkSession, sf: str) -> DataFrame:
    """True violations of all rules, the report under test and a saved summary, set against each other."""
    table = fx.projects(spark, sf)
    expected = reconcile.compared(report.all_violations(table, RULES, RuleOptions(run_date=fx.RUN_DATE, explain=False)))
    path = scratch_path(spark, "truth")
    expected.write.parquet(path)
    truth = spark.read.schema(expected.schema).parquet(path)
    actual = fx.actual_report(truth, table)
    return reconcile.record_balance(truth, actual, fx.saved_summary(actual))


def truth_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.truth_summary(_balance(spark, sf))


def actual_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.actual_summary(_balance(spark, sf))


def compare_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.compare_counts(_balance(spark, sf), RULES)


def false_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.false_negatives(_balance(spark, sf))


def false_positives(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.false_positives(_balance(spark, sf))


def mismatch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.mismatch_summary(_balance(spark, sf), RULES)


def mismatch_sample(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.mismatch_sample(false_negatives(spark, sf), rows=20)


def summary_check(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.summary_check(_balance(spark, sf), RULES)


def _trace(record_id: str | None) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        table, rule = fx.projects(spark, sf), BY_ID["F6"]
        found = row_violations(table, [rule], OPTIONS)
        return trace_record(table, rule, record_id, found)

    return query


def trace_with_result(spark: SparkSession, sf: str) -> DataFrame:
    """All records through a rule, with the rows that a SQL rule returned."""
    table, rule = fx.projects(spark, sf), BY_ID["F6"]
    rows = f"SELECT project_number, project_current_phase, {', '.join(fx.GATES)} FROM IDENTIFIER(:subject) WHERE row_key % 7 = 0"
    returned = run_sql_rule(spark, SqlRule("Q3", "Rows", rows), OPTIONS, _subject(spark, sf))
    return trace_record(table, rule, None, row_violations(table, [rule], OPTIONS), returned)


def trace_without_phase(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a SQL rule that returns no phase."""
    rows = SqlRule("Q3", "Rows", f"SELECT project_number, {fx.GATES[0]} FROM IDENTIFIER(:subject) WHERE row_key % 7 = 0")
    returned = run_sql_rule(spark, rows, OPTIONS, _subject(spark, sf))
    traced = trace_record(fx.projects(spark, sf).limit(0), BY_ID["F6"], None, returned=returned)
    return traced.where("stage LIKE 'result%'")


def image_format(spark: SparkSession, sf: str) -> DataFrame:
    headers = fx.headers(spark, sf)
    return headers.select("doc_id", images.image_format(F.unhex("header_hex")).alias("format"))


def _files(spark: SparkSession, sf: str) -> DataFrame:
    return fx.headers(spark, sf).withColumn("content", F.unhex("header_hex"))


def image_allowlist(spark: SparkSession, sf: str) -> DataFrame:
    return images.image_allowlist(_files(spark, sf)).select("doc_id", "image_format")


def image_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return images.image_quarantine(_files(spark, sf)).select("doc_id", "reason")


def class_index(spark: SparkSession, sf: str) -> DataFrame:
    return images.class_index(_files(spark, sf), "source").select("doc_id", "source", "label")


def scale_values(spark: SparkSession, sf: str) -> DataFrame:
    scaled = images.scale_values("embedding").alias("scaled")
    return fx.view(spark, sf, "embeddings").select("vec_id", scaled).select("vec_id", F.posexplode("scaled"))


def value_min(spark: SparkSession, sf: str) -> DataFrame:
    smallest = images.value_min(images.scale_values("embedding"))
    return fx.view(spark, sf, "embeddings").select("vec_id", smallest.alias("smallest"))


def _vectors_as_images(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector as an 8 x 8 single-channel image in Spark's image layout."""
    byte = F.transform("embedding", lambda x: F.hex(F.abs(F.round(x.cast("double") * 100)).cast("int") % 256))
    text = F.array_join(F.transform(byte, lambda x: F.lpad(x, 2, "0")), "")
    image = F.struct(
        F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"), F.unhex(text).alias("data")
    )
    return fx.view(spark, sf, "embeddings").select("vec_id", image.alias("image"))


def image_prepare(spark: SparkSession, sf: str) -> DataFrame:
    prepared = images.image_prepare(_vectors_as_images(spark, sf), keep=("vec_id",), side=4)
    pixels = prepared.select("vec_id", F.posexplode("pixels").alias("pos", "pixel"))
    return pixels.select("vec_id", "pos", F.round(F.col("pixel") * 1_000_000).cast("long").alias("millionths"))


def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    vectors = fx.view(spark, sf, "embeddings").select("vec_id", "label")
    return splitting.sample_rows(vectors, 4, "vec_id")


def batch_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.batch_numbers(fx.view(spark, sf, "documents"), "doc_id")


def batch_split(spark: SparkSession, sf: str) -> DataFrame:
    documents = fx.view(spark, sf, "documents")
    return splitting.batch_split(documents, "doc_id").select("doc_id", "source", "subset")


def _split_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vectors = fx.view(spark, sf, "embeddings")
    labelled = vectors.select("vec_id", "embedding", (F.col("label") >= 5).cast("int").alias("label"))
    return splitting.batch_split(labelled, "vec_id")


def _fitted(spark: SparkSession, sf: str) -> classify.BinaryModel:
    return classify.fit_binary(_split_vectors(spark, sf), "embedding", "label", "subset")


def fit_binary(spark: SparkSession, sf: str) -> DataFrame:
    """Loss and accuracy of training and validation rows, before the first pass and after each."""
    history = classify.loss_history(spark, _fitted(spark, sf))
    return history.select("pass", "subset", "row_count", F.round("loss", 9).alias("loss"), F.round("accuracy", 9).alias("accuracy"))


def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors scored with fixed weights."""
    vectors = fx.view(spark, sf, "embeddings")
    dims = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    model = classify.BinaryModel(tuple((i * 37 % 11 - 5) / 10 for i in range(dims)), 0.05)
    scored = classify.score_batch(vectors, model, "embedding")
    return scored.select("vec_id", "label", F.round("probability", 9).alias("probability"), "prediction")


def model_save_load(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted on the training rows, saved, loaded, and judged on the test rows."""
    path = scratch_path(spark, "model")
    classify.save_model(spark, _fitted(spark, sf), path)
    test = _split_vectors(spark, sf).where("subset = 'test'")
    return classify.binary_metrics(classify.score_batch(test, classify.load_model(spark, path), "embedding"))


def score_rounding(spark: SparkSession, sf: str) -> DataFrame:
    rounded = classify.rounded_class("probability")
    return fx.scores(spark, sf).select("doc_id", "probability", rounded.alias("prediction"))


def binary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return classify.binary_metrics(fx.scores(spark, sf))


def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "projects-csv")
    sinks.write_report_csv(fx.projects(spark, sf), path)
    return tables.scan_csv(spark, path)


def scan_report(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "report-csv")
    sinks.write_report_csv(_report(spark, sf), path)
    return tables.scan_report(spark, path)


def scan_summary(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{scratch_path(spark, 'summary')}.csv"
    sinks.write_report_csv(rule_summary(spark, sf), path, single_file=True)
    saved = tables.scan_summary(spark, path)
    return saved.withColumn("violation_count", F.col("violation_count").cast("long"))


def write_results(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "results")
    described = _report(spark, sf)
    sinks.write_results(described, path)
    return spark.read.schema(described.schema).parquet(path).select(*described.columns)


def write_rule_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows a SQL rule returns, saved in its folder and read again."""
    path = scratch_path(spark, "rule_rows")
    sinks.write_rule_rows(run_sql_rule(spark, SQL_RULE, OPTIONS, _subject(spark, sf)), path, SQL_RULE.rule_id)
    return sinks.read_rule_rows(spark, path, SQL_RULE.rule_id)


def check_run(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run with a broken SQL rule and one that names an absent column: its log, and what its saved CSV holds per rule."""
    absent = {**fx.RULE_DEFINITIONS[0], "id": "F9", "parameters": {"columns": ["nowhere"]}}
    path = scratch_path(spark, "run")
    done = run_checks(
        fx.projects(spark, sf), [*RULES, *make_rules([absent])], path, OPTIONS, [BROKEN_RULE, SQL_RULE], _subject(spark, sf), fx.RUN_ID
    )
    saved = tables.scan_report(spark, done.manifest.place("fail_report")).groupBy("rule_id").agg(F.count("*").alias("saved"))
    log = sinks.read_run_log(spark, path).join(saved, "rule_id", "left")
    return log.select("run_id", "rule_id", "status", "row_count", "saved", F.col("error").isNotNull().alias("failed"))


def saved_report_order(spark: SparkSession, sf: str) -> DataFrame:
    """The report saved as CSV: number of rows, and pairs of neighbouring files whose rows are not in reading order."""
    path = scratch_path(spark, "sorted-csv")
    sinks.write_report_csv(report.report_sorted(_report(spark, sf)), path)
    key = F.struct(*(F.coalesce(name, F.lit("")).alias(name) for name in REPORT_ORDER))
    rows = tables.scan_full_report(spark, path).select(F.input_file_name().alias("file"), key.alias("key"))
    files = rows.groupBy("file").agg(F.count("*").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))
    numbered = files.withColumn("part", F.regexp_extract("file", r"part-(\d+)", 1).cast("int"))
    before = F.lag("last").over(Window.orderBy("part"))  # a row per file
    wrong = F.count_if(F.col("first") < F.col("before")).alias("files_out_of_order")
    return numbered.withColumn("before", before).agg(F.sum("n").alias("row_count"), wrong)


def sql_rule_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Which SQL rules are accepted, and the rows those return."""
    swapped = SqlRule("Q3", "Swapped", "SELECT project_current_phase, project_number FROM IDENTIFIER(:subject)")
    subject, rows = _subject(spark, sf), []
    for rule in (SQL_RULE, BROKEN_RULE, swapped):
        accepted = sql_rule_check(spark, rule, OPTIONS, subject) is None
        rows.append((rule.rule_id, accepted, run_sql_rule(spark, rule, OPTIONS, subject).count() if accepted else None))
    return spark.createDataFrame(rows, "rule_id string, accepted boolean, row_count long")


def run_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """What two real runs left in the runs table: their rules and rows, and which run is the latest."""
    path, rules = scratch_path(spark, "runs"), [BY_ID["F1"], BY_ID["F5"]]
    for day in fx.RUN_DAYS:
        options = RuleOptions(run_date=day)
        run_checks(fx.projects(spark, sf), rules, path, options, run_id=f"run-{day}", started=datetime.fromisoformat(day))
    latest = sinks.latest_run(spark, path).select("run_id", F.lit(True).alias("latest"))
    recorded = sinks.read_runs(spark, path).join(sinks.read_run_rules(spark, path), "run_id")
    recorded = recorded.join(sinks.read_run_log(spark, path), ["run_id", "rule_id"]).join(latest, "run_id", "left")
    found = recorded.select("run_id", "run_ts", "run_date", "rule_id", "check_type", "row_count", "latest")
    return found.fillna(False, ["latest"])


def load_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Violations of a rule read from a rules file whose list of values comes from the table."""
    path, table = scratch_path(spark, "rules"), fx.projects(spark, sf)
    values = table.where("length(region) = 1 AND region <> 'X'").agg(F.sort_array(F.collect_set("region")).alias("allowed_values"))
    parameters = F.struct(F.lit("region").alias("column"), "allowed_values", F.lit(True).alias("flag_null"))
    texts = {"id": "F4", "name": "Known region", "check_type": "value_in_list", "description": "One of F, O, P"}
    entry = F.struct(*(F.lit(text).alias(name) for name, text in texts.items()), parameters.alias("parameters"))
    values.select(F.to_json(F.struct(F.array(entry).alias("rules"))).alias("value")).coalesce(1).write.text(path)
    return report.all_violations(table, tables.load_rules(spark, path), OPTIONS)


def clean_header(spark: SparkSession, sf: str) -> DataFrame:
    """The table as it comes with a byte order mark in front of its header."""
    table = fx.projects(spark, sf)
    marked = table.toDF(tables.BYTE_ORDER_MARK + table.columns[0], *table.columns[1:])
    return tables.clean_header(marked).select("row_key", "region")


def date_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns that hold dates by their name, and how many rows fill them."""
    table = fx.projects(spark, sf)
    return profile.long_texts(table, profile.date_columns(table)).groupBy("column_name").agg(F.count("v").alias("filled"))


def scan_images(spark: SparkSession, sf: str) -> DataFrame:
    """Files in a folder per class: bytes per class."""
    path = scratch_path(spark, "files")
    files = fx.view(spark, sf, "documents").select("source", F.coalesce("text", F.lit("")).alias("value"))
    files.write.partitionBy("source").option("maxRecordsPerFile", 1000).text(path)
    found = tables.scan_images(spark, path).groupBy("class").agg(F.sum(F.octet_length("content")).alias("bytes"))
    return found.select(F.regexp_replace("class", "^source=", "").alias("class"), "bytes")


def stream_row_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The row-level rules on `orders` read as a stream, to the end of what is there."""
    path, progress = scratch_path(spark, "stream"), scratch_path(spark, "stream-progress")
    schema = fx.view(spark, sf, "orders").schema
    orders = spark.readStream.schema(schema).parquet(f"{sf}/orders.parquet*")
    row_rules = [rule for rule in RULES if rule.check_type != UNIQUE]
    found = stream_violations(fx.projects_from(orders), row_rules, OPTIONS)
    write_violation_stream(found, path, progress).awaitTermination()
    return spark.read.schema(found.schema).parquet(path)


QUERIES: dict[str, Query] = {
    # column building blocks
    "clean_text": clean_text,
    "missing_flag": missing_flag,
    "missing_kind": missing_kind,
    "tolerant_date": tolerant_date,
    "populated_date": populated_date,
    "safe_double": safe_double,
    "display_value": display_value,
    "gate_label": gate_label,
    "days_overdue": days_overdue,
    "any_of": any_of,
    "skip_phases": skip_phases,
    "skip_phases_keep_null": skip_phases_keep_null,
    "run_date": run_date,
    # profiling
    "date_columns": date_columns,
    "date_profile": date_profile,
    "date_format_histogram": date_format_histogram,
    "semantic_schema": semantic_schema,
    "table_shape": table_shape,
    # rules
    "rule_not_null": _rule("F1"),
    "rule_positive_value": _rule("F2"),
    "rule_unique": _rule("F3"),
    "rule_value_in_list": _rule("F4"),
    "rule_gate_overdue": _rule("F5"),
    "rule_gate_completeness": _rule("F6"),
    "rule_gate_not_future": _rule("F7"),
    "rule_date_sequence": _rule("F8"),
    "rule_positive_value_with_missing": _variant("positive_value", skip_null=False),
    "rule_unique_with_blank": _variant("unique", skip_null=False),
    "rule_value_in_list_present_only": _variant("value_in_list", flag_null=False),
    "rule_not_null_skipped_phases": _variant("not_null", skip_phases=["2", "4"]),
    "rule_fallback": rule_fallback,
    "all_violations": all_violations,
    # report
    "violation_row": violation_row,
    "violation_report": _report,
    "explain_not_null": _explanations("F1"),
    "explain_value": _explanations("F2", "F3", "F4"),
    "explain_overdue": _explanations("F5"),
    "explain_overdue_unparsed": explain_overdue_unparsed,
    "explain_completeness": _explanations("F6"),
    "explain_future": _explanations("F7"),
    "explain_sequence": _explanations("F8"),
    "report_sorted": report_sorted,
    "rule_summary": rule_summary,
    "rule_summary_zero_filled": full_rule_summary,
    "violation_total": violation_total,
    "rule_execution_log": rule_execution_log,
    "check_run": check_run,
    "saved_report_order": saved_report_order,
    # SQL rules
    "sql_rule": sql_rule,
    "sql_pinned_date": sql_pinned_date,
    "sql_rule_check": sql_rule_checks,
    "dedupe_columns": dedupe,
    # reconciling
    "truth_summary": truth_summary,
    "actual_summary": actual_summary,
    "compare_counts": compare_counts,
    "false_negatives": false_negatives,
    "false_positives": false_positives,
    "mismatch_summary": mismatch_summary,
    "summary_check": summary_check,
    "mismatch_sample": mismatch_sample,
    # trace
    "trace_record": _trace(TRACED_RECORD),
    "trace_all_records": _trace(None),
    "trace_with_result": trace_with_result,
    "trace_without_phase": trace_without_phase,
    # images and classification
    "image_format": image_format,
    "image_allowlist": image_allowlist,
    "image_quarantine": image_quarantine,
    "class_index": class_index,
    "scale_values": scale_values,
    "image_prepare": image_prepare,
    "value_min": value_min,
    "sample_rows": sample_rows,
    "batch_numbers": batch_numbers,
    "batch_split": batch_split,
    "fit_binary": fit_binary,
    "score_batch": score_batch,
    "score_rounding": score_rounding,
    "binary_metrics": binary_metrics,
    "model_save_load": model_save_load,
    # sources and sinks
    "scan_csv": scan_csv,
    "scan_report": scan_report,
    "scan_summary": scan_summary,
    "write_results": write_results,
    "write_rule_rows": write_rule_rows,
    "load_rules": load_rules,
    "clean_header": clean_header,
    "scan_images": scan_images,
    "run_manifest": run_manifest,
    # streaming
    "stream_row_rules": stream_row_rules,
}
