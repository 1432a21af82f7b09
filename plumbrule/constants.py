"""Names and texts that define the results.

Fixed values: everything in this module has to be exactly as written for the
results to be comparable with reports produced elsewhere.
"""

from __future__ import annotations

# Columns of the subject table that identify a record and its phase.
ID_COLUMN = "project_number"
PHASE_COLUMN = "project_current_phase"

# Placeholder dates that count as "missing".
SENTINELS = ("01/01/1990", "1990-01-01")

# Accepted date layouts, tried on the first ten characters of the trimmed text.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy/MM/dd")
DATE_TEXT_LENGTH = 10

# Values printed for absent data.
NULL_TEXT = "NULL"
UNKNOWN_TEXT = "UNKNOWN"

# Check types a declarative rule can have.
NOT_NULL = "not_null"
POSITIVE_VALUE = "positive_value"
UNIQUE = "unique"
VALUE_IN_LIST = "value_in_list"
GATE_OVERDUE = "active_gate_overdue"
GATE_COMPLETENESS = "progressive_gate_completeness"
GATE_NOT_FUTURE = "completed_gate_not_future"
DATE_SEQUENCE = "date_sequence"
CHECK_TYPES = (
    NOT_NULL,
    POSITIVE_VALUE,
    UNIQUE,
    VALUE_IN_LIST,
    GATE_OVERDUE,
    GATE_COMPLETENESS,
    GATE_NOT_FUTURE,
    DATE_SEQUENCE,
)

# Rule keys that may name the checked columns / the allowed values, first hit wins.
COLUMN_KEYS = (
    "columns",
    "fields",
    "field",
    "column",
    "target_columns",
    "target_column",
    "mandatory_fields",
)
ALLOWED_KEYS = ("allowed_values", "values", "valid_values", "list")

# Defaults of a rule.
DEFAULT_SEVERITY = "medium"
DEFAULT_DIMENSION = "unknown"
DEFAULT_OVERDUE_DAYS = 180

# failed_field / failed_value texts of the rules that look at several columns.
COMPLETENESS_VALUE = "NULL/missing"
FUTURE_FIELD = "gate_dates"
SEQUENCE_FIELD = "date_sequence"
SEE_EXPLANATION = "See explanation"

# How a gate column name is shown: text replacements, then upper case.
GATE_LABEL_REPLACEMENTS = (("project_gate_", "GATE "), ("_milestone_date", ""))

# Columns of the saved violation report, in order, all text.
REPORT_COLUMNS = (
    "run_id",
    "timestamp",
    "record_id",
    "phase",
    "rule_id",
    "rule_name",
    "severity",
    "dimension",
    "failed_field",
    "failed_value",
    "explanation",
)
# Columns two reports are compared on.
COMPARED_COLUMNS = ("rule_id", "record_id", "phase", "failed_field", "failed_value")
# Sort order of the report.
REPORT_ORDER = ("rule_id", "record_id", "phase", "failed_field", "failed_value", "explanation")
# Grouping of the rule summary.
SUMMARY_KEYS = ("rule_id", "rule_name", "severity", "dimension")

# Rows shown of a mismatch list; rows a SQL rule is tried on.
MISMATCH_SAMPLE_ROWS = 100
TRIAL_ROWS = 10

# Parts of a column name that mark it as a date for profiling.
DATE_NAME_PARTS = ("date", "milestone")
# Shape classes of date text, in test order; anything else is "other".
DATE_SHAPES = (
    ("dd/MM/yyyy", r"^\d{2}/\d{2}/\d{4}$"),
    ("yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$"),
    ("dd-MM-yyyy", r"^\d{2}-\d{2}-\d{4}$"),
    ("yyyy/MM/dd", r"^\d{4}/\d{2}/\d{2}$"),
)
OTHER_SHAPE = "other"
# Count column of each parse format in the date profile.
PROFILE_FORMATS = (
    ("dd/MM/yyyy", "dd_MM_yyyy_count"),
    ("yyyy-MM-dd", "yyyy_MM_dd_count"),
    ("dd-MM-yyyy", "dd_MM_yyyy_dash_count"),
    ("yyyy/MM/dd", "yyyy_MM_dd_slash_count"),
)
PROFILE_SENTINEL = "01/01/1990"

# Image formats kept, and the leading bytes (hex) of the formats recognised.
ALLOWED_IMAGE_FORMATS = ("jpg", "png", "jpeg", "bmp")
IMAGE_SIGNATURES = (
    ("jpeg", ("FFD8FF",)),
    ("png", ("89504E470D0A1A0A",)),
    ("bmp", ("424D",)),
    ("gif", ("474946383761", "474946383961")),
    ("tiff", ("49492A00", "4D4D002A")),
)
IMAGE_SIDE = 256
PIXEL_MAX = 255
BATCH_SIZE = 32

# Split of n batches: int(n * share) + extra, cut off by what is left.
SPLIT_SHARES = (("train", 0.7, 1), ("test", 0.2, 1), ("val", 0.1, 0))
