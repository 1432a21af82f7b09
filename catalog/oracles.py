"""The same results in plain SQL for DuckDB, written from the rules' meaning rather than from the Spark code."""

from __future__ import annotations

from catalog import fixtures as fx
from plumbrule.constants import REPORT_COLUMNS

TODAY = f"DATE '{fx.RUN_DATE.isoformat()}'"
GATES = fx.GATES
LABELS = tuple(f"GATE {name.upper()}" for name in fx.GATE_NAMES)


def _missing(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) IN ('', '01/01/1990', '1990-01-01'))"


def _day(c: str) -> str:
    head = f"substring(trim({c}),1,10)"
    return (
        f"(CASE WHEN regexp_matches({head},'^\\d{{4}}-\\d{{2}}-\\d{{2}}$') OR regexp_matches({head},'^\\d{{4}}/\\d{{2}}/\\d{{2}}$') "
        f"THEN TRY_CAST(replace({head},'/','-') AS DATE) "
        f"WHEN regexp_matches({head},'^\\d{{2}}/\\d{{2}}/\\d{{4}}$') OR regexp_matches({head},'^\\d{{2}}-\\d{{2}}-\\d{{4}}$') "
        f"THEN TRY_CAST(substr(trim({c}),7,4)||'-'||substr(trim({c}),4,2)||'-'||substr(trim({c}),1,2) AS DATE) END)"
    )


def _due(c: str) -> str:
    """Date of a gate that is populated."""
    return f"(CASE WHEN NOT {_missing(c)} THEN {_day(c)} END)"


def _shown(c: str) -> str:
    return f"coalesce(trim({c}),'NULL')"


def _kind(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN 'NULL' WHEN trim({c})='' THEN 'blank/empty' "
        f"WHEN trim({c}) IN ('01/01/1990','1990-01-01') THEN 'sentinel date ('||trim({c})||')' END"
    )


PHASE = "trim(project_current_phase)"
KEYS = "coalesce(project_number,'UNKNOWN') AS record_id, coalesce(project_current_phase,'UNKNOWN') AS phase"


def _select(rule: str, field: str, value: str, why: str, where: str, source: str = "projects") -> str:
    return (
        f"SELECT '{rule}' AS rule_id, {KEYS}, {field} AS failed_field, {value} AS failed_value, "
        f"{why} AS explanation FROM {source} WHERE {where}"
    )


def _column(rule: str, column: str, found: str, expected: str, where: str, source: str = "projects") -> str:
    why = f"'Column: {column} | Found: '||{found}||' | Expected: {expected}'"
    return _select(rule, f"'{column}'", _shown(column), why, where, source)


def _quoted(c: str) -> str:
    return f"''''||{_shown(c)}||''''"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _not_null(extra: str = "TRUE", names=("project_number", "region", "sanction_amount")) -> str:
    return _union(
        [_column("F1", c, f"({_kind(c)})", "Must be filled in", f"{_missing(c)} AND {extra}") for c in names]
    )


AMOUNT_BAD = "(TRY_CAST(sanction_amount AS DOUBLE) IS NULL OR TRY_CAST(sanction_amount AS DOUBLE) <= 0)"
F1 = _not_null()
F2 = _column(
    "F2",
    "sanction_amount",
    _quoted("sanction_amount"),
    "A number above zero",
    f"NOT {_missing('sanction_amount')} AND {AMOUNT_BAD}",
)
F2_MISSING = _column(
    "F2",
    "sanction_amount",
    _quoted("sanction_amount"),
    "A number above zero",
    f"{_missing('sanction_amount')} OR {AMOUNT_BAD}",
)


def _unique(present: str) -> str:
    return _column(
        "F3",
        "project_number",
        _quoted("project_number"),
        "Used once",
        f"{present} AND trim(project_number) IN (SELECT trim(project_number) FROM projects "
        f"WHERE {present} GROUP BY 1 HAVING count(*) > 1)",
    )


F3 = _unique(f"NOT {_missing('project_number')}")
F3_BLANK = _unique("project_number IS NOT NULL")
REGION_FOUND = "(CASE WHEN region IS NULL THEN 'NULL' ELSE ''''||trim(region)||'''' END)"
F4 = _column(
    "F4",
    "region",
    REGION_FOUND,
    "One of F, O, P",
    f"{_missing('region')} OR trim(region) NOT IN ('F','O','P')",
)
F4_PRESENT = _column(
    "F4",
    "region",
    REGION_FOUND,
    "One of F, O, P",
    f"NOT {_missing('region')} AND trim(region) NOT IN ('F','O','P')",
)


def _overdue(unparsed: bool = False) -> str:
    parts = []
    for i, gate in enumerate(GATES):
        phase = str(i + 1)
        late = f"date_diff('day', {_due(gate)}, {TODAY})"
        why = (
            f"'Project is in phase ''{phase}''. {LABELS[i]} milestone date ('||trim({gate})||') is '||"
            f"CAST({late} AS VARCHAR)||' days overdue, which exceeds the 180-day tolerance.'"
        )
        parts.append(_select("F5", f"'{gate}'", _shown(gate), why, f"{PHASE}='{phase}' AND {late} > 180"))
        if unparsed:
            why = f"'Project is in phase ''{phase}''. Could not parse gate date '''||trim({gate})||'''.'"
            where = f"{PHASE}='{phase}' AND NOT {_missing(gate)} AND {_day(gate)} IS NULL"
            parts.append(_select("F5", f"'{gate}'", _shown(gate), why, where))
    return _union(parts)


def _completeness() -> str:
    parts = []
    for i in range(1, 5):
        phase, gates = str(i + 1), GATES[:i]
        labels = "concat_ws(', ', " + ", ".join(
            f"CASE WHEN {_missing(g)} THEN '{label}' END" for g, label in zip(gates, LABELS)
        ) + ")"
        where = f"{PHASE}='{phase}' AND ({' OR '.join(_missing(g) for g in gates)})"
        why = f"'Missing required gates for phase ''{phase}'': '||{labels}"
        parts.append(_select("F6", labels, "'NULL/missing'", why, where))
    return _union(parts)


def _not_future() -> str:
    parts = []
    for i in range(1, 5):
        phase, gates = str(i + 1), GATES[:i]
        reasons = ", ".join(
            f"CASE WHEN {_due(g)} > {TODAY} THEN '{label} date ('||CAST({_due(g)} AS VARCHAR)||"
            f"') is in the future but should be <= today ({fx.RUN_DATE.isoformat()}) for phase ''{phase}''' END"
            for g, label in zip(gates, LABELS)
        )
        where = f"{PHASE}='{phase}' AND ({' OR '.join(f'{_due(g)} > {TODAY}' for g in gates)})"
        parts.append(_select("F7", "'gate_dates'", "'See explanation'", f"concat_ws('; ', {reasons})", where))
    return _union(parts)


def _sequence() -> str:
    pairs = list(zip(range(4), range(1, 5)))
    reasons = ", ".join(
        f"CASE WHEN {_due(GATES[a])} >= {_due(GATES[b])} THEN '{LABELS[b]} date ('||CAST({_due(GATES[b])} AS VARCHAR)||"
        f"') should be later than {LABELS[a]} date ('||CAST({_due(GATES[a])} AS VARCHAR)||')' END"
        for a, b in pairs
    )
    where = " OR ".join(f"{_due(GATES[a])} >= {_due(GATES[b])}" for a, b in pairs)
    return _select("F8", "'date_sequence'", "'See explanation'", f"concat_ws('; ', {reasons})", where)


F5, F6, F7, F8 = _overdue(), _completeness(), _not_future(), _sequence()
RETURNED = (
    f"SELECT project_number, project_current_phase, sanction_amount, {GATES[4]} FROM projects "
    f"WHERE {_day(GATES[4])} > {TODAY} + 60"
)
FALLBACK = (
    f"SELECT 'Q1' AS rule_id, {KEYS}, '{GATES[4]}' AS failed_field, coalesce(sanction_amount,'NULL') AS failed_value, "
    f"'Last gate lies more than 60 days ahead' AS explanation FROM ({RETURNED})"
)
ROW_RULES = (F1, F2, F4, F5, F6, F7, F8)
DECLARED = _union([F1, F2, F3, F4, F5, F6, F7, F8])

RULE_VALUES = ", ".join(
    f"('{d['id']}','{d['name']}','{d['check_type']}','{d.get('severity', 'medium')}','{d.get('dimension', 'unknown')}')"
    for d in fx.RULE_DEFINITIONS
)
SQL_RULE_VALUE = "('Q1','Last gate far ahead','sql','medium','timeliness')"


def _projects(query: str, **views: str) -> str:
    """A query with `projects` and further views in front of it."""
    named = {"projects": fx.PROJECTS_SQL, **views}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in named.items()) + f"\n{query}"


def _rules(with_sql: bool = False) -> str:
    values = RULE_VALUES + (f", {SQL_RULE_VALUE}" if with_sql else "")
    return f"SELECT * FROM (VALUES {values}) AS r(rule_id, rule_name, check_type, severity, dimension)"


def _reported(query: str) -> str:
    """A query over the eleven-column report of all rules."""
    return _projects(
        query,
        rules=_rules(with_sql=True),
        violations=_union([DECLARED, FALLBACK]),
        report=f"SELECT '{fx.RUN_ID}' AS run_id, '{fx.RUN_TIMESTAMP}' AS timestamp, record_id, phase, v.rule_id, rule_name, "
        "severity, dimension, failed_field, failed_value, explanation FROM violations v JOIN rules r ON v.rule_id=r.rule_id",
    )


COLUMNS = ", ".join(REPORT_COLUMNS)


def _compared(query: str) -> str:
    """A query over true and reported violations of all rules."""
    return _projects(
        query,
        rules=_rules(),
        truth=DECLARED,
        actual=fx.ACTUAL_REPORT_SQL,
        saved=fx.SAVED_SUMMARY_SQL,
        t="SELECT rule_id, count(*) AS gt_fail_report_count, count(DISTINCT record_id) AS gt_distinct_records FROM truth GROUP BY 1",
        a="SELECT rule_id, count(*) AS actual_fail_report_count, count(DISTINCT record_id) AS actual_distinct_records FROM actual GROUP BY 1",
        missed="SELECT rule_id, record_id FROM truth EXCEPT SELECT rule_id, record_id FROM actual",
        invented="SELECT rule_id, record_id FROM actual EXCEPT SELECT rule_id, record_id FROM truth",
        comparison="""SELECT rule_id, rule_name, check_type, gt, gr, ac, ar FROM (
            SELECT rules.rule_id, rule_name, check_type, coalesce(gt_fail_report_count,0) AS gt,
              coalesce(gt_distinct_records,0) AS gr, coalesce(actual_fail_report_count,0) AS ac,
              coalesce(actual_distinct_records,0) AS ar
            FROM rules LEFT JOIN t ON rules.rule_id=t.rule_id LEFT JOIN a ON rules.rule_id=a.rule_id)""",
    )


COMPARISON = """rule_id, rule_name, check_type, gt AS gt_fail_report_count, gr AS gt_distinct_records,
  ac AS actual_fail_report_count, ar AS actual_distinct_records, ac-gt AS count_delta, ar-gr AS record_delta, ac=gt AS count_match"""

LONG_NAMES = ("project_number", "project_current_phase", "sanction_amount", "region", *GATES)


def _values(select: str, names=LONG_NAMES, tail: str = "") -> str:
    """A query over (row_key, column_name, v) of the named columns."""
    long = _union([f"SELECT row_key, '{c}' AS column_name, {c} AS v FROM projects" for c in names])
    return _projects(f"SELECT {select} FROM long {tail}", long=long)


def _parse(fmt_shape: str, order: tuple[int, int, int]) -> str:
    y, m, d = order
    iso = f"substr(trim(v),{y},4)||'-'||substr(trim(v),{m},2)||'-'||substr(trim(v),{d},2)"
    return f"count(CASE WHEN regexp_matches(trim(v),'{fmt_shape}') THEN TRY_CAST({iso} AS DATE) END)"


SHAPES = {
    "dd/MM/yyyy": r"^\d{2}/\d{2}/\d{4}$",
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "dd-MM-yyyy": r"^\d{2}-\d{2}-\d{4}$",
    "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$",
}
SLASH, ISO, DASH, YSLASH = (
    _parse(SHAPES["dd/MM/yyyy"], (7, 4, 1)),
    _parse(SHAPES["yyyy-MM-dd"], (1, 6, 9)),
    _parse(SHAPES["dd-MM-yyyy"], (7, 4, 1)),
    _parse(SHAPES["yyyy/MM/dd"], (1, 6, 9)),
)
DATE_PROFILE = _values(
    f"""column_name, count(*) AS total_rows, count(*) FILTER (v IS NULL) AS null_count,
  count(*) FILTER (trim(v)='') AS blank_count, count(*) FILTER (trim(v)='01/01/1990') AS sentinel_count,
  count(*) FILTER (trim(v) IN ('01/01/1990','1990-01-01')) AS sentinel_any_count,
  {SLASH} AS dd_MM_yyyy_count, {ISO} AS yyyy_MM_dd_count, {DASH} AS dd_MM_yyyy_dash_count, {YSLASH} AS yyyy_MM_dd_slash_count,
  count(DISTINCT trim(v)) AS distinct_values,
  count(*) - count(*) FILTER (v IS NULL) - count(*) FILTER (trim(v)='') - {SLASH} - {ISO} - {DASH} - {YSLASH} AS unparsed_nonblank_count""",
    GATES,
    "GROUP BY column_name ORDER BY column_name",
)
SHAPE_CASE = " ".join(f"WHEN regexp_matches(trim(v),'{p}') THEN '{n}'" for n, p in SHAPES.items())
HISTOGRAM = _values(
    f"column_name, CASE {SHAPE_CASE} ELSE 'other' END AS detected_format, count(*) AS count",
    GATES,
    "WHERE trim(v) <> '' GROUP BY ALL ORDER BY ALL",
)
ALL_NAMES = ("row_key", *LONG_NAMES)
SEMANTIC = _projects(
    _union(
        [
            f"SELECT '{c}' AS column_name, CASE WHEN contains('{c}','date') THEN 'DATE' "
            f"WHEN bool_and(regexp_matches(CAST({c} AS VARCHAR),'^[0-9]+$')) THEN 'NUMERIC' ELSE 'STRING' END AS semantic_type, "
            f"count(*) AS row_count FROM projects"
            for c in ALL_NAMES
        ]
    )
)


def _traced(stage: str, where: str) -> list[str]:
    """Phase, gates and missing gates of the rows that meet a condition."""
    key = "coalesce(trim(project_number),'UNKNOWN')"
    parts = [
        f"SELECT {key} AS record_id, '{stage}' AS stage, 0 AS position, 'project_current_phase' AS field, "
        f"project_current_phase AS value, {_shown('project_current_phase')} AS normalized, "
        f"{_missing('project_current_phase')} AS missing FROM projects WHERE {where}"
    ]
    for i, gate in enumerate(GATES[:4]):
        phases = ",".join(f"'{p}'" for p in range(i + 2, 6))
        parts.append(
            f"SELECT {key}, '{stage}', {i + 1}, '{gate}', {gate}, {_shown(gate)}, {_missing(gate)} "
            f"FROM projects WHERE {PHASE} IN ({phases}) AND {where}"
        )
        parts.append(
            f"SELECT {key}, '{stage}_missing', {i + 1}, '{LABELS[i]}', NULL, 'NULL/missing', TRUE "
            f"FROM projects WHERE {PHASE} IN ({phases}) AND {_missing(gate)} AND {where}"
        )
    return parts


def _trace(record: str | None, *more: str) -> str:
    only = f"trim(project_number)='{record}'" if record else "TRUE"
    only_report = f"trim(record_id)='{record}'" if record else "TRUE"
    reported = f"SELECT trim(record_id), 'report', 0, failed_field, failed_value, explanation, NULL FROM found WHERE {only_report}"
    return _projects(_union([*_traced("source", only), *more, reported]), found=F6)


WITHOUT_PHASE = _projects(
    "SELECT coalesce(trim(project_number),'UNKNOWN') AS record_id, 'result' AS stage, 0 AS position, 'project_current_phase' AS field, "
    "CAST(NULL AS VARCHAR) AS value, 'NULL' AS normalized, TRUE AS missing FROM projects WHERE row_key % 7 = 0"
)


def _headers(query: str) -> str:
    formats = (
        "CASE WHEN header_hex LIKE 'FFD8FF%' THEN 'jpeg' WHEN header_hex LIKE '89504E470D0A1A0A%' THEN 'png' "
        "WHEN header_hex LIKE '424D%' THEN 'bmp' WHEN header_hex LIKE '47494638_761%' OR header_hex LIKE '47494638_961%' "
        "OR header_hex LIKE '474946383761%' OR header_hex LIKE '474946383961%' THEN 'gif' "
        "WHEN header_hex LIKE '49492A00%' OR header_hex LIKE '4D4D002A%' THEN 'tiff' END"
    )
    return f"WITH headers AS ({fx.HEADERS_SQL}), f AS (SELECT doc_id, source, {formats} AS format FROM headers)\n{query}"


BATCHES = """WITH d AS (SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents),
  n AS (SELECT CAST(ceil(count(*)/32.0) AS BIGINT) AS n FROM documents),
  s AS (SELECT CAST(floor(n*0.7e0) AS BIGINT)+1 AS a, CAST(floor(n*0.2e0) AS BIGINT)+1 AS b, CAST(floor(n*0.1e0) AS BIGINT) AS c FROM n),
  x AS (SELECT doc_id, source, row_index, row_index//32 AS batch,
    CASE WHEN row_index//32 < a THEN 'train' WHEN row_index//32 < a+b THEN 'test' WHEN row_index//32 < a+b+c THEN 'val' END AS subset
    FROM d, s)
"""

ROUNDED = "CASE WHEN probability > 0.5e0 THEN 1 ELSE 0 END"
METRICS = f"""WITH scores AS ({fx.SCORES_SQL}), c AS (SELECT
  count(*) FILTER (label=1 AND {ROUNDED}=1) AS tp, count(*) FILTER (label<>1 AND {ROUNDED}=1) AS fp,
  count(*) FILTER (label=1 AND {ROUNDED}=0) AS fn, count(*) FILTER (label<>1 AND {ROUNDED}=0) AS tn FROM scores)
SELECT tp, fp, fn, tn, coalesce(CAST(tp+tn AS DOUBLE)/nullif(tp+fp+fn+tn,0),0) AS accuracy,
  coalesce(CAST(tp AS DOUBLE)/nullif(tp+fp,0),0) AS precision, coalesce(CAST(tp AS DOUBLE)/nullif(tp+fn,0),0) AS recall FROM c"""

# An 8 x 8 image taken down to 4 x 4: every output pixel lies half-way between 2 x 2 input
# pixels, so it is their mean; the three channels are equal.
RESIZED = """WITH e AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding,1)-1 AS i FROM embeddings),
  b AS (SELECT vec_id, i//8 AS r, i%8 AS c, CAST(abs(round(CAST(x AS DOUBLE)*100)) AS INTEGER)%256 AS byte FROM e),
  p AS (SELECT vec_id, r//2 AS r, c//2 AS c, sum(byte)/4.0e0/255.0e0 AS pixel FROM b GROUP BY ALL)
SELECT vec_id, CAST((r*4+c)*3+channel AS INTEGER) AS pos, CAST(round(pixel*1000000) AS BIGINT) AS millionths
FROM p, (VALUES (0),(1),(2)) AS k(channel)"""

# Two gradient steps with momentum from zero weights and the log odds of the training labels. `rows` are vectors with their
# subset; m0, m1, m2 their margins before the first step and after each.
SPLIT_VECTORS = BATCHES.replace("doc_id, source", "vec_id, embedding, label").replace("documents", "embeddings").replace("doc_id", "vec_id").replace(
    "source", "embedding"
)
FITTED = (
    SPLIT_VECTORS
    + """, split AS (SELECT vec_id, (label >= 5)::INTEGER AS y, list_transform(embedding, lambda v: v::DOUBLE) AS v, subset FROM x),
  start AS (SELECT count(*) AS n, ln(avg(y) / (1 - avg(y))) AS b0, 4 / (sum(list_dot_product(v, v)) / count(*) + 1) AS step
    FROM split WHERE subset = 'train'),
  m0 AS (SELECT s.*, b0 AS m FROM split s, start),
  g1 AS (SELECT i, avg((1 / (1 + exp(-m)) - y) * v[i]) AS g FROM m0, range(1, 65) AS r(i) WHERE subset = 'train' GROUP BY i),
  c1 AS (SELECT avg(1 / (1 + exp(-m)) - y) AS g FROM m0 WHERE subset = 'train'),
  w1 AS (SELECT list(-step * g ORDER BY i) AS w FROM g1, start),
  d1 AS (SELECT -step * g AS d FROM c1, start),
  m1 AS (SELECT s.*, list_dot_product(v, w) + b0 + d AS m FROM split s, start, w1, d1),
  g2 AS (SELECT i, avg((1 / (1 + exp(-m)) - y) * v[i]) AS g FROM m1, range(1, 65) AS r(i) WHERE subset = 'train' GROUP BY i),
  c2 AS (SELECT avg(1 / (1 + exp(-m)) - y) AS g FROM m1 WHERE subset = 'train'),
  w2 AS (SELECT list(1.9 * w[i] - step * g ORDER BY i) AS w FROM g2, start, w1),
  m2 AS (SELECT s.*, list_dot_product(v, w2.w) + b0 + d + 0.9 * d - step * g AS m FROM split s, start, w2, d1, c2),
  margins AS (SELECT 0 AS pass, * FROM m0 UNION ALL SELECT 1, * FROM m1 UNION ALL SELECT 2, * FROM m2)
"""
)
HISTORY = FITTED + """SELECT pass::INTEGER AS pass, subset, count(*) AS row_count, round(avg(ln(1 + exp(-abs(m))) + greatest(m, 0) - y * m), 9) AS loss,
  round(avg(((m > 0) = (y = 1))::INTEGER), 9) AS accuracy FROM margins WHERE subset IN ('train', 'val') GROUP BY ALL"""
JUDGED = FITTED + """, c AS (SELECT count(*) FILTER (y=1 AND m>0) AS tp, count(*) FILTER (y=0 AND m>0) AS fp,
  count(*) FILTER (y=1 AND m<=0) AS fn, count(*) FILTER (y=0 AND m<=0) AS tn FROM m2 WHERE subset = 'test')
SELECT tp, fp, fn, tn, coalesce(CAST(tp+tn AS DOUBLE)/nullif(tp+fp+fn+tn,0),0) AS accuracy,
  coalesce(CAST(tp AS DOUBLE)/nullif(tp+fp,0),0) AS precision, coalesce(CAST(tp AS DOUBLE)/nullif(tp+fn,0),0) AS recall FROM c"""
SCORED = """WITH s AS (SELECT vec_id, label, 1 / (1 + exp(-(0.05::DOUBLE + list_dot_product(list_transform(embedding, lambda v: v::DOUBLE),
  list_transform(range(len(embedding)), lambda i: (i * 37 % 11 - 5)::DOUBLE / 10))))) AS p FROM embeddings)
SELECT vec_id, label, round(p, 9) AS probability, (p > 0.5)::INTEGER AS prediction FROM s"""

RECORDED_RUNS = _projects(
    _union(
        [
            f"SELECT 'run-{day}' AS run_id, '{day.replace('-', '')}_000000' AS run_ts, '{day}' AS run_date, rule_id, check_type, count(*) AS row_count, "
            f"{'TRUE' if day == max(fx.RUN_DAYS) else 'FALSE'} AS latest "
            f"FROM (SELECT rule_id, 'not_null' AS check_type FROM ({F1}) "
            f"UNION ALL SELECT rule_id, 'active_gate_overdue' FROM ({F5.replace(TODAY, f"DATE '{day}'")})) GROUP BY rule_id, check_type"
            for day in fx.RUN_DAYS
        ]
    )
)
EMPTY_AS_NULL = ", ".join(["CAST(row_key AS VARCHAR) AS row_key", *(f"nullif({c},'') AS {c}" for c in LONG_NAMES)])

ORACLES: dict[str, str] = {
    "clean_text": _values("row_key, column_name, trim(v) AS cleaned"),
    "missing_flag": _values(f"row_key, column_name, {_missing('v')} AS missing"),
    "missing_kind": _values(f"row_key, column_name, {_kind('v')} AS kind"),
    "tolerant_date": _values(f"row_key, column_name, {_day('v')} AS day", GATES),
    "populated_date": _values(f"row_key, column_name, {_due('v')} IS NOT NULL AS populated", GATES),
    "safe_double": _projects("SELECT row_key, TRY_CAST(sanction_amount AS DOUBLE) AS amount FROM projects"),
    "display_value": _values(f"row_key, column_name, {_shown('v')} AS shown"),
    "gate_label": _values(
        "'GATE '||upper(regexp_extract(column_name,'project_gate_(.*)_milestone_date',1)) AS label, count(v) AS present",
        GATES,
        "GROUP BY 1",
    ),
    "days_overdue": _values(
        f"row_key, column_name, CAST(date_diff('day', {_day('v')}, {TODAY}) AS INTEGER) AS days", GATES
    ),
    "any_of": _projects(
        f"SELECT row_key, ({' OR '.join(_missing(g) for g in GATES)}) AS some_missing, FALSE AS of_none FROM projects"
    ),
    "skip_phases": _projects(f"SELECT row_key, project_current_phase FROM projects WHERE {PHASE} NOT IN ('1','3')"),
    "skip_phases_keep_null": _projects(
        "SELECT row_key, project_current_phase FROM projects "
        f"WHERE project_current_phase IS NULL OR {PHASE} NOT IN ('1','3')"
    ),
    "run_date": _values(
        f"column_name, count(*) AS ahead, min({_day('v')}) AS first_day",
        GATES,
        f"WHERE {_day('v')} > {TODAY} GROUP BY 1",
    ),
    "date_columns": _values("column_name, count(v) AS filled", GATES, "GROUP BY 1"),
    "date_profile": DATE_PROFILE,
    "date_format_histogram": HISTOGRAM,
    "semantic_schema": SEMANTIC,
    "table_shape": _projects(f"SELECT count(*) AS row_count, CAST({len(ALL_NAMES)} AS INTEGER) AS column_count FROM projects"),
    "rule_not_null": _projects(F1),
    "rule_positive_value": _projects(F2),
    "rule_unique": _projects(F3),
    "rule_value_in_list": _projects(F4),
    "rule_gate_overdue": _projects(F5),
    "rule_gate_completeness": _projects(F6),
    "rule_gate_not_future": _projects(F7),
    "rule_date_sequence": _projects(F8),
    "rule_positive_value_with_missing": _projects(F2_MISSING),
    "rule_unique_with_blank": _projects(F3_BLANK),
    "rule_value_in_list_present_only": _projects(F4_PRESENT),
    "rule_not_null_skipped_phases": _projects(_not_null(f"{PHASE} NOT IN ('2','4')")),
    "rule_fallback": _projects(FALLBACK),
    "all_violations": _projects(_union([DECLARED, FALLBACK])),
    "violation_row": _projects(f"SELECT rule_id, record_id, phase, failed_field, failed_value FROM ({DECLARED})"),
    "violation_report": _reported(f"SELECT {COLUMNS} FROM report"),
    "explain_not_null": _projects(f"SELECT rule_id, record_id, explanation FROM ({F1})"),
    "explain_value": _projects(f"SELECT rule_id, record_id, explanation FROM ({_union([F2, F3, F4])})"),
    "explain_overdue": _projects(f"SELECT rule_id, record_id, explanation FROM ({F5})"),
    "explain_overdue_unparsed": _projects(f"SELECT rule_id, record_id, failed_value, explanation FROM ({_overdue(True)})"),
    "explain_completeness": _projects(f"SELECT rule_id, record_id, explanation FROM ({F6})"),
    "explain_future": _projects(f"SELECT rule_id, record_id, explanation FROM ({F7})"),
    "explain_sequence": _projects(f"SELECT rule_id, record_id, explanation FROM ({F8})"),
    "report_sorted": _reported(
        f"SELECT {COLUMNS} FROM report ORDER BY rule_id, record_id, phase, failed_field, failed_value, explanation"
    ),
    "rule_summary": _reported(
        "SELECT rule_id, rule_name, severity, dimension, count(*) AS violation_count FROM report GROUP BY ALL ORDER BY rule_id"
    ),
    "rule_summary_zero_filled": _reported(
        "SELECT rules.rule_id, rules.rule_name, rules.severity, rules.dimension, count(report.rule_id) AS violation_count "
        "FROM rules LEFT JOIN report ON rules.rule_id=report.rule_id GROUP BY ALL ORDER BY 1"
    ),
    "violation_total": _reported("SELECT count(*) AS violation_total FROM report"),
    "rule_execution_log": _projects(
        "SELECT rule_id, 'OK' AS status, count(*) AS row_count, FALSE AS failed FROM violations GROUP BY 1 "
        "UNION ALL SELECT 'Q2', 'ERROR', NULL, TRUE",
        violations=_union([DECLARED, FALLBACK]),
    ),
    "check_run": _projects(
        f"SELECT '{fx.RUN_ID}' AS run_id, rule_id, 'OK' AS status, count(*) AS row_count, count(*) AS saved, FALSE AS failed FROM violations GROUP BY 2 "
        f"UNION ALL SELECT '{fx.RUN_ID}', unnest(['Q2', 'F9']), 'ERROR', NULL, NULL, TRUE",
        violations=_union([DECLARED, FALLBACK]),
    ),
    "saved_report_order": _reported("SELECT count(*) AS row_count, 0::BIGINT AS files_out_of_order FROM report"),
    "sql_rule": _projects(RETURNED),
    "sql_rule_check": _projects(
        f"SELECT 'Q1' AS rule_id, TRUE AS accepted, count(*) AS row_count FROM ({RETURNED}) "
        "UNION ALL SELECT unnest(['Q2', 'Q3']), FALSE, NULL"
    ),
    "sql_pinned_date": _values(
        f"column_name, {_day('v')} AS day, CAST(date_diff('day', {_day('v')}, {TODAY}) AS INTEGER) AS days, count(*) AS n",
        GATES,
        "GROUP BY ALL",
    ),
    "dedupe_columns": _projects("SELECT row_key, region, project_number FROM projects"),
    "truth_summary": _compared("SELECT * FROM t"),
    "actual_summary": _compared("SELECT * FROM a"),
    "compare_counts": _compared(f"SELECT {COMPARISON} FROM comparison ORDER BY rule_id"),
    "false_negatives": _compared("SELECT * FROM missed"),
    "false_positives": _compared("SELECT * FROM invented"),
    "mismatch_summary": _compared(
        """SELECT rule_id, rule_name, check_type,
          (SELECT count(*) FROM missed m WHERE m.rule_id=r.rule_id) AS false_negative_records,
          (SELECT count(*) FROM invented i WHERE i.rule_id=r.rule_id) AS false_positive_records FROM rules r ORDER BY rule_id"""
    ),
    "summary_check": _compared(
        f"""SELECT {COMPARISON}, dq AS dq_summary_count, dq=gt AS dq_summary_matches_ground_truth,
          dq=ac AS dq_summary_matches_generated_report
        FROM (SELECT comparison.*, saved.violation_count AS dq FROM comparison LEFT JOIN saved ON comparison.rule_id=saved.rule_id)
        ORDER BY rule_id"""
    ),
    "mismatch_sample": _compared("SELECT * FROM missed ORDER BY rule_id, record_id LIMIT 20"),
    "trace_record": _trace("P7"),
    "trace_all_records": _trace(None),
    "trace_with_result": _trace(None, *_traced("result", "row_key % 7 = 0")),
    "trace_without_phase": WITHOUT_PHASE,
    "image_format": _headers("SELECT doc_id, format FROM f"),
    "image_allowlist": _headers("SELECT doc_id, format AS image_format FROM f WHERE format IN ('jpeg','png','bmp')"),
    "image_quarantine": _headers(
        "SELECT doc_id, CASE WHEN format IS NULL THEN 'unknown format' ELSE 'format not allowed: '||format END AS reason "
        "FROM f WHERE format IS NULL OR format NOT IN ('jpeg','png','bmp')"
    ),
    "class_index": "SELECT doc_id, source, CAST(dense_rank() OVER (ORDER BY source)-1 AS INTEGER) AS label FROM documents",
    "scale_values": "SELECT vec_id, CAST(generate_subscripts(embedding,1)-1 AS INTEGER) AS pos, "
    "CAST(unnest(embedding) AS DOUBLE)/255.0e0 AS col FROM embeddings",
    "image_prepare": RESIZED,
    "value_min": "SELECT vec_id, CAST(list_min(embedding) AS DOUBLE)/255.0e0 AS smallest FROM embeddings",
    "sample_rows": "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 4",
    "batch_numbers": BATCHES + "SELECT doc_id, row_index, batch, subset FROM x",
    "batch_split": BATCHES + "SELECT doc_id, source, subset FROM x",
    "fit_binary": HISTORY,
    "score_batch": SCORED,
    "model_save_load": JUDGED,
    "score_rounding": f"WITH scores AS ({fx.SCORES_SQL}) SELECT doc_id, probability, {ROUNDED} AS prediction FROM scores",
    "binary_metrics": METRICS,
    "scan_csv": _projects(f"SELECT {EMPTY_AS_NULL} FROM projects"),
    "scan_report": _projects(
        "SELECT rule_id, nullif(record_id,'') AS record_id, nullif(phase,'') AS phase, failed_field, "
        f"nullif(failed_value,'') AS failed_value FROM ({_union([DECLARED, FALLBACK])})"
    ),
    "scan_summary": _reported(
        "SELECT rule_id, rule_name, severity, dimension, count(*) AS violation_count FROM report GROUP BY ALL"
    ),
    "write_results": _reported(f"SELECT {COLUMNS} FROM report"),
    "write_rule_rows": _projects(RETURNED),
    "run_manifest": RECORDED_RUNS,
    "load_rules": _projects(F4),
    "clean_header": _projects("SELECT row_key, region FROM projects"),
    "scan_images": "SELECT source AS class, sum(octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS bytes FROM documents GROUP BY 1",
    "stream_row_rules": _projects(_union(list(ROW_RULES))),
}
