"""Rules that look at one row at a time, evaluated together in a single pass.

The findings of all rules go into arrays that are exploded together, so any number of rules costs one scan and no
shuffle. Trimmed texts, missing flags and parsed dates are computed once per column in projections below the rules. A
finding takes along its number, the value it is about and what else depends on the row; texts that only depend on the
rule are looked up by that number, in constant arrays, after the explode. Nothing here needs more than the row itself, so the
same code runs on a streaming DataFrame.

Spark makes one method of all projections in a row, and the JVM compiles no method beyond 8,000 bytes. Expressions are
therefore taken in parts of at most `PART_LENGTH` characters with a boundary of code generation between them, whatever the
number of rules and columns.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrule.constants import (
    COMPLETENESS_VALUE,
    DATE_SEQUENCE,
    FUTURE_FIELD,
    GATE_COMPLETENESS,
    GATE_NOT_FUTURE,
    GATE_OVERDUE,
    NOT_NULL,
    NULL_TEXT,
    POSITIVE_VALUE,
    SEE_EXPLANATION,
    SEQUENCE_FIELD,
    UNIQUE,
    UNKNOWN_TEXT,
    VALUE_IN_LIST,
)
from plumbrule.functions import text as sql
from plumbrule.functions.text import listed, literal, quoted
from plumbrule.plans.options import RuleOptions
from plumbrule.plans.rules import Rule

HIT, VALUE, DAY, DETAIL = "__hit", "__value", "__gate_day", "__detail"
# Characters of SQL in one generated method, and partitions that no table has.
PART_LENGTH = 3_000
NO_LIMIT = 1 << 30
VIOLATION_COLUMNS = ("rule_id", "record_id", "phase", "failed_field", "failed_value")


def boundary(df: DataFrame) -> DataFrame:
    """`df` with an end of code generation behind it. Coalescing to more partitions than there are moves no row."""
    return df.coalesce(NO_LIMIT)


def parts_of(expressions: Iterable[str]) -> list[list[str]]:
    """The expressions in parts of bounded length, in their order; a longer one is a part of its own."""
    parts: list[list[str]] = []
    length = PART_LENGTH
    for expression in expressions:
        length += len(expression)
        if length > PART_LENGTH:
            parts.append([])
            length = len(expression)
        parts[-1].append(expression)
    return parts


class PreparedColumns:
    """Per-column values several rules share; each is computed once, in one of four layers."""

    def __init__(self, options: RuleOptions):
        self.options = options
        self._numbers: dict[str, int] = {}
        self._layers: tuple[dict[str, str], ...] = ({}, {}, {}, {})

    def _add(self, layer: int, kind: str, name: str, expression: str) -> str:
        number = self._numbers.setdefault(name.lower(), len(self._numbers))
        alias = f"__{kind}_{number}"
        self._layers[layer].setdefault(alias, expression)
        return alias

    def _raw(self, name: str) -> str:
        return self._add(0, "raw", name, f"CAST({quoted(name)} AS STRING)")

    def text(self, name: str) -> str:
        return self._add(1, "text", name, sql.cleaned(self._raw(name)))

    def number(self, name: str) -> str:
        return self._add(1, "number", name, sql.number_of(self._raw(name)))

    def missing(self, name: str) -> str:
        return self._add(2, "missing", name, sql.is_missing(self.text(name), self.options.sentinels))

    def day(self, name: str) -> str:
        """Date of a populated date column; NULL when missing or unreadable."""
        head = sql.head_of_date(sql.present(self.text(name), self.options.sentinels))
        return self._add(3, "day", name, sql.date_of(self._add(2, "head", name, head)))

    def apply(self, df: DataFrame) -> DataFrame:
        """Identifying columns plus everything requested so far."""
        raw, *layers = self._layers
        kept = [
            f"{identity(self.options.id_column)} AS record_id",
            f"{identity(self.options.phase_column)} AS phase",
        ]
        prepared = df.selectExpr(*kept, *_named(raw))
        for layer in layers:
            for part in parts_of(_named(layer)):
                prepared = boundary(prepared.selectExpr("*", *part))
        return prepared


def _named(layer: dict[str, str]) -> list[str]:
    return [f"{expression} AS {alias}" for alias, expression in layer.items()]


def identity(name: str) -> str:
    """Record id or phase as reported: untrimmed, `UNKNOWN` when NULL."""
    return f"coalesce(CAST({quoted(name)} AS STRING), {literal(UNKNOWN_TEXT)})"


def kept_by_phase(rule: Rule, ready: PreparedColumns) -> str:
    """False for rows the rule's skipped phases exclude."""
    if not rule.skip_phases:
        return "TRUE"
    phase = ready.text(ready.options.phase_column)
    return f"coalesce({phase} NOT IN ({listed(rule.skip_phases)}), {literal(ready.options.keep_null_phase)})"


@dataclass(frozen=True)
class Finding:
    """What one violation of a rule looks like, in SQL text.

    `value` (NULL shows as such) is SQL or, as `Fixed`, plain text. `field` is plain text, or NULL where it is the
    `detail`, SQL over the row. The explanation is the SQL `why` between the plain texts `before` and `after`; it
    refers to VALUE, DAY and DETAIL only, so that findings of a kind share their code.
    """

    rule: Rule
    condition: str
    field: str | None
    value: str
    before: str
    why: str
    after: str = ""
    day: str = "CAST(NULL AS DATE)"
    detail: str = "CAST(NULL AS STRING)"

    def taken(self, number: int, explained: bool) -> str:
        """The finding as it is exploded."""
        value = literal(None) if isinstance(self.value, Fixed) else self.value
        parts = {HIT: str(number), VALUE: value}
        if explained or self.field is None:
            parts |= {DAY: self.day, DETAIL: self.detail}
        else:
            parts |= {DAY: "CAST(NULL AS DATE)", DETAIL: "CAST(NULL AS STRING)"}
        return f"named_struct({', '.join(f'{literal(name)}, {part}' for name, part in parts.items())})"


class Fixed(str):
    """A plain text, as opposed to SQL."""


# Findings of which a row can have at most one, because each asks for another phase.
Alternatives = list[Finding]


def in_quotes(value: str) -> str:
    return f"concat({literal(chr(39))}, {value}, {literal(chr(39))})"


SHOWN = sql.shown(VALUE)
VALUE_OR_NULL = f"coalesce({in_quotes(VALUE)}, {literal(NULL_TEXT)})"


def column_finding(rule: Rule, condition: str, name: str, ready: PreparedColumns, found: str) -> Finding:
    """A finding about the value of a single column."""
    before, after = f"Column: {name} | Found: ", f" | Expected: {rule.description}"
    return Finding(rule, condition, name, ready.text(name), before, found, after)


def some(conditions: Iterable[str]) -> str:
    """OR of the conditions; false for none."""
    return "(" + (" OR ".join(conditions) or "FALSE") + ")"


def joined(separator: str, parts: Iterable[str]) -> str:
    """The parts that are not NULL, with a separator between them."""
    return f"concat_ws({', '.join((literal(separator), *parts))})"


def not_null_findings(rule: Rule, ready: PreparedColumns) -> list[Alternatives]:
    kind = sql.kind_of_missing(VALUE, ready.options.sentinels)
    return [[column_finding(rule, ready.missing(name), name, ready, kind)] for name in rule.columns]


def positive_value_findings(rule: Rule, ready: PreparedColumns) -> list[Alternatives]:
    name = rule.columns[0]
    number, missing = ready.number(name), ready.missing(name)
    not_positive = f"({number} IS NULL OR {number} <= 0)"
    condition = f"(NOT {missing} AND {not_positive})" if rule.skip_null else f"({missing} OR {not_positive})"
    return [[column_finding(rule, condition, name, ready, in_quotes(SHOWN))]]


def value_in_list_findings(rule: Rule, ready: PreparedColumns) -> list[Alternatives]:
    name = rule.columns[0]
    text, missing = ready.text(name), ready.missing(name)
    outside = f"{text} NOT IN ({listed(rule.allowed)})" if rule.allowed else f"{text} IS NOT NULL"
    condition = f"({outside} OR {missing})" if rule.flag_null else f"({outside} AND NOT {missing})"
    return [[column_finding(rule, condition, name, ready, VALUE_OR_NULL)]]


def overdue_findings(rule: Rule, ready: PreparedColumns) -> list[Alternatives]:
    """The phase picks the gate."""
    options = ready.options
    phase, today = ready.text(options.phase_column), literal(options.today())
    late_alternatives, unread_alternatives = [], []
    days = f"concat({SHOWN}, ') is ', datediff({today}, {DAY}))"
    after = f" days overdue, which exceeds the {rule.overdue_days}-day tolerance."
    for name, gates in rule.phase_gates:
        for gate in gates[:1]:
            in_phase, text, day = f"{phase} = {literal(name)}", ready.text(gate), ready.day(gate)
            before = f"Project is in phase '{name}'. {options.label(gate)} milestone date ("
            late = f"({in_phase} AND datediff({today}, {day}) > {rule.overdue_days})"
            late_alternatives.append(Finding(rule, late, gate, text, before, days, after, day))
            before = f"Project is in phase '{name}'. Could not parse gate date '"
            unread = f"({in_phase} AND NOT {ready.missing(gate)} AND {day} IS NULL)"
            unread_alternatives.append(Finding(rule, unread, gate, text, before, SHOWN, "'."))
    return [late_alternatives, unread_alternatives] if options.report_unparsed else [late_alternatives]


def gate_parts(rule: Rule, phase: str, part: Callable[[str], tuple[str, str]]) -> dict[str, list[str]]:
    """Per phase, a text for each of its gates that meets a condition, NULL for the others.

    `part` gives condition and text of a gate. If all phases list their gates in one common
    order, they share one list, in which a gate is asked for its phase.
    """
    phases = [name for name, _ in rule.phase_gates]
    common = list(dict.fromkeys(gate for _, gates in rule.phase_gates for gate in gates))
    in_order = all(gates == tuple(g for g in common if g in gates) for _, gates in rule.phase_gates)

    def text(gate: str, guard: str) -> str:
        condition, shown = part(gate)
        return f"CASE WHEN {guard}{condition} THEN {shown} END"

    if not in_order:
        return {name: [text(gate, "") for gate in gates] for name, gates in rule.phase_gates}
    shared = []
    for gate in common:
        asking = [name for name, gates in rule.phase_gates if gate in gates]
        shared.append(text(gate, "" if len(asking) == len(phases) else f"{phase} IN ({listed(asking)}) AND "))
    return dict.fromkeys(phases, shared)


def completeness_findings(rule: Rule, ready: PreparedColumns) -> list[Alternatives]:
    phase = ready.text(ready.options.phase_column)
    parts = gate_parts(rule, phase, lambda gate: (ready.missing(gate), literal(ready.options.label(gate))))
    alternatives = []
    for name, gates in rule.phase_gates:
        condition = f"({phase} = {literal(name)} AND {some(ready.missing(gate) for gate in gates)})"
        before = f"Missing required gates for phase '{name}': "
        labels = joined(", ", parts[name])
        alternatives.append(Finding(rule, condition, None, Fixed(COMPLETENESS_VALUE), before, DETAIL, detail=labels))
    return [alternatives]


def not_future_findings(rule: Rule, ready: PreparedColumns) -> list[Alternatives]:
    options = ready.options
    today = literal(options.today())
    phase = ready.text(options.phase_column)
    middle = literal(f") is in the future but should be <= today ({options.today().isoformat()}) for phase '")

    def reason(gate: str) -> tuple[str, str]:
        label, day = literal(f"{options.label(gate)} date ("), ready.day(gate)
        return f"{day} > {today}", f"concat({label}, {day}, {middle}, {phase}, {literal(chr(39))})"

    parts = gate_parts(rule, phase, reason)
    alternatives = []
    for name, gates in rule.phase_gates:
        condition = f"({phase} = {literal(name)} AND {some(f'{ready.day(gate)} > {today}' for gate in gates)})"
        reasons = joined("; ", parts[name])
        alternatives.append(Finding(rule, condition, FUTURE_FIELD, Fixed(SEE_EXPLANATION), "", DETAIL, detail=reasons))
    return [alternatives]


def sequence_findings(rule: Rule, ready: PreparedColumns) -> list[Alternatives]:
    label = ready.options.label
    wrong, reasons = [], []
    for earlier, later in zip(rule.sequence, rule.sequence[1:]):
        out_of_order = f"{ready.day(earlier)} >= {ready.day(later)}"
        first, second = literal(f"{label(later)} date ("), literal(f") should be later than {label(earlier)} date (")
        wrong.append(out_of_order)
        reasons.append(
            f"CASE WHEN {out_of_order} THEN concat({first}, {ready.day(later)}, {second}, {ready.day(earlier)}, ')') END"
        )
    return [[Finding(rule, some(wrong), SEQUENCE_FIELD, Fixed(SEE_EXPLANATION), "", DETAIL, detail=joined("; ", reasons))]]


FINDING_BUILDERS: dict[str, Callable[[Rule, PreparedColumns], list[Alternatives]]] = {
    NOT_NULL: not_null_findings,
    POSITIVE_VALUE: positive_value_findings,
    VALUE_IN_LIST: value_in_list_findings,
    GATE_OVERDUE: overdue_findings,
    GATE_COMPLETENESS: completeness_findings,
    GATE_NOT_FUTURE: not_future_findings,
    DATE_SEQUENCE: sequence_findings,
}


def check_rule(rule: Rule, available: Sequence[str], options: RuleOptions) -> bool:
    """Whether the rule can be applied to a table with these columns.

    An absent column or an unknown check type is an error; with `lenient`, an unknown
    check type is only warned about and the rule left out.
    """
    if not rule.known:
        message = f"rule {rule.rule_id}: unknown check type '{rule.check_type}'"
        if not options.lenient:
            raise ValueError(message)
        warnings.warn(message, stacklevel=3)
        return False
    rule.require_columns()
    present = {name.lower() for name in available}
    for name in (options.id_column, options.phase_column, *rule.used_columns()):
        if name.lower() not in present:
            raise ValueError(f"rule {rule.rule_id}: no column '{name}'")
    return True


def row_violations(df: DataFrame, rules: Iterable[Rule], options: RuleOptions = RuleOptions()) -> DataFrame:
    """Violations of all row-level rules: one scan, one explode, no shuffle.

    Rules that need more than one row (uniqueness) are not evaluated here.
    """
    ready = PreparedColumns(options)
    groups = [
        alternatives
        for rule in rules
        if check_rule(rule, df.columns, options) and rule.check_type != UNIQUE
        for alternatives in FINDING_BUILDERS[rule.check_type](rule, ready)
        if alternatives
    ]
    if not groups:
        return no_violations(df, options)
    findings: list[Finding] = []
    parts = parts_of_alternatives(groups, ready, findings)
    checked = ready.apply(df)  # after the findings are built, which ask for columns
    for number, part in enumerate(parts):
        entries = f"array({', '.join(part)})"
        every = "*" if number == 0 else "* EXCEPT (__found)"
        checked = boundary(checked.selectExpr(every, f"{entries if number == 0 else f'concat(__found, {entries})'} AS __found"))
    found = checked.selectExpr("record_id", "phase", "explode_outer(__found) AS __found").where("__found IS NOT NULL")
    whys = list(dict.fromkeys(finding.why for finding in findings))
    why = " ".join(f"WHEN {number} THEN {text}" for number, text in enumerate(whys))

    def of_hit(constants: Iterable[str | int | None]) -> str:
        """The constant the finding's number points at."""
        return f"get(array({', '.join(literal(constant) for constant in constants)}), {HIT})"

    shown = {
        "rule_id": of_hit(finding.rule.rule_id for finding in findings),
        "record_id": "record_id",
        "phase": "phase",
        "failed_field": f"coalesce({of_hit(finding.field for finding in findings)}, {DETAIL})",
        "failed_value": f"coalesce({of_hit(str(f.value) if isinstance(f.value, Fixed) else None for f in findings)}, {SHOWN})",
        "explanation": f"""concat({of_hit(finding.before for finding in findings)},
            CASE {of_hit(whys.index(finding.why) for finding in findings)} {why} END,
            {of_hit(finding.after for finding in findings)})""",
    }
    return found.selectExpr("record_id", "phase", "__found.*").selectExpr(*(f"{shown[name]} AS {name}" for name in shown_columns(options)))


def parts_of_alternatives(groups: Iterable[Alternatives], ready: PreparedColumns, findings: list[Finding]) -> list[list[str]]:
    """Per part of bounded length the entries of its array, NULL where nothing is found. `findings` gets them by number.

    Alternatives are branches of one entry; those that would make their part too long go on in an entry of the next one.
    """
    branches, entries = [], []
    for entry, alternatives in enumerate(groups):
        for finding in alternatives:
            condition = f"{finding.condition} AND {kept_by_phase(finding.rule, ready)}"
            branches.append(f"WHEN {condition} THEN {finding.taken(len(findings), ready.options.explain)}")
            entries.append(entry)
            findings.append(finding)
    numbered = iter(entries)
    parts = []
    for part in parts_of(branches):
        together: dict[int, list[str]] = {}
        for branch in part:
            together.setdefault(next(numbered), []).append(branch)
        parts.append([f"CASE {' '.join(own)} END" for own in together.values()])
    return parts


def shown_columns(options: RuleOptions) -> tuple[str, ...]:
    return VIOLATION_COLUMNS + (("explanation",) if options.explain else ())


def no_violations(df: DataFrame, options: RuleOptions) -> DataFrame:
    """Empty result with the right columns (batch or streaming, as `df` is)."""
    absent = (F.lit(None).cast("string").alias(name) for name in shown_columns(options))
    return df.select(*absent).where(F.lit(False))
