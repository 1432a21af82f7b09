"""The rule model: declarative checks as read from a rules file."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plumbrule.constants import (
    ALLOWED_KEYS,
    CHECK_TYPES,
    COLUMN_KEYS,
    DATE_SEQUENCE,
    DEFAULT_DIMENSION,
    DEFAULT_OVERDUE_DAYS,
    DEFAULT_SEVERITY,
    GATE_COMPLETENESS,
    GATE_NOT_FUTURE,
    GATE_OVERDUE,
    NOT_NULL,
    POSITIVE_VALUE,
    UNIQUE,
    VALUE_IN_LIST,
)

PHASE_MAP_KEYS = {
    GATE_OVERDUE: "phase_to_gate_map",
    GATE_COMPLETENESS: "phase_to_required_gates",
    GATE_NOT_FUTURE: "phase_to_completed_gates",
}


@dataclass(frozen=True)
class Rule:
    """One declarative check. Immutable, small, and held on the driver only."""

    rule_id: str
    name: str
    check_type: str
    description: str = ""
    severity: str = DEFAULT_SEVERITY
    dimension: str = DEFAULT_DIMENSION
    columns: tuple[str, ...] = ()
    allowed: tuple[str, ...] = ()
    skip_phases: tuple[str, ...] = ()
    skip_null: bool = False
    flag_null: bool = False
    phase_gates: tuple[tuple[str, tuple[str, ...]], ...] = ()
    overdue_days: int = DEFAULT_OVERDUE_DAYS
    sequence: tuple[str, ...] = ()
    source: Mapping[str, Any] = field(default_factory=dict, compare=False, repr=False, hash=False)

    @classmethod
    def from_mapping(cls, entry: Mapping[str, Any]) -> Rule:
        """Rule from one entry of a rules file."""
        for key in ("id", "name"):
            if entry.get(key) in (None, ""):
                raise ValueError(f"rule {entry.get('id', '?')}: '{key}' is required")
        rule_id = str(entry["id"])
        parameters = entry.get("parameters") or {}
        rule_first = (entry, parameters)
        parameters_first = (parameters, entry)
        check_type = str(entry.get("check_type") or "")
        columns = names(_first_present(rule_first, COLUMN_KEYS))
        phase_map = parameters.get(PHASE_MAP_KEYS.get(check_type, "")) or {}
        rule = cls(
            rule_id=rule_id,
            name=str(entry["name"]),
            check_type=check_type,
            description=str(entry.get("description") or "").strip(),
            severity=str(entry.get("severity", DEFAULT_SEVERITY)),
            dimension=str(entry.get("dimension", DEFAULT_DIMENSION)),
            columns=columns,
            allowed=names(_first_present(rule_first, ALLOWED_KEYS)),
            skip_phases=names(_first_filled(parameters_first, "skip_phases")),
            skip_null=_flag(rule_id, "skip_null", _first_present(parameters_first, ("skip_null",))),
            flag_null=_flag(rule_id, "flag_null", _first_present(parameters_first, ("flag_null",))),
            phase_gates=tuple((str(phase), names(gates)) for phase, gates in phase_map.items()),
            overdue_days=int(parameters.get("overdue_days", DEFAULT_OVERDUE_DAYS)),
            sequence=names(_first_filled(parameters_first, "sequence")) or columns,
            source=dict(entry),
        )
        rule.require_columns()
        return rule

    def require_columns(self) -> None:
        """Reject a rule that names no column where its check needs one."""
        needs_columns = self.check_type in (NOT_NULL, POSITIVE_VALUE, UNIQUE, VALUE_IN_LIST)
        if needs_columns and not self.columns:
            raise ValueError(f"rule {self.rule_id}: no column given")
        if self.check_type == DATE_SEQUENCE and not self.sequence:
            raise ValueError(f"rule {self.rule_id}: no sequence given")

    @property
    def known(self) -> bool:
        return self.check_type in CHECK_TYPES

    def used_columns(self) -> tuple[str, ...]:
        """Columns the check reads, besides the identifying ones."""
        if self.check_type == NOT_NULL:
            return self.columns
        if self.check_type in (POSITIVE_VALUE, UNIQUE, VALUE_IN_LIST):
            return self.columns[:1]
        if self.check_type in PHASE_MAP_KEYS:
            return tuple(gate for _, gates in self.phase_gates for gate in gates)
        return self.sequence if self.check_type == DATE_SEQUENCE else ()


def names(value: Any) -> tuple[str, ...]:
    """A list, tuple or comma-separated text as a tuple of texts."""
    if value is None:
        return ()
    if isinstance(value, (list, tuple)):
        return tuple(str(item) for item in value)
    return tuple(part for part in (piece.strip() for piece in str(value).split(",")) if part)


def _first_present(sources: Iterable[Mapping[str, Any]], keys: Iterable[str]) -> Any:
    keys = tuple(keys)
    found = (source[key] for source in sources for key in keys if source.get(key) is not None)
    return next(found, None)


def _first_filled(sources: Iterable[Mapping[str, Any]], key: str) -> Any:
    return next((source[key] for source in sources if source.get(key)), None)


def _flag(rule_id: str, key: str, value: Any) -> bool:
    if value is None or isinstance(value, bool):
        return bool(value)
    text = str(value).strip().lower()
    if text in ("true", "false"):
        return text == "true"
    raise ValueError(f"rule {rule_id}: '{key}' must be true or false, not {value!r}")


def make_rules(entries: Iterable[Mapping[str, Any]]) -> list[Rule]:
    """Rules from the entries of a rules file; ids must be unique."""
    rules = [Rule.from_mapping(entry) for entry in entries]
    seen: set[str] = set()
    for rule in rules:
        if rule.rule_id in seen:
            raise ValueError(f"rule {rule.rule_id}: id used more than once")
        seen.add(rule.rule_id)
    return rules


def parse_rules(text: str) -> list[Rule]:
    """Rules from the text of a rules file: YAML, or JSON where no YAML reader is installed."""
    try:
        import yaml
    except ImportError:
        content = json.loads(text)
    else:
        content = yaml.safe_load(text)
    return make_rules(content["rules"])


def rules_table(spark: SparkSession, rules: Iterable[Any]) -> DataFrame:
    """The rules as a DataFrame, for joins. Its size is that of the rules file."""
    listed = list(rules)
    fields = ("rule_id", "rule_name", "check_type", "severity", "dimension")
    values = [[r.rule_id, r.name, r.check_type, r.severity, r.dimension] for r in listed]
    columns = [pa.array([row[i] for row in values], pa.string()) for i in range(len(fields))]
    return spark.createDataFrame(pa.table(columns, names=list(fields)))
