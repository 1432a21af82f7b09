"""Settings of a rule run that are not part of a single rule."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from plumbrule.constants import ID_COLUMN, PHASE_COLUMN, SENTINELS
from plumbrule.functions.columns import gate_label, pinned_date


@dataclass(frozen=True)
class RuleOptions:
    """How rules are applied to a table.

    run_date:         the "today" of date checks; pin it for repeatable results.
    label:            display name of a gate column.
    keep_null_phase:  keep rows without a phase when a rule skips phases.
    report_unparsed:  let the overdue check also report gate dates it cannot read.
    explain:          build the explanation text (leave out when only keys are compared).
    lenient:          skip rules of unknown check type with a warning instead of failing.
    hot_rows:         copies of one key from which the uniqueness check handles it apart.
    """

    run_date: date | str | None = None
    id_column: str = ID_COLUMN
    phase_column: str = PHASE_COLUMN
    sentinels: tuple[str, ...] = SENTINELS
    label: Callable[[str], str] = gate_label
    keep_null_phase: bool = False
    report_unparsed: bool = False
    explain: bool = True
    lenient: bool = False
    hot_rows: int = 1_000_000

    def today(self) -> date:
        return pinned_date(self.run_date)
