"""Column building blocks: helpers that turn a column name into a Column.

All of them are built-in JVM expressions, so they stay inside whole-stage code
generation and work the same on batch and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrule.constants import GATE_LABEL_REPLACEMENTS, PHASE_COLUMN, SENTINELS
from plumbrule.functions import text
from plumbrule.functions.text import quoted

ColumnOrName = Column | str


def column(name: ColumnOrName) -> Column:
    """A top-level column by its literal name (dots do not mean struct access)."""
    return name if isinstance(name, Column) else F.col(quoted(name))


def clean_text(name: str) -> Column:
    """Text form without leading and trailing spaces."""
    return F.expr(text.cleaned(quoted(name)))


def missing_flag(name: str, sentinels: Sequence[str] = SENTINELS) -> Column:
    """NULL, blank after trimming, or a sentinel. Never NULL itself."""
    return F.expr(text.is_missing(text.cleaned(quoted(name)), sentinels))


def missing_kind(name: str, sentinels: Sequence[str] = SENTINELS) -> Column:
    """How a value is missing: `NULL`, `blank/empty`, `sentinel date (v)`; NULL if it is not."""
    return F.expr(text.kind_of_missing(text.cleaned(quoted(name)), sentinels))


def tolerant_date(name: str) -> Column:
    """Date in one of the accepted layouts from the first ten characters; NULL otherwise."""
    return F.expr(text.date_of(text.head_of_date(text.cleaned(quoted(name)))))


def populated_date(name: str, sentinels: Sequence[str] = SENTINELS) -> Column:
    """Present and readable as a date."""
    return ~missing_flag(name, sentinels) & tolerant_date(name).isNotNull()


def safe_double(name: str) -> Column:
    """Number or NULL, never an error."""
    return F.expr(text.number_of(quoted(name)))


def display_value(name: str) -> Column:
    """Trimmed value for a report; NULL becomes the text `NULL`."""
    return F.expr(text.shown(text.cleaned(quoted(name))))


def gate_label(name: str) -> str:
    """Readable label of a gate column name (a driver-side helper on names, not on data)."""
    for part, replacement in GATE_LABEL_REPLACEMENTS:
        name = name.replace(part, replacement)
    return name.upper()


def gate_label_column(
    c: ColumnOrName,
    replacements: Iterable[tuple[str, str]] = GATE_LABEL_REPLACEMENTS,
) -> Column:
    """`gate_label` for names held as data."""
    label = column(c)
    for part, replacement in replacements:
        label = F.replace(label, F.lit(part), F.lit(replacement))
    return F.upper(label)


def run_date_column(run_date: date | str | None = None) -> Column:
    """The pinned "today" as a literal; the current date if none is given."""
    if run_date is None:
        return F.current_date()
    return F.lit(pinned_date(run_date))


def pinned_date(run_date: date | str | None = None) -> date:
    """A run date given as date or ISO text; today if none is given."""
    if run_date is None:
        return date.today()
    return date.fromisoformat(run_date.strip()) if isinstance(run_date, str) else run_date


def days_overdue(run_date: date | str | None, day: Column) -> Column:
    """Days from `day` to the run date; negative when `day` lies ahead."""
    return F.datediff(run_date_column(run_date), day)


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of the conditions; false for none."""
    return reduce(or_, conditions, F.lit(False))


def phase_kept(
    skip: Iterable[str],
    phase_column: str = PHASE_COLUMN,
    keep_null_phase: bool = False,
) -> Column:
    """True where the trimmed phase is not skipped. A NULL phase is dropped unless asked for."""
    skip = list(skip)
    if not skip:
        return F.lit(True)
    return F.coalesce(~clean_text(phase_column).isin(*skip), F.lit(keep_null_phase))


def skip_phases(
    df: DataFrame,
    skip: Iterable[str],
    phase_column: str = PHASE_COLUMN,
    keep_null_phase: bool = False,
) -> DataFrame:
    """Rows whose phase is not in `skip`."""
    skip = list(skip)
    return df.where(phase_kept(skip, phase_column, keep_null_phase)) if skip else df
