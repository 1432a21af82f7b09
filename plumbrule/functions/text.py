"""SQL texts of the value tests. Columns and compiled rules are both built from these.

A rule set can have hundreds of expressions; as SQL text each is one call into the JVM
instead of one per operator.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from plumbrule.constants import DATE_TEXT_LENGTH, NULL_TEXT, SENTINELS


def quoted(name: str) -> str:
    """Back-ticked form of a column name, safe for dots, blanks and back-ticks."""
    escaped = name.replace("`", "``")
    return f"`{escaped}`"


def literal(value: str | int | bool | date | None) -> str:
    """A value as SQL literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, (bool, int)):
        return str(value)
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def listed(values: Iterable[str]) -> str:
    return ", ".join(literal(value) for value in values)


def cleaned(source: str) -> str:
    """Text form without leading and trailing spaces."""
    return f"trim(CAST({source} AS STRING))"


def is_missing(text: str, sentinels: Sequence[str] = SENTINELS) -> str:
    """Trimmed `text` is NULL, blank or a sentinel. Never NULL."""
    return f"({text} IS NULL OR {text} IN ({listed(('', *sentinels))}))"


def present(text: str, sentinels: Sequence[str] = SENTINELS) -> str:
    """Trimmed `text`, or NULL if it is missing."""
    return f"CASE WHEN {text} NOT IN ({listed(('', *sentinels))}) THEN {text} END"


def kind_of_missing(text: str, sentinels: Sequence[str] = SENTINELS) -> str:
    """`NULL`, `blank/empty` or `sentinel date (v)`; NULL if not missing."""
    in_sentinels = f"{text} IN ({listed(sentinels)})" if sentinels else "FALSE"
    return (
        f"CASE WHEN {text} IS NULL THEN {literal(NULL_TEXT)} WHEN {text} = '' THEN 'blank/empty' "
        f"WHEN {in_sentinels} THEN concat('sentinel date (', {text}, ')') END"
    )


def head_of_date(text: str) -> str:
    return f"substring({text}, 1, {DATE_TEXT_LENGTH})"


def date_of(head: str) -> str:
    """Date of the first ten characters in one of the accepted layouts, else NULL.

    The layouts have fixed widths and two orders, year or day first. The text is brought
    into ISO order and cast once, several times faster than a pattern parser per layout.
    """
    year_first = "^[0-9]{4}(-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}$"
    day_first = "^([0-9]{2}-[0-9]{2}-|[0-9]{2}/[0-9]{2}/)[0-9]{4}$"
    turned = f"concat(substring({head}, 7, 4), '-', substring({head}, 4, 2), '-', substring({head}, 1, 2))"
    return (
        f"try_cast(CASE WHEN {head} RLIKE '{year_first}' THEN translate({head}, '/', '-') "
        f"WHEN {head} RLIKE '{day_first}' THEN {turned} END AS DATE)"
    )


def number_of(source: str) -> str:
    """Number or NULL, never an error."""
    return f"try_cast(CAST({source} AS STRING) AS DOUBLE)"


def shown(text: str) -> str:
    """Trimmed `text` for a report; NULL becomes the text `NULL`."""
    return f"coalesce({text}, {literal(NULL_TEXT)})"
