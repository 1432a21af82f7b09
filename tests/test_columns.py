"""Column helpers on hand-made edge values, and against a plain restatement of their meaning."""

from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbrule.constants import DATE_FORMATS
from plumbrule.functions import columns as C
from plumbrule.functions.sql import register_sql_functions
from plumbrule.functions.text import literal


def applied(spark, values, build):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row["r"] for row in frame.select("i", build("v").alias("r")).orderBy("i").collect()]


def test_missing(spark):
    values = [None, "", "   ", "01/01/1990", " 1990-01-01 ", "1990/01/01", "x"]
    assert applied(spark, values, C.missing_flag) == [True] * 5 + [False] * 2
    assert applied(spark, values, C.missing_kind) == [
        "NULL", "blank/empty", "blank/empty", "sentinel date (01/01/1990)", "sentinel date (1990-01-01)", None, None,
    ]


def test_only_spaces_are_trimmed(spark):
    assert applied(spark, [" a ", "\ta\t", None], C.clean_text) == ["a", "\ta\t", None]
    assert applied(spark, [" a ", None], C.display_value) == ["a", "NULL"]


def test_dates(spark):
    values = ["2020-02-29", "29/02/2020", "29-02-2020", "2020/02/29", " 2020-02-29 00:00:00", "2020-02-29T1"]
    assert applied(spark, values, C.tolerant_date) == [date(2020, 2, 29)] * 6
    unread = ["2021-02-29", "1/1/1990", "2020-1-1", "2020-01/01", "2020-01-0", "TBC", "", None]
    assert applied(spark, unread, C.tolerant_date) == [None] * len(unread)
    assert applied(spark, ["01/01/1990", "2020-01-01", "TBC", None], C.populated_date) == [False, True, False, False]


DATE_TEXT = st.text(alphabet="0129-/ T", min_size=8, max_size=12)
NEAR_DATE = st.builds(
    lambda y, m, d, form, tail: form.format(y=y, m=m, d=d) + tail,
    st.integers(0, 9999),
    st.integers(0, 13),
    st.integers(0, 32),
    st.sampled_from(["{y:04}-{m:02}-{d:02}", "{d:02}/{m:02}/{y:04}", "{d:02}-{m:02}-{y:04}", "{y:04}/{m:02}/{d:02}", "{y}-{m}-{d}"]),
    st.sampled_from(["", " ", " 00:00", "x"]),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(DATE_TEXT | NEAR_DATE, min_size=20, max_size=60))
def test_dates_agree_with_trying_every_layout(spark, values):
    def every_layout(name):
        head = F.substring(F.trim(F.col(name)), 1, 10)
        return F.coalesce(*(F.try_to_date(head, layout) for layout in DATE_FORMATS)).cast("string")

    # As text, since Python has no year zero.
    expected = applied(spark, values, every_layout)
    assert applied(spark, values, lambda name: C.tolerant_date(name).cast("string")) == expected
    register_sql_functions(spark)
    assert applied(spark, values, lambda name: F.expr(f"CAST(dq_to_date({name}) AS STRING)")) == expected


def test_numbers(spark):
    values = ["7", " 7 ", "1e3", "5d", "1,000", "n/a", "", None]
    assert applied(spark, values, C.safe_double) == [7.0, 7.0, 1000.0, 5.0, None, None, None, None]


def test_names_and_labels(spark):
    odd = spark.createDataFrame([(" a ",)], ["a.b `c`"])
    assert odd.select(C.clean_text("a.b `c`")).first()[0] == "a"
    assert C.gate_label("project_gate_a2_milestone_date") == "GATE A2"


@pytest.mark.parametrize("text", ["it's", "back\\slash", 'say "x"', "", "a{b}$"])
def test_literals_are_quoted(spark, text):
    assert spark.sql(f"SELECT {literal(text)} AS t").first()["t"] == text


def test_skip_phases(spark):
    frame = spark.createDataFrame([("1",), (" 1 ",), ("2",), (None,)], "project_current_phase string")
    assert [r[0] for r in C.skip_phases(frame, ["1"]).collect()] == ["2"]
    assert [r[0] for r in C.skip_phases(frame, ["1"], keep_null_phase=True).collect()] == ["2", None]
    assert C.skip_phases(frame, []).count() == 4


def test_run_date_and_any_of(spark):
    assert C.pinned_date(" 2001-06-01 ") == date(2001, 6, 1)
    one = spark.range(1)
    assert one.select(C.days_overdue("2001-06-01", F.lit(date(2001, 5, 30)))).first()[0] == 2
    assert one.select(C.any_of([])).first()[0] is False
