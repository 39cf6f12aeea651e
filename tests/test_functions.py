"""Text, parsing and rounding expressions, one value at a time."""

from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopstrata.functions import parse, rounding, text


def values(spark, expression, cells, kind="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r["v"] for r in df.selectExpr("i", f"{expression} AS v").orderBy("i").collect()]


def test_whitespace_is_pythons():
    assert set(text.WHITESPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_strip_equals_python(spark):
    cells = [f"{c} a b {c}" for c in text.WHITESPACE] + ["", " ", "x", "​x", None]
    assert values(spark, text.strip("c"), cells) == [c and c.strip() for c in cells]


def test_missing_tokens(spark):
    cells = [*text.NULL_TOKENS, None, "NAN", " nan", "none", "x"]
    found = values(spark, text.cell("c"), cells)
    assert found == [None] * (len(text.NULL_TOKENS) + 1) + ["NAN", " nan", "none", "x"]
    present = values(spark, text.present("c"), cells)
    assert present == [v is not None for v in found]


def test_label(spark):
    assert values(spark, text.label("c"), [" Completed\t", "SHIPPED", "nan", None]) == [
        "completed",
        "shipped",
        None,
        None,
    ]


def test_money(spark):
    cells = ["1.5", "12.345", "-3", "abc", "nan", "", None, "1e2", " 7.10 "]
    expected = ["1.50", "12.35", "-3.00", None, None, None, None, "100.00", "7.10"]
    found = values(spark, parse.money("c"), cells)
    assert found == [e and Decimal(e) for e in expected]


def test_whole(spark):
    cells = ["2", "2.0", "2.9", "-2.9", "x", "nan", "", None, "99999999999"]
    assert values(spark, parse.whole("c"), cells) == [2, 2, 2, -2, None, None, None, None, None]


def test_number_has_no_nan(spark):
    assert values(spark, parse.number("c"), ["5", "nan", "NaN", "x", None]) == [
        5.0,
        None,
        None,
        None,
        None,
    ]


def test_day(spark):
    cells = ["2024-02-29", "2024-02-30", "bad-date", "2024-1-5", "2024", "20240105", None, "nan"]
    found = values(spark, parse.day("c"), cells)
    assert [d and d.isoformat() for d in found] == ["2024-02-29"] + [None] * 7


def test_flag(spark):
    assert values(spark, parse.flag("c"), ["True", "False", "maybe", None]) == [
        True,
        False,
        None,
        None,
    ]


PAIRS = [(7, 80), (1, 16), (-7, 80), (7, -80), (0, 5), (1, 3), (2, 3), (5, 0), (None, 3), (3, None)]


def _ratio(num, den, digits, mode):
    if num is None or not den:
        return None
    exact = Decimal(num) * 10**digits / Decimal(den)
    whole = exact.to_integral_value(mode)
    return whole.scaleb(-digits)


@pytest.mark.parametrize("digits", [0, 1, 2])
@pytest.mark.parametrize(
    "ratio, mode",
    [(rounding.ratio_half_up, ROUND_HALF_UP), (rounding.ratio_half_even, ROUND_HALF_EVEN)],
)
def test_ratios(spark, ratio, mode, digits):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(PAIRS)], "i int, n long, d long")
    rows = df.selectExpr("i", f"{ratio('n', 'd', digits)} AS v").orderBy("i").collect()
    assert [r["v"] for r in rows] == [_ratio(n, d, digits, mode) for n, d in PAIRS]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**9)), min_size=50))
def test_half_up_on_many_numbers(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, n long, d long")
    rows = df.selectExpr("i", f"{rounding.ratio_half_up('n', 'd', 2)} AS v").orderBy("i").collect()
    assert [r["v"] for r in rows] == [_ratio(n, d, 2, ROUND_HALF_UP) for n, d in pairs]


def test_ties(spark):
    df = spark.range(1)
    up = df.selectExpr(f"{rounding.percent('7', '80')}", f"{rounding.percent('1', '16')}").first()
    assert [str(v) for v in up] == ["8.8", "6.3"]
    even = df.selectExpr(rounding.ratio_half_even("100", "16", 1)).first()
    assert str(even[0]) == "6.2"
    mean = df.selectExpr(rounding.average_money("CAST(0.05 AS DECIMAL(28,2))", "2")).first()
    assert str(mean[0]) == "0.03"
