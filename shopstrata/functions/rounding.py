"""Exact ratios: integer arithmetic on decimals, rounded once.

Both arguments are whole numbers (counts, or money in cents). The result is NULL when the
divisor is NULL or zero. Binary floating point is avoided because a tie such as 8.75 must
round the same way on every engine and for every order of summation.
"""

from __future__ import annotations

_WIDE = "DECIMAL(30,0)"


def cents(amount: str) -> str:
    """Money as a whole number of cents."""
    return f"CAST(({amount}) * 100 AS {_WIDE})"


def _signed(units: str, num: str, den: str, digits: int) -> str:
    sign = f"CASE WHEN (({num}) < 0) <> (({den}) < 0) THEN -1 ELSE 1 END"
    return (
        f"CAST(CAST({units} AS DECIMAL(20,0)) * {sign} * CAST('1e-{digits}' AS "
        f"DECIMAL({digits + 1},{digits})) AS DECIMAL(24,{digits}))"
    )


def _sizes(num: str, den: str, digits: int) -> tuple[str, str]:
    top = f"(abs(CAST({num} AS {_WIDE})) * {10 ** digits})"
    bottom = f"abs(nullif(CAST({den} AS {_WIDE}), 0))"
    return top, bottom


def ratio_half_up(num: str, den: str, digits: int) -> str:
    """``num / den`` with ties rounded away from zero, as SQL ``ROUND`` on exact numbers does."""
    top, bottom = _sizes(num, den, digits)
    return _signed(f"(({top} * 2 + {bottom}) div ({bottom} * 2))", num, den, digits)


def ratio_half_even(num: str, den: str, digits: int) -> str:
    """``num / den`` with ties rounded to the even neighbour, as Python's ``round`` does."""
    top, bottom = _sizes(num, den, digits)
    units, rest = f"({top} div {bottom})", f"(({top} % {bottom}) * 2)"
    up = f"({rest} > {bottom} OR ({rest} = {bottom} AND {units} % 2 = 1))"
    return _signed(f"({units} + CAST({up} AS BIGINT))", num, den, digits)


def average_money(total: str, rows: str) -> str:
    """Mean of a money column from its sum and count, to two digits."""
    return ratio_half_up(cents(total), f"({rows}) * 100", 2)


def percent(part: str, of: str) -> str:
    """``100 * part / of`` to one digit."""
    return ratio_half_up(f"({part}) * 100", of, 1)


# Bits of the lower half of a number that is summed as two.
_LOW = 28


def halves(value: str, name: str, digits: int) -> list[str]:
    """Aggregates that sum a DECIMAL(18, ``digits``) exactly as two integers, which :func:`whole_sum` joins.

    A sum of decimals travels in 32 bytes, most of them empty. Two integers take half of that; like any sum they
    are an error, not a wrong value, where they overflow: after billions of the largest rows.
    """
    units = f"CAST(({value}) * {10 ** digits}BD AS BIGINT)"
    return [
        f"sum(shiftright({units}, {_LOW})) AS {name}_high",
        f"sum({units} & {2 ** _LOW - 1}L) AS {name}_low",
    ]


def whole_sum(name: str, digits: int) -> str:
    """The sum of :func:`halves` as DECIMAL(28, ``digits``), as ``sum`` gives it."""
    units = f"(CAST({name}_high AS DECIMAL(20,0)) * {2 ** _LOW}BD + CAST({name}_low AS DECIMAL(20,0)))"
    return f"CAST({units} * {10 ** -digits:.{digits}f}BD AS DECIMAL(28,{digits})) AS {name}"
