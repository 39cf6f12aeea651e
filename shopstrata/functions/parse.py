"""Text to typed values where a bad value becomes NULL instead of an error.

Spark runs in ANSI mode, so only the ``try_`` forms are used. The tokens that mean "missing"
fail to parse like any other bad text and need no test of their own here.
"""

from __future__ import annotations

from datetime import datetime

MONEY = "DECIMAL(18,2)"
AMOUNT = "DECIMAL(18,4)"


def money(text: str) -> str:
    """Exact two-digit money; text such as ``nan`` or ``abc`` gives NULL, never NaN."""
    return f"try_cast({text} AS {MONEY})"


def amount(text: str) -> str:
    """An exact quantity that may have a fraction, to four digits."""
    return f"try_cast({text} AS {AMOUNT})"


def number(text: str) -> str:
    """A double; NaN, which ``try_cast`` accepts as text, becomes NULL."""
    return f"nanvl(try_cast({text} AS DOUBLE), CAST(NULL AS DOUBLE))"


def whole(text: str) -> str:
    """An integer that also accepts ``2.0``; the fraction is cut off."""
    return f"try_cast(try_cast({text} AS DECIMAL(20,4)) AS INT)"


def day(text: str) -> str:
    """A date in the fixed form yyyy-MM-dd. The cast is much cheaper than a pattern parser,
    and the LIKE guard keeps the looser forms that it accepts (2024-1-5, 2024) out."""
    return f"CASE WHEN {text} LIKE '____-__-__' THEN try_cast({text} AS DATE) END"


def flag(text: str) -> str:
    """A boolean."""
    return f"try_cast({text} AS BOOLEAN)"


def instant(time: datetime) -> str:
    """A timestamp literal, read in the session's time zone unless ``time`` has its own."""
    return f"TIMESTAMP '{time.isoformat(sep=' ')}'"
