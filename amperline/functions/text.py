"""Text forms of numbers.

The longer expressions are given as SQL text: one parse in the session instead
of a call per node, and easier to read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_sql(x: str) -> str:
    """SQL for the shortest decimal text: ``109`` for 109.0, ``12000000`` for 1.2E7.

    Plain digits are used for magnitudes from 1e-6 up to 1e21, an exponent
    beyond them (``1e+21``, ``5e-7``).  Common values take an early branch.
    """
    text = f"cast({x} AS string)"

    def plain(scale: int) -> str:
        digits = f"cast(try_cast({text} AS decimal(38, {scale})) AS string)"
        return rf"regexp_replace({digits}, r'\.?0+$', '')"

    power = f"substring_index({text}, 'E', -1)"
    return rf"""CASE
      WHEN {x} = 0 THEN '0'
      WHEN NOT contains({text}, 'E') THEN regexp_replace({text}, r'\.0$', '')
      WHEN abs({x}) >= 1E7 AND abs({x}) < 1E21 THEN {plain(16)}
      WHEN abs({x}) >= 1E-6 AND abs({x}) < 1E-3 THEN {plain(24)}
      ELSE concat(regexp_replace(substring_index({text}, 'E', 1), r'\.0$', ''),
        if(startswith({power}, '-'), 'e', 'e+'), {power}) END"""


def number_text(x: str) -> Column:
    """The text as a column, for a double column or SQL expression."""
    return F.expr(number_sql(x))


def number_literal(value: float) -> str:
    """The same text for a constant."""
    return str(int(value)) if float(value).is_integer() and abs(value) < 1e21 else repr(float(value))
