"""Exact amounts from hex or decimal text of any length."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)$"
_SHORT_HEX = r"^0x[0-9a-fA-F]{1,31}$"
_EXPONENT = r"^[+-]?(\d*)\.?(\d*)[eE]([+-]?\d+)$"
#: Digits that a number with an exponent may take when it is written out. ``too_long`` tells the others.
LONGEST = 1_000_000


def _short_hex(col: Column) -> Column:
    # 31 hex digits stay below 10^38: 16 high digits times 2^60, plus 15 low ones
    digits = F.lpad(F.substr(col, F.lit(3)), 31, "0")
    high = F.conv(F.substring(digits, 1, 16), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(digits, 17, 15), 16, 10).cast("decimal(20,0)")
    return (high * F.lit(1 << 60).cast("decimal(19,0)") + low).cast("decimal(38,0)").cast("string")


def too_long(col: Column, longest: int = LONGEST) -> Column:
    """Whether a text is a number whose exponent asks for more than ``longest`` digits: the rows to reject."""
    whole, part = F.regexp_extract(col, _EXPONENT, 1), F.regexp_extract(col, _EXPONENT, 2)
    power = F.regexp_extract(col, _EXPONENT, 3).try_cast("bigint")
    size = F.length(whole) + F.length(part)
    beyond = power.isNull() | (F.abs(power) > 2 * longest + size)  # no sum of it can overflow
    digits = F.when(beyond, longest + 1).otherwise(F.greatest(F.length(whole) + power, F.length(part) - power))
    return F.coalesce(col.rlike(_EXPONENT) & F.concat(whole, part).rlike("[1-9]") & (digits > longest), F.lit(False))


def _any_number(longest: int):
    # a closure, so that executors get it by value and need no copy of this package
    def convert(texts: pd.Series) -> pd.Series:
        import re
        import sys

        if hasattr(sys, "set_int_max_str_digits"):
            sys.set_int_max_str_digits(0)

        def one(text):
            if text is None:
                return None
            if re.fullmatch(r"0x[0-9a-fA-F]+", text):
                return str(int(text[2:], 16))
            found = re.fullmatch(r"([+-]?)(\d*)\.?(\d*)[eE]([+-]?\d+)", text)
            if not found or not found[2] + found[3]:
                return None
            sign, whole, part, power = found[1], found[2], found[3], int(found[4])
            digits = whole + part
            if not digits.strip("0"):
                return "0"
            point = len(whole) + power  # the point stands before this digit
            if max(point, len(digits) - point) > longest:
                return None
            left = digits[: max(point, 0)].ljust(point, "0") or "0"
            right = "0" * max(-point, 0) + digits[max(point, 0) :]
            return sign.strip("+") + left + ("." + right if right else "")

        return pd.Series([one(t) for t in texts], dtype="object")

    return F.pandas_udf(convert, "string")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often the result mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shift(plain: Column, scale: int) -> Column:
    """Divide plain decimal text by ``10^scale`` by moving the point: exact at any length."""
    point = F.instr(plain, ".")
    kept = F.when(point > 0, F.length(plain) - point).otherwise(F.lit(0))
    digits = F.concat(F.repeat(F.lit("0"), F.lit(scale + 1)), F.translate(plain, "+-.", ""))
    negative = F.startswith(plain, F.lit("-")) & plain.rlike("[1-9]")

    def written(p: Column) -> Column:
        left = F.ltrim(F.substr(p.digits, F.lit(1), F.length(p.digits) - p.kept - scale), F.lit("0"))
        right = F.substr(p.digits, F.length(p.digits) - p.kept - scale + 1, p.kept + scale)
        # zeros at the end go, but not those the text came with
        right = F.rpad(F.rtrim(right, F.lit("0")), F.greatest(p.kept, F.length(F.rtrim(right, F.lit("0")))), F.lit("0"))
        return F.concat(
            F.when(p.negative, F.lit("-")).otherwise(F.lit("")),
            F.when(left == "", F.lit("0")).otherwise(left),
            F.when(right == "", F.lit("")).otherwise(F.concat(F.lit("."), right)),
        )

    parts = F.struct(digits.alias("digits"), kept.alias("kept"), negative.alias("negative"))
    return F.when(plain.isNotNull(), _let(parts, written))


def amount(col: Column, scale: int = 0, longest: int = LONGEST) -> Column:
    """Plain decimal text of a number written in ``0x`` hex or decimal, divided by ``10^scale``; NULL gives ``"0"``.

    Up to 31 hex digits and any plain decimal stay JVM-side. Only longer hex and exponent forms visit Python: the
    other rows cross over as NULL. An exponent that asks for more than ``longest`` digits gives NULL, as unreadable text does, so no
    record takes more memory than that; ``too_long`` finds such rows.
    """
    simple = col.rlike(_PLAIN) | col.rlike(_SHORT_HEX)
    plain = (
        F.when(col.rlike(_SHORT_HEX), _short_hex(col))
        .when(col.rlike(_PLAIN), col)
        .otherwise(_any_number(longest)(F.when(~simple, col)))
    )
    return F.when(col.isNull(), F.lit("0")).otherwise(_let(plain, lambda p: _shift(p, scale)))
