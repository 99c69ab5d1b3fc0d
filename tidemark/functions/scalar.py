"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column, den: Column, default: float | None = None) -> Column:
    """``num / den`` as a double; a zero or null denominator yields ``default``."""
    quotient = F.try_divide(num.cast("double"), den.cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(float(default)))


def positive_ratio(num: Column, den: Column, default: float) -> Column:
    """``num / den`` where ``den > 0``, otherwise ``default``."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(float(default)))


def missing_to_null(c: Column) -> Column:
    """One missing value for floating columns: NaN becomes NULL."""
    return F.when(~F.isnan(c), c)


def clamp_low(c: Column, low: float = 0.0) -> Column:
    return F.greatest(c, F.lit(low))


def truncated_int(c: Column) -> Column:
    """Truncate toward zero, like a plain integer conversion."""
    return c.cast("bigint")


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Case-insensitive test for any of several plain words."""
    lowered = F.lower(c)
    hit = F.lit(False)
    for word in words:
        hit = hit | lowered.contains(word)
    return hit


def replace_char(c: Column, position: Column, char: str = "X") -> Column:
    """Overwrite the character at a 1-based position."""
    return F.overlay(c, F.lit(char), position.cast("int"))


def fixed(c: Column, digits: int = 3) -> Column:
    """Fixed-point text rounded on the exact binary value, ties to even."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", c, F.lit(pattern))


def signed(c: Column, digits: int = 3) -> Column:
    text = fixed(c, digits)
    return F.when(F.startswith(text, F.lit("-")), text).otherwise(F.concat(F.lit("+"), text))


def percent(c: Column, digits: int = 1) -> Column:
    return F.concat(fixed(c * 100, digits), F.lit("%"))


def map_get(map_col: Column | str, key: str, default: Column | None = None) -> Column:
    """Value of ``key`` or ``default`` when the key is absent or null."""
    value = F.try_element_at(col(map_col), F.lit(key))
    return value if default is None else F.coalesce(value, default)


def lookup(c: Column, table: Mapping[str, object], default: object = None) -> Column:
    """Constant-table lookup as one map literal."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), c)
    return found if default is None else F.coalesce(found, F.lit(default))


def to_number(c: Column) -> Column:
    """Numeric coercion; unparsable text becomes NULL."""
    return missing_to_null(c.try_cast("double"))


def hours_between(later: Column, earlier: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(3.6e9)


def flag_list(pairs: Sequence[tuple[str, Column]]) -> Column:
    """Array of the names whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in pairs]))
