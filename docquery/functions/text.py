"""Text helpers as built-in column expressions."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip removes, and the line
# breaks other than a newline that a Unicode-aware line split honours.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
OTHER_LINE_BREAK = r"\r\n|[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

# A word for lexical scoring and hashing: a run of letters and digits.
WORD = r"[\p{L}\p{N}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times inside `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def unix_lines(text: Column) -> Column:
    """Every kind of line break as a plain newline."""
    return F.regexp_replace(text, OTHER_LINE_BREAK, "\n")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def three_decimals(number: Column) -> Column:
    """`0.000` form, rounding half to even on the exact binary value."""
    return F.call_function("format_number", number, F.lit("0.000"))
