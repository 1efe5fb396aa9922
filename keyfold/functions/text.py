"""Scalar parse functions of the reports (P1-P19), as Spark column expressions.

Each function takes and returns a ``Column``.  ``strict=True`` keeps the
reference behaviour of failing the job on a bad value (ANSI casts and array
indexing raise); ``strict=False`` turns the same failures into nulls with the
``try_*`` twins, which the parse operators use for the null/quarantine modes.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results).
# Quote-aware comma: a comma splits only if an even number of double quotes
# follows it up to the end of the line.
QUOTE_AWARE_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
# One field of such a line, matched left to right: runs of characters other
# than quote and comma, or whole quoted segments, starting at the line start
# or right after a comma.
QUOTED_FIELD = '(?:^|(?<=,))((?:[^",]++|"[^"]*+")*+)'
# Title words are separated by runs of full-width commas and ASCII whitespace;
# the ASCII comma is not a separator.
TITLE_WORD_SEPARATORS = "[，\\s]+"
TITLE_WORD = "[^，\\s]+"
# Unit suffix of the listing unit price, and the "<lifts>梯<households>户" ratio.
UNIT_PRICE_SUFFIX = "元/平"
ELEVATOR_RATIO_PATTERN = "^([0-9]+)梯([0-9]+)户\\z"
# Two-decimal rounding pattern: half-even on the exact binary value.
ROUND2_PATTERN = "#.00"
# ---------------------------------------------------------------------------

# Everything a JVM String.trim() removes: code points U+0000..U+0020.
CTL_CHARS = "".join(chr(c) for c in range(0x21))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ctl_trim(col) -> Column:
    """Trim all control characters and blanks (<= U+0020) at both ends."""
    return F.trim(_c(col), F.lit(CTL_CHARS))


def strip_quotes(col) -> Column:
    """Remove every double quote (a doubled quote inside a field vanishes)."""
    return F.replace(_c(col), F.lit('"'), F.lit(""))


def quote_count(col) -> Column:
    """Number of double quotes (one byte each in UTF-8, so byte lengths do)."""
    return _removed_bytes(col, '"')


def _removed_bytes(col, s: str) -> Column:
    """Bytes taken by the non-overlapping occurrences of ``s`` (no decoding)."""
    c = _c(col)
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(s), F.lit("")))


def simple_quoted(col, min_fields: int = 1, max_fields: int = 20_000) -> Column:
    """True for ``"f0","f1",...,"fn"`` lines whose fields hold no quote.

    Every quote is then a field boundary: the first and the last character,
    and the two quotes of each ``","`` delimiter.  On such lines the split
    rule, the quote removal and a standard CSV parser all agree, so a CSV
    parser may be used.  ``min_fields`` / ``max_fields`` bound the field
    count (the CSV parser has a column limit).  Integer byte arithmetic only:
    with q quotes and d delimiters (3 bytes each), the test is q = 2d + 2.
    """
    c = _c(col)
    quotes, delim_bytes = _removed_bytes(c, '"'), _removed_bytes(c, '","')
    return (c.startswith('"') & c.endswith('"') & ~c.startswith('","') & ~c.endswith('","')
            & (quotes * 3 == delim_bytes * 2 + 6)
            & (delim_bytes >= 3 * (min_fields - 1)) & (delim_bytes <= 3 * (max_fields - 1)))


def quote_split(col) -> Column:
    """Split a line on commas outside double quotes (quotes are kept).

    The defining rule (split where an even number of quotes follows) costs a
    scan to the end of the line at every comma.  When the line holds an even
    number of quotes, "even after" equals "even before", and a single left to
    right pass that matches whole fields gives the same array in linear time
    (possessive runs: no backtracking state per character).
    Lines with an odd number of quotes keep the defining regex.
    """
    c = _c(col)
    fast = F.regexp_extract_all(c, F.lit(QUOTED_FIELD), 1)
    return F.when(quote_count(c) % 2 == 0, fast).otherwise(F.split(c, QUOTE_AWARE_COMMA))


def plain_split(col) -> Column:
    """Remove all quotes first, then split on every comma (booking dialect)."""
    return F.split(strip_quotes(col), ",")


def field(arr, i: int, strict: bool = True) -> Column:
    """Element ``i`` (0-based) of a split line.

    Strict access raises on a short row (ANSI); lenient access gives null.
    """
    arr = _c(arr)
    return arr.getItem(i) if strict else F.try_element_at(arr, F.lit(i + 1))


def digits_only(col) -> Column:
    """Keep ASCII digits only (year label; empty if none)."""
    return F.regexp_replace(_c(col), "[^0-9]", "")


def digits_or_zero(col) -> Column:
    """Digits of the text as an int; 0 when there are none or they overflow."""
    return F.coalesce(digits_only(col).try_cast("int"), F.lit(0))


#: Prices keep six decimals: sums are exact and rounding comes once, at the end.
PRICE_TYPE = "decimal(18,6)"


def to_number(col, type_: str = "double", strict: bool = True) -> Column:
    """A number as written.  A decimal type that can't hold all its decimals
    raises (``strict``) or gives null, as text that is no number does."""
    c = _c(col)
    number = c.cast(type_) if strict else c.try_cast(type_)
    scale = re.fullmatch(r"decimal\(\d+, ?(\d+)\)", type_)
    if not scale:
        return number
    too_fine = c.rlike(rf"\.\d{{{scale[1]}}}0*[1-9]")
    refused = F.raise_error(F.concat(F.lit(f"more decimals than {type_} holds: "), c)) if strict else F.lit(None)
    return F.when(too_fine, refused.cast(type_)).otherwise(number)


def unit_price(col, strip_thousands: bool = False, type_: str = PRICE_TYPE,
               strict: bool = True) -> Column:
    """``12345元/平`` -> number.  ``strip_thousands`` also drops ``,``."""
    c = F.replace(_c(col), F.lit(UNIT_PRICE_SUFFIX), F.lit(""))
    if strip_thousands:
        c = F.replace(c, F.lit(","), F.lit(""))
    return to_number(ctl_trim(c), type_, strict)


#: Ratios keep 18 decimals, so that their sums don't depend on the order of rows.
RATIO_TYPE = "decimal(28,18)"


def elevator_ratio(col) -> Column:
    """``a梯b户`` (whole string) -> a / b; anything else -> 0.

    Zero households or numbers too large for an int also give 0.  The
    anchored pattern yields empty groups on no match, so two extractions
    replace the match test.
    """
    c = _c(col)
    lifts, homes = (F.regexp_extract(c, ELEVATOR_RATIO_PATTERN, i).try_cast("int").cast("decimal(18,0)")
                    for i in (1, 2))
    return F.coalesce(F.try_divide(lifts, homes), F.lit(0)).cast(RATIO_TYPE)


def round2(col) -> Column:
    """Two decimals, half-even on the exact binary value, back to double."""
    return F.call_function("format_number", _c(col), F.lit(ROUND2_PATTERN)).cast("double")


def split_words(col) -> Column:
    """Array of the non-empty title words between full-width comma /
    whitespace runs (the non-empty parts of a split on the separators).

    Matched as runs of non-separators with a pattern compiled once per task;
    ``split`` would compile its regex again for every row.
    """
    return F.regexp_extract_all(_c(col), F.lit(TITLE_WORD), 0)


def hotel_key(hotel, method) -> Column:
    """Display form of the (hotel, booking method) key: ``hotel-method``."""
    return F.concat_ws("-", _c(hotel), _c(method))
