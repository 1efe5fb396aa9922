"""Column functions (``Column -> Column``): every scalar step of the reports.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; no Python UDF is involved anywhere in the parse path.
"""

from keyfold.functions.text import (  # noqa: F401
    CTL_CHARS, QUOTE_AWARE_COMMA, TITLE_WORD_SEPARATORS, TITLE_WORD,
    ctl_trim, strip_quotes, quote_split, plain_split, field, digits_only,
    digits_or_zero, to_number, unit_price, elevator_ratio, round2,
    split_words, hotel_key,
)
