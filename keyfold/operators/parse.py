"""Line -> typed row parsing for listings and bookings.

Each line is split into fields once -- by Spark's CSV parser when its only
quotes are field boundaries, else by the exact quote-aware split -- and then
converted to one typed column per field the reports read.  Unused columns are
pruned by Catalyst, so a report that needs two fields only pays for the split
and those two conversions.

Bad-row policy (``on_bad``):

* ``"fail"``       -- reference behaviour: a short row or an unparsable number
  raises (ANSI cast / array index errors) and the job fails.
* ``"null"``       -- the offending value becomes null; the row is kept.
* ``"quarantine"`` -- rows with a null in any field the report needs are left
  out of the report; :func:`bad_rows` returns exactly those raw lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.functions import text as T
from keyfold.schema import (
    BOOKING_COLUMNS, BOOKING_HEADER_PREFIX, LISTING_COLUMNS, LISTING_HEADER_PREFIX,
)

ON_BAD = ("fail", "null", "quarantine")

_LISTING_DDL = ", ".join(f"`{c}` STRING" for c in LISTING_COLUMNS)
# Quoted empty fields stay empty strings; no value is read as null (the
# fast path only sees fields without quotes, so a quote never equals one).
_CSV_OPTS = {"sep": ",", "quote": '"', "escape": '"', "nullValue": '"',
             "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false", "mode": "PERMISSIVE"}


def _check(on_bad: str) -> bool:
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}, got {on_bad!r}")
    return on_bad == "fail"


def drop_headers(lines: DataFrame, prefix: str, col: str = "value") -> DataFrame:
    """Drop every line that starts with the quoted first column name."""
    return lines.filter(~F.col(col).startswith(prefix))


def _listing_typed(raw, strict: bool, strip_thousands: bool, price_type: str,
                   title: Column) -> dict[str, Column]:
    return {
        "id": raw("id"),
        "title": title,
        "unit_price": T.unit_price(raw("unit_price"), strip_thousands, price_type, strict),
        "focus": T.digits_or_zero(raw("focus")),
        "orientation": T.ctl_trim(raw("orientation")),
        "year_built": T.digits_only(raw("year_built")),
        "district": raw("district"),
        "neighborhood": raw("neighborhood"),
        "elevator_ratio": T.elevator_ratio(raw("elevator_ratio")),
    }


def _kept(col: str, keep_line: bool, keep: Sequence[str]) -> list[str]:
    names = [col] if keep_line else []
    return names + [k for k in keep if k not in names]


def parse_listings(lines: DataFrame, on_bad: str = "fail", strip_thousands: bool = False,
                   price_type: str = T.PRICE_TYPE, col: str = "value",
                   keep_line: bool = False, keep: Sequence[str] = (),
                   csv_fast_path: bool = True, fields: str | None = None) -> DataFrame:
    """Listing text lines -> typed listing rows.

    Columns: id, title, unit_price, focus, orientation, year_built, district,
    neighborhood, elevator_ratio (and the raw ``value`` if ``keep_line``, and
    any input columns named in ``keep``, e.g. an arrival-order column).
    The title keeps the reference guard: a line with a single field has a null
    title (skipped by the word count) instead of failing.

    ``fields`` names a column for the number of fields the line has.
    ``csv_fast_path`` sends lines whose only quotes are field boundaries
    through Spark's CSV parser (about twice as fast as the split); results
    are identical either way.
    """
    strict = _check(on_bad)
    body = drop_headers(lines, LISTING_HEADER_PREFIX, col)
    v, f, ok, rec = F.col(col), F.col("_f"), F.col("_ok"), F.col("_csv")

    def raw(name: str) -> Column:
        slow = T.strip_quotes(T.field(f, LISTING_COLUMNS.index(name), strict))
        return F.when(ok, rec.getField(name)).otherwise(slow)

    title = F.when(ok, T.ctl_trim(rec.getField("title"))).otherwise(
        F.when(F.size(f) > 1, T.ctl_trim(T.strip_quotes(f.getItem(1)))))
    typed = _listing_typed(raw, strict, strip_thousands, price_type, title)
    keep = _kept(col, keep_line, keep)
    # Fast path: well-formed all-quoted lines go through the CSV parser; every
    # other line through the exact split.  Each branch runs only for its rows.
    first = keep if col in keep else [*keep, col]
    use_csv = T.simple_quoted(v, len(LISTING_COLUMNS)) if csv_fast_path else F.lit(False)
    return body.select(*first, use_csv.alias("_ok")) \
        .select(*keep, "_ok",
                F.when(ok, F.from_csv(v, _LISTING_DDL, _CSV_OPTS)).alias("_csv"),
                F.when(~ok, T.quote_split(v)).alias("_f")) \
        .select(*keep, *[c.alias(n) for n, c in typed.items()],
                *([F.when(ok, F.lit(len(LISTING_COLUMNS))).otherwise(F.size(f)).alias(fields)] if fields else []))


def parse_listing_rows(rows: DataFrame, on_bad: str = "fail", strip_thousands: bool = True,
                       price_type: str = T.PRICE_TYPE) -> DataFrame:
    """Named listing columns (e.g. a JDBC table without ``id``) -> typed rows.

    Same typed columns as :func:`parse_listings`; thousands separators in the
    unit price are removed by default, as the database variant does.
    """
    strict = _check(on_bad)

    def raw(name: str) -> Column:
        if name not in rows.columns:  # raises where a report uses it, whatever on_bad says
            return F.raise_error(F.lit(f"no column {name} in the listing rows")).cast("string")
        return F.col(name).cast("string")

    typed = _listing_typed(raw, strict, strip_thousands, price_type, T.ctl_trim(raw("title")))
    if strict:
        # A null in a used field raises in the reference; keep that as a check.
        for name in ("unit_price", "neighborhood"):
            typed[name] = F.when(raw(name).isNull(),
                                 F.raise_error(F.lit(f"null {name} in listing row"))) \
                .otherwise(typed[name])
    return rows.select(*[c.alias(n) for n, c in typed.items()])


def parse_bookings(lines: DataFrame, on_bad: str = "fail", dialect: str = "plain",
                   price_type: str = T.PRICE_TYPE, col: str = "value",
                   keep_line: bool = False, keep: Sequence[str] = (), fields: str | None = None) -> DataFrame:
    """Booking text lines -> typed booking rows.

    ``dialect="plain"`` is the reference rule: remove every quote, then split
    on every comma (a quoted comma shifts the columns).  ``"quoted"`` splits on
    commas outside quotes first.  All fields are trimmed of control characters.
    ``fields`` names a column for the number of fields the line has.
    """
    strict = _check(on_bad)
    if dialect not in ("plain", "quoted"):
        raise ValueError("dialect must be 'plain' or 'quoted'")
    body = drop_headers(lines, BOOKING_HEADER_PREFIX, col)
    split = T.plain_split(F.col(col)) if dialect == "plain" else T.quote_split(F.col(col))
    f = F.col("_f")

    def raw(name: str) -> Column:
        v = T.field(f, BOOKING_COLUMNS.index(name), strict)
        v = v if dialect == "plain" else T.strip_quotes(v)
        return T.ctl_trim(v)

    typed = {
        "hotel": raw("hotel"),
        "is_canceled": T.to_number(raw("is_canceled"), "int", strict),
        "arrival_date_month": T.to_number(raw("arrival_date_month"), "int", strict),
        "nights": T.to_number(raw("nights"), "int", strict),
        "country": raw("country"),
        "booking_method": raw("booking_method"),
        "adr": T.to_number(raw("adr"), price_type, strict),
    }
    keep = _kept(col, keep_line, keep)
    return body.select(*keep, split.alias("_f")) \
        .select(*keep, *[c.alias(n) for n, c in typed.items()],
                *([F.size(f).alias(fields)] if fields else []))


def apply_on_bad(rows: DataFrame, needed: Sequence[str], on_bad: str) -> DataFrame:
    """Drop rows with a null in a needed field when quarantining."""
    _check(on_bad)
    if on_bad == "quarantine":
        return rows.dropna(how="any", subset=list(needed))
    return rows


def bad_rows(lines: DataFrame, kind: str, needed: Sequence[str], col: str = "value",
             **parse_opts) -> DataFrame:
    """Raw lines a report would quarantine (a needed field does not parse)."""
    parse = parse_listings if kind == "listing" else parse_bookings
    typed = parse(lines, on_bad="null", col=col, keep_line=True, **parse_opts)
    cond = F.lit(False)
    for n in needed:
        cond = cond | F.col(n).isNull()
    return typed.filter(cond).select(col)


#: Why a line has no value for a field: it has too few fields, or what stands there can't be read.
MISSING, UNREADABLE = "missing", "unreadable"


def with_reasons(lines: DataFrame, kind: str, needed: Sequence[str], col: str = "value", **parse_opts) -> DataFrame:
    """``needed`` typed columns, ``reasons`` and, for a line with any, the line itself.

    ``reasons`` is an array of ``missing:<field>`` and ``unreadable:<field>``
    for the needed fields without a value, in their order; empty for a good line.
    """
    parse, columns = (parse_listings, LISTING_COLUMNS) if kind == "listing" else (parse_bookings, BOOKING_COLUMNS)
    typed = parse(lines, on_bad="null", col=col, keep_line=True, fields="_fields", **parse_opts)
    why = [F.when(F.col(n).isNull(), F.when(F.col("_fields") <= columns.index(n), F.lit(f"{MISSING}:{n}")).otherwise(F.lit(f"{UNREADABLE}:{n}"))) for n in needed]
    rows = typed.select(*needed, F.array_compact(F.array(*why)).alias("reasons"), F.col(col))
    return rows.withColumn(col, F.when(F.size("reasons") > 0, F.col(col)))
