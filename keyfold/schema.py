"""Column layouts of the two line formats and the keys of every result table."""

from __future__ import annotations

# Column order of the listing lines (ordinal 0 is the id, whose
# quoted name also marks header lines) and of the booking lines (ordinals
# 2, 3, 5-7 and 11-17 are never read and get filler names c2..c17).
LISTING_COLUMNS = [
    "id", "title", "url", "price", "unit_price", "focus", "layout", "floor",
    "orientation", "decoration", "area", "year_built", "community", "district",
    "neighborhood", "elevator", "elevator_ratio", "post_date", "update_date",
]
BOOKING_KNOWN = {
    0: "hotel", 1: "is_canceled", 4: "arrival_date_month", 8: "nights",
    9: "country", 10: "booking_method", 18: "adr",
}
BOOKING_COLUMNS = [BOOKING_KNOWN.get(i, f"c{i}") for i in range(19)]

LISTING_HEADER_PREFIX = '"id"'
BOOKING_HEADER_PREFIX = '"hotel"'

# Result tables: name -> (key columns, value columns), as the reports emit them.
RESULT_TABLES = {
    "district_stats": (["district"], ["house_count"]),
    "neighborhood_avg_price": (["neighborhood"], ["avg_price", "count"]),
    "year_avg_elevator_ratio": (["year_built"], ["avg_elevator_ratio", "count"]),
    "orientation_focus_count": (["orientation"], ["total_focus", "count"]),
    "word_count": (["word"], ["count"]),
    "hotel_statistics": (["hotel_type"], ["booking_count", "canceled_count", "actual_stay_count"]),
    "monthly_booking_counts": (["month", "hotel_type"], ["booking_count"]),
    "country_statistics": (["country"], ["visitor_count"]),
    "booking_method_statistics": (["hotel_type", "booking_method"], ["booking_count"]),
    "monthly_avg_adr": (["month"], ["avg_adr"]),
}


def keys_of(table: str) -> list[str]:
    return list(RESULT_TABLES[table][0])
