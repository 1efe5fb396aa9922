"""Report plans (J1-J14): each is a ``DataFrame -> DataFrame`` function."""

from keyfold.plans.reports import (  # noqa: F401
    REPORTS, Report, run_report,
    district_stats, neighborhood_avg_price, year_avg_elevator_ratio,
    orientation_focus_count, title_word_count, hotel_statistics,
    monthly_booking_counts, country_statistics, booking_method_statistics,
    monthly_avg_adr, booking_reports, one_report,
)
