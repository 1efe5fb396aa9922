"""DataFrame operators: line parsing, keyed aggregation, running and latest values."""

from keyfold.operators.parse import (  # noqa: F401
    ON_BAD, drop_headers, parse_listings, parse_listing_rows, parse_bookings,
    apply_on_bad, bad_rows, with_reasons,
)
from keyfold.operators.agg import (  # noqa: F401
    count_by, flag_count_by, sums_by, sum_count_by, mean_by, word_count,
)
from keyfold.operators.running import running_by, latest_by  # noqa: F401
from keyfold.operators.exact import exact_mean_by, exact_running_by, exact_sums  # noqa: F401
from keyfold.operators.partials import merged, partials  # noqa: F401
