import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from keyfold.session import local_session
    s = local_session("*", partitions=8, app="keyfold-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test data not present")
    return SF_SMALL


def listing_line(**fields):
    """A quoted listing line with every unnamed field set to ``x``."""
    from keyfold.schema import LISTING_COLUMNS
    vals = [fields.get(c, "x") for c in LISTING_COLUMNS]
    return ",".join(f'"{v}"' for v in vals)


def booking_line(**fields):
    from keyfold.schema import BOOKING_COLUMNS
    defaults = {"hotel": '"City Hotel"', "is_canceled": "0", "arrival_date_month": "1",
                "nights": "1", "country": '"C1"', "booking_method": '"Direct"', "adr": "10.00"}
    vals = [str(fields.get(c, defaults.get(c, "x"))) for c in BOOKING_COLUMNS]
    return ",".join(vals)
