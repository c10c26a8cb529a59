import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from volspark.session import local_session

    s = local_session("*", shuffle_partitions=8, app="volspark-tests")
    yield s
    s.stop()


def book_rows(stock, time_id, prices, start=0, size=1.0):
    """Raw book rows whose weighted price equals ``prices[i]`` at second start+i."""
    rows = []
    for i, p in enumerate(prices):
        rows.append((int(time_id), start + i, p, p, p, p, size, size, size, size, stock))
    return rows


BOOK_SCHEMA = (
    "time_id bigint, seconds_in_bucket int, bid_price1 double, ask_price1 double, bid_price2 double, "
    "ask_price2 double, bid_size1 double, ask_size1 double, bid_size2 double, ask_size2 double, stock_id string"
)
