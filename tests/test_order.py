"""Queries whose result has an order: rows come in it, which a comparison of rows without order does not see."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def last_first(value):
    """Sorts a value downwards, NULL last."""
    return (value is None, -value if value is not None else 0)


ORDERS = {
    "a5_frequency": lambda r: -r.cnt,
    "a13_average_by_group": lambda r: (last_first(r.avg_price), r.brand),
    "a21_mart_rollups": lambda r: (r.time_grain, r.period_start is None, r.period_start or ""),
    "t3k_longest_trips": lambda r: last_first(r.trip_distance),
    "t4k_multi_key_sort": lambda r: (r.month_start is not None, r.month_start or "", r.zone or ""),
    "t5k_boolean_sort": lambda r: last_first(r.is_hail),
    "t6k_first_rows": lambda r: r.o_orderkey,
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, name):
    rows = entry.queries()[name](spark, SF).collect()
    assert rows and rows == sorted(rows, key=ORDERS[name])
