"""Copies on the bus."""

import pytest

from roadlake.operators import inventory


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (1, 0, 2, 3), (0, 2, 1, 3)])
def test_repeats_of_one_position_do_not_hang_on_the_order_of_reading(spark, order):
    """Two messages and a copy at one position, and a copy behind them."""
    a, b = ("s", 0, 1, 0, "aa"), ("s", 0, 2, 0, "bb")
    rows = [(*a, 10), (*b, 10), (*a, 10), (*a, 20)]
    messages = spark.createDataFrame([rows[k] for k in order], "session string, base_us long, can_id long, dt_us long, data_hex string, position long").coalesce(1)
    assert [tuple(r) for r in inventory.repeat_order(messages, "position").collect()] == [("s", 1, 1)]
