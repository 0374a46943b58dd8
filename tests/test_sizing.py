"""Broadcast bounds and key checks (operators/sizing)."""

from __future__ import annotations

import pytest

from tillroll.errors import DuplicateKeyError
from tillroll.operators import sizing


def hinted(df) -> bool:
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_bounded_counts_stop_at_the_cap(spark):
    big, small, empty = spark.range(1000), spark.range(3), spark.range(0)
    assert sizing.bounded_counts([big, small, empty], 10) == [11, 3, 0]
    assert sizing.has_at_most(small, 3) and not sizing.has_at_most(big, 999)


def test_broadcast_only_within_the_bound(spark):
    big, small = spark.range(100), spark.range(5)
    out_big, out_small = sizing.broadcast_small([big, small], max_rows=10)
    assert hinted(out_small) and not hinted(out_big)


def test_session_bound_is_used(spark):
    spark.conf.set(sizing.CONF_BROADCAST_ROWS, "2")
    try:
        assert not hinted(sizing.broadcast_if_small(spark.range(3)))
        assert hinted(sizing.broadcast_if_small(spark.range(2)))
    finally:
        spark.conf.unset(sizing.CONF_BROADCAST_ROWS)


def test_bytes_are_bounded_too(spark):
    wide = spark.createDataFrame([("x" * 1000,), (None,)], "s string")
    assert sizing.bounded_sizes([wide], 10) == [(2, 1016)]
    spark.conf.set(sizing.CONF_BROADCAST_BYTES, "1000")
    try:
        assert not hinted(sizing.broadcast_if_small(wide))
        assert sizing.small_sides({"w": (2, 1, None, 1016), "v": (2, 1, None, 900)}, wide) == {"w": False, "v": True}
    finally:
        spark.conf.unset(sizing.CONF_BROADCAST_BYTES)
    assert hinted(sizing.broadcast_if_small(wide))


def test_key_profile_counts_rows_and_duplicates(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "k long")
    b = spark.createDataFrame([(7,)], "id long")
    prof = sizing.key_profile({"a": (a, "k"), "b": (b, "id")})
    assert prof["a"][:2] == (5, 2) and prof["a"][2] == "2"     # NULL keys are not duplicates
    assert prof["b"] == (1, 1, None, 8)
    with pytest.raises(DuplicateKeyError):
        sizing.raise_on_duplicates(prof, {"a": "k", "b": "id"})
    sizing.assert_unique(b, "id")
