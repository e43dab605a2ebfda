"""Property checks: the fixed-point average equals the exact rational mean
rounded half-up, in Spark and in the vectorised (numpy) frame code."""

from decimal import Decimal
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from vitalis.functions.stats import fixed_avg
from vitalis.streaming.state import frame_stats

values = st.lists(
    st.integers(min_value=-10**12, max_value=10**12).map(lambda k: k / 10**9), min_size=1, max_size=40
)
ties = st.lists(st.integers(min_value=-10**7, max_value=10**7).map(lambda k: k / 10**6), min_size=2, max_size=2)


def exact_mean(xs, digits=6):
    """Mean of the decimal values rounded half up (ties toward +infinity)."""
    q = sum(Fraction(Decimal(repr(x))) for x in xs) / len(xs)
    scaled = q * 10**digits + Fraction(1, 2)
    whole = scaled.numerator // scaled.denominator  # floor
    return float(Decimal(whole).scaleb(-digits))


@settings(max_examples=25, deadline=None)
@given(values)
def test_fixed_avg_is_exact_half_up(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    got = df.agg(fixed_avg("v", 6)).first()[0]
    assert got == exact_mean(xs)


@settings(max_examples=50, deadline=None)
@given(values)
def test_frame_stats_whole_frame_matches(xs):
    us = np.arange(len(xs), dtype=np.int64)
    v = np.array(xs, dtype=float)
    count, avg, mn, mx = frame_stats(us, v, window_us=10**9, digits=6)
    assert count[-1] == len(xs) and mn[-1] == min(xs) and mx[-1] == max(xs)
    assert avg[-1] == exact_mean(xs)


@settings(max_examples=25, deadline=None)
@given(ties)
def test_fixed_avg_ties_round_toward_plus_infinity(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    assert df.agg(fixed_avg("v", 6)).first()[0] == exact_mean(xs)
