import numpy as np
from hypothesis import given, settings, strategies as st

from orbita.functions.kneedle import elbow_convex_decreasing
from orbita.functions.numeric import round_half_even, safe_ratio


def test_round_half_even_matches_numpy(spark):
    vals = [0.125, 0.135, 2.5, 3.5, -2.5, 1.0005, 0.3333333, 12.345]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]


def test_safe_ratio_zero_denominator_is_zero(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (1.0, 3.0)], "a double, b double")
    got = [r[0] for r in df.select(safe_ratio("a", "b", 3)).collect()]
    assert got == [0.0, 2.5, 0.333]


def _brute_knee(xs, ys, s=1.0):
    # Direct restatement of the published procedure on the normalized curves.
    xn = (np.array(xs, float) - min(xs)) / (max(xs) - min(xs))
    yn = (np.array(ys, float) - min(ys)) / (max(ys) - min(ys))
    yd = (1 - yn) - xn
    n = len(yd)
    mx = [i for i in range(n) if yd[i] >= yd[max(i - 1, 0)] and yd[i] >= yd[min(i + 1, n - 1)]]
    mn = [i for i in range(n) if yd[i] <= yd[max(i - 1, 0)] and yd[i] <= yd[min(i + 1, n - 1)]]
    if not mx:
        return None
    step = abs(np.diff(xn).mean())
    thr, ti = None, None
    for i in range(mx[0], n - 1):
        if i in mx:
            thr, ti = yd[i] - s * step, i
        if i in mn:
            thr = 0.0
        if thr is not None and yd[i + 1] < thr:
            return xs[ti]
    return None


def test_elbow_on_a_sharp_curve():
    ks = list(range(2, 11))
    inertia = [1000, 400, 250, 220, 200, 185, 175, 168, 162]
    assert elbow_convex_decreasing(ks, inertia) == 4 == _brute_knee(ks, inertia)


def test_elbow_none_on_a_straight_line():
    ks = list(range(2, 11))
    assert elbow_convex_decreasing(ks, [100 - 10 * k for k in ks]) is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(1, 1e4, allow_nan=False), min_size=4, max_size=9, unique=True))
def test_elbow_matches_brute_force(ys):
    ys = sorted(ys, reverse=True)
    ks = list(range(2, 2 + len(ys)))
    assert elbow_convex_decreasing(ks, ys) == _brute_knee(ks, ys)
