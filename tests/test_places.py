"""Nearest places against comparing all pairs."""

import math
import random

import numpy as np
import pytest

from millrace.operators import places as P

RADIUS = 3961


def brute(left, right):
    """Rounded distance and smallest id, from all pairs."""
    sites = sorted((i, la, lo) for i, la, lo in right if None not in (i, la, lo) and not math.isnan(la))
    out = {}
    for k, la, lo in left:
        if la is None or lo is None or math.isnan(la) or not sites:
            continue
        ids, lat, lon = (np.array(x, dtype=float) for x in zip(*sites))
        a = np.sin(np.radians(lat - la) / 2) ** 2 + math.cos(math.radians(la)) * np.cos(np.radians(lat)) * np.sin(np.radians(lon - lo) / 2) ** 2
        distance = 2 * RADIUS * np.arcsin(np.sqrt(np.minimum(a, 1)))
        out[k] = (distance.min(), {int(i) for i, x in zip(ids, distance) if x < distance.min() + 2e-6})
    return out


def check(spark, left, right, most=32):
    got = P.nearest_by_distance(
        spark.createDataFrame(left, "id long, a double, b double"), ["id"], ("a", "b"), spark.createDataFrame(right, "site long, c double, d double"), "site", ("c", "d"), most=most
    ).collect()
    want = brute(left, right)
    assert {r.id for r in got} == set(want) and len(got) == len(left) - sum(k not in want for k, _, _ in left)
    for r in got:
        distance, ids = want[r.id]
        assert abs(r.distance - distance) < 1.1e-6 and r.site in ids, (r, want[r.id])
    return {r.id: r.site for r in got}


def spread(n, seed, lat=(-90, 90), lon=(-180, 180), start=0):
    rng = random.Random(seed)
    return [(start + i, rng.uniform(*lat), rng.uniform(*lon)) for i in range(n)]


POLES = [(9000, 90.0, 0.0), (9001, 90.0, 77.0), (9002, -90.0, 5.0), (9003, 89.9999, 179.0), (9004, 89.9999, -179.0), (9005, -89.9999, 1.0), (9006, 0.0, 180.0), (9007, 0.0, -180.0), (9008, 0.0, 179.9999)]
ODD = [(9100, None, 1.0), (9101, 1.0, None), (9102, float("nan"), 1.0)]


@pytest.mark.parametrize("most", [1, 4, 32])
def test_places_all_over(spark, most):
    check(spark, spread(200, 1) + POLES + ODD, spread(150, 2) + POLES + ODD + [(None, 3.0, 3.0)], most)


def test_a_crowded_city_far_from_most_left_places(spark):
    city = spread(1500, 3, (52.3, 52.7), (13.1, 13.7))
    check(spark, spread(120, 4) + spread(200, 5, (52.4, 52.6), (13.2, 13.6), 1000) + POLES, city, most=16)


def test_sparse_right_side(spark):
    check(spark, spread(100, 6) + POLES, [(7, -12.0, 100.0)])
    check(spark, spread(100, 6) + POLES, [(7, -12.0, 100.0), (8, 12.0, -80.0)], most=1)
    check(spark, spread(20, 6), [(None, 1.0, 1.0)])
    check(spark, [], spread(5, 1))


def test_ties_take_the_smaller_id_and_repeats_keep_their_rows(spark):
    ring = [(i, 10.0, lon) for i, lon in enumerate((20.0, -20.0, 20.0, -20.0))] + [(10, 40.0, 20.0), (9, 40.0, 20.0)]
    got = check(spark, [(1, 10.0, 0.0), (2, 41.0, 20.0), (1, 10.0, 0.0)], ring, most=1)
    assert got == {1: 0, 2: 9}


def test_one_spot_holds_a_third_of_both_sides(spark):
    spot = [(5000 + i, 48.0, 2.0) for i in range(300)]
    check(spark, spread(300, 8) + spot, spread(200, 9) + spot, most=2)
