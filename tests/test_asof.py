"""As-of join against brute force: busy keys, times in one minute, edges of hours and of the range."""

import datetime as dt
import random

import pytest

from apronlake.operators import joins as J

BASE = dt.datetime(2024, 3, 9, 22, 0)


@pytest.mark.parametrize("hours", [1, 3, 30])
def test_asof_equals_brute_force(spark, hours):
    r = random.Random(hours)
    second = lambda n: BASE + dt.timedelta(seconds=n)
    right = {(k, second(r.randrange(0, 40 * 3600, 7))) for k in "ab" for _ in range(120)}
    right |= {("a", second(36_000 + n)) for n in range(0, 90, 10)} | {("a", second(3600 * n)) for n in range(5)}
    rows = [(k, t, f"{k}{t}") for k, t in sorted(right)] + [(None, BASE, "no key"), ("a", None, "no time")]
    left = [(i, r.choice("abc"), second(r.randrange(0, 45 * 3600))) for i in range(150)]
    left += [(200 + n, "a", second(36_000 + 5 * n)) for n in range(20)] + [(300 + n, "a", second(3600 * (n + hours))) for n in range(5)] + [(400, None, BASE), (401, "a", None), (402, "a", second(36_000)), (403, "a", second(36_000))]
    want = {}
    for i, k, t in left:
        found = [x for x in rows if k and t and x[0] == k and x[1] and t - dt.timedelta(hours=hours) < x[1] <= t]
        want[i] = max(found, key=lambda x: x[1])[1:] if found else (None, None)
    out = J.asof_backward(spark.createDataFrame(left, "i long, k string, t timestamp_ntz"), spark.createDataFrame(rows, "s string, seen timestamp_ntz, v string"), ("k", "s"), "t", "seen", hours)
    got = {x.i: (x.seen, x.v) for x in out.collect()}
    assert got == want and out.columns == ["i", "k", "t", "seen", "v"]
