import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.operators.intervals import HOUR_MS, covered_periods, gaps, merge_lists

SCHEMA = "k string, s bigint, e bigint, block string, slot int"


def brute(rows):
    """Periods and gaps per key, by one sweep over the sorted rows."""
    out = {}
    for k, s, e in sorted((r for r in rows if r[1] is not None and r[2] is not None and r[2] > r[1]), key=lambda r: (r[0] or "", r[1], r[2])):
        periods = out.setdefault(k, [])
        if periods and s <= periods[-1][1]:
            periods[-1][1] = max(periods[-1][1], e)
        else:
            periods.append([s, e])
    return {(k, *p) for k, ps in out.items() for p in ps}, {(k, a[1], b[0]) for k, ps in out.items() for a, b in zip(ps, ps[1:])}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_against_sweep(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        s = int(rng.integers(0, 40 * HOUR_MS))
        length = int(rng.choice([-5, 0, 1, 5_000, 60_000, 5 * HOUR_MS], p=[0.02, 0.02, 0.02, 0.6, 0.33, 0.01]))
        key = "hot" if i % 3 == 0 else f"k{rng.integers(0, 200)}"
        rows.append((key, s if i % 50 else None, s + length if i % 60 else None))
    rows += rows[:100]
    periods, holes = brute(rows)
    df = frame(spark, rows).repartition(7)
    for options in ({}, {"block_ms": 1000}, {"fan_in": 2, "task_rows": 50}):
        assert {tuple(r) for r in covered_periods(df, ["k"], "s", "e", **options).collect()} == periods
        got = gaps(df, ["k"], "s", "e", **options).collect()
        assert {tuple(r) for r in got} == holes and len(got) == len(holes)


def test_edges(spark):
    rows = [("a", 0, 10), ("a", 10, 20), ("a", 5, 7), ("a", 30, 30), ("a", 40, 39), ("a", -5, -1), (None, 1, 2), (None, 4, 5), ("b", None, 3)]
    df = frame(spark, rows)
    assert sorted(tuple(r) for r in covered_periods(df, ["k"], "s", "e").collect() if r["k"]) == [("a", -5, -1), ("a", 0, 20)]
    assert {tuple(r) for r in gaps(df, ["k"], "s", "e").collect()} == {("a", -1, 0), (None, 2, 4)}
    assert gaps(frame(spark, []), ["k"], "s", "e").collect() == []


pairs = st.lists(st.tuples(st.integers(-50, 50), st.integers(1, 20)), max_size=12)


def listed(rows):
    periods = sorted(brute([("x", s, s + n) for s, n in rows])[0], key=lambda p: p[1])
    return np.array([p[1] for p in periods], np.int64), np.array([p[2] for p in periods], np.int64)


@settings(max_examples=80, deadline=None)
@given(pairs.filter(len), pairs.filter(len))
def test_merge_is_the_union(a, b):
    got = merge_lists(*listed(a), *listed(b))
    assert [x.tolist() for x in got] == [x.tolist() for x in listed(a + b)]
