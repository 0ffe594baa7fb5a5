import random

from quarryline.llm.nearest import nearest

SCHEMA = "entity string, at bigint, id string, match_id int"


def brute(left, right, tolerance):
    out = []
    for e, t, i, _ in left:
        if e is None or t is None:
            continue
        near = sorted((abs(rt - t), rt, ri or "") for re, rt, ri, _ in right if re == e and rt is not None and abs(rt - t) <= tolerance)
        out.append((e, t, i, near[0][2] if near else None, near[0][1] if near else None))
    return sorted(out, key=repr)


def check(spark, left, right, tolerance, parts):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = nearest(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), tolerance).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((tuple(r) for r in got), key=repr) == brute(left, right, tolerance)


def test_entity_over_many_tasks(spark):
    rng = random.Random(4)
    pick = lambda: "hot" if rng.random() < 0.6 else f"e{rng.randrange(9)}"
    left = [(pick(), rng.randrange(5000), f"l{i}", 1) for i in range(300)] + [("only", 5, "o", 1), (None, 4, "n", 1), ("hot", None, "m", 1)]
    right = [(pick(), rng.randrange(5000), f"r{rng.randrange(400)}", 1) for i in range(250)] + [("hot", 77, None, 1), (None, 3, "x", 1), ("e1", None, "y", 1)]
    check(spark, left, right + right[:40], 40, 13)
    check(spark, left, right, 10**6, 5)


def test_ties_and_empty(spark):
    right = [("a", 10, "z", 1), ("a", 10, "b", 1), ("a", 20, "c", 1), ("a", 20, "c", 1)]
    left = [("a", 15, "l", 1), ("a", 10, "same", 1), ("a", 15, "l", 1), ("a", 31, "far", 1)]
    check(spark, left, right, 10, 3)
    check(spark, left, [], 10, 3)
    check(spark, [], right, 10, 3)


def test_many_left_rows_far_from_any_right(spark):
    left = [("a", 1000 + i, f"l{i}", 1) for i in range(400)]
    check(spark, left, [("a", 1, "first", 1), ("a", 3000, "last", 1)], 5000, 9)
