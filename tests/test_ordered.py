import random

from pyspark.sql import functions as F

from quarryline.operators import ordered
from quarryline.operators.joins import asof_join, nearest_time, overlap_join
from quarryline.operators.ranking import lexical_top, next_fit, suppress, suppress_boxes, uniform_picks
from quarryline.plans.chains import runs
from quarryline.plans.scan import neighbours, running, shifted, with_position


def frame(spark, seed=1, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), f"r{i:03}", rng.choice([None, *range(0, 40_000_000, 100_000)]) if i % 30 else None, rng.randrange(5)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, id string, t bigint, v int")


def in_order(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[1])):
        by.setdefault(r[0], []).append(r)
    return by


def test_positions_and_running_values(spark):
    rows, df = frame(spark)
    placed = with_position(df, ["k"], "t", ["id"])
    value = F.when(F.col("v") > 2, F.col("v"))
    for block in (7, 65_536):
        p = running(placed, ["k"], "pos", F.col("v"), "sum", "total", block)
        p = running(p, ["k"], "pos", F.col("v"), "max", "top", block, before=True)
        p = running(p, ["k"], "pos", value, "last", "latest", block)
        p = shifted(p, ["k"], "pos", ["id"], 2, "back_")
        got = {r["id"]: (r["pos"], r["total"], r["top"], r["latest"], r["back_id"]) for r in p.collect()}
        for own in in_order(rows).values():
            for i, r in enumerate(own):
                vs = [x[3] for x in own[: i + 1]]
                big = [v for v in vs if v > 2]
                assert got[r[1]] == (i, sum(vs), max(vs[:-1], default=None), big[-1] if big else None, own[i - 2][1] if i > 1 else None)


def test_gap_sessions_and_batches(spark):
    rows, df = frame(spark, 2)
    df = df.where("t IS NOT NULL").withColumn("e", F.col("t") + F.col("v") * 100_000)
    s = {r["id"]: r["session"] for r in ordered.gap_sessions(df, ["k"], "t", "e", ["id"], 300_000).collect()}
    for own in in_order([r for r in rows if r[2] is not None]).values():
        number, reach = 0, None
        for r in own:
            if reach is not None and r[2] - reach >= 300_000:
                number += 1
            reach = max(reach or 0, r[2] + r[3] * 100_000)
            assert s[r[1]] == number
    b = ordered.count_batches(spark.createDataFrame([("a", i, str(i).zfill(2)) for i in range(11)], "k string, t bigint, id string"), ["k"], "t", ["id"], 4, 3)
    assert {n: sorted(r["t"] for r in b.collect() if r["batch"] == n) for n in range(4)} == {0: [0, 1, 2, 3], 1: [3, 4, 5, 6], 2: [6, 7, 8, 9], 3: [9, 10]}


def windows(starts, ends, target, overlap):
    return ordered.all_runs({"s": starts, "e": ends}, ordered.window_step("s", "e", target, overlap))


def test_overlapping_windows():
    starts, ends = [0, 60, 120, 180], [60, 120, 180, 240]
    assert windows(starts, ends, 150, 0) == [(0, 1), (2, 3)]
    assert windows(starts, ends, 180, 70) == [(0, 2), (1, 3)]
    assert windows([], [], 180, 70) == []
    assert windows([0], [999], 180, 70) == [(0, 0)]


def test_passages():
    values = {"s": [0, 10, 21, 1030, 1100], "e": [9, 20, 30, 1090, 1200], "c": [False, True, False, False, False]}
    assert ordered.all_runs(values, ordered.passage_step("s", "e", "c", 1000, 15)) == [(0, 1), (2, 2), (3, 3), (4, 4)]
    values = {"s": [0, 10, 30, 40], "e": [9, 29, 35, 50], "c": [False] * 4}
    assert ordered.all_runs(values, ordered.passage_step("s", "e", "c", 1000, 18)) == [(0, 1), (2, 3)]  # cut after the row that passes


def test_runs_in_blocks_are_the_runs_of_the_whole(spark):
    rng = random.Random(11)
    rows = []
    for key, n in (("hot", 900), ("a", 3), (None, 40), ("b", 1)):
        at = 0
        for i in range(n):
            at += rng.choice([1, 4, 9, 9, 30] if i % 50 else [400])
            rows.append((key, f"r{i:04}", at, at + rng.choice([2, 6, 12])))
    df = spark.createDataFrame(rows, "k string, id string, s bigint, e bigint").repartition(5)
    steps = ((ordered.window_step("s", "e", 60, 20), 60), (ordered.passage_step("s", "e", "odd", 25, 40), 100), (ordered.speech_step("s", "e", 50, 5), 60))
    for step, span in steps:
        want = set()
        for key in ("hot", "a", None, "b"):
            own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[3], r[1]))
            values = {"s": [r[2] for r in own], "e": [r[3] for r in own], "odd": [r[1][-1] in "13579" for r in own]}
            want |= {(key, own[x][1], own[y][1]) for x, y in ordered.all_runs(values, step)}
        for block, halo in ((1000, 1000), (64, 32), (16, 1)):
            source = df.withColumn("odd", F.substring("id", 5, 1).cast("int") % 2 == 1)
            got = runs(source, ["k"], "s", ["e", "id"], ["id", "e", "odd"], span, step, lambda v, x, y: {"first": v["id"][x], "last": v["id"][y]}, "k string, first string, last string", block, halo).collect()
            assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert runs(source.limit(0), ["k"], "s", ["e", "id"], ["id", "e", "odd"], span, step, lambda v, x, y: {}, "k string").collect() == []


def test_an_uninterrupted_lecture_is_split(spark):
    """A lecture without a pause: windows of 96 rows each, whatever the number of blocks."""
    df = spark.range(200_000).select(F.lit(None).cast("string").alias("k"), F.col("id").cast("string").alias("id"), (F.col("id") * 5_000).alias("s"), (F.col("id") * 5_000 + 5_000).alias("e"))
    got = runs(df, ["k"], "s", ["e"], ["e"], 480_000, ordered.window_step("s", "e", 480_000, 120_000), lambda v, x, y: {"rows": y - x + 1}, "k string, rows int").groupBy("rows").count().collect()
    assert {r["rows"]: r["count"] for r in got} == {96: 2777, 56: 1} or sum(r["count"] for r in got) == 1 + -(-(200_000 - 96) // 72)


def test_neighbours(spark):
    rows, df = frame(spark, 7)
    placed = with_position(df, ["k"], "t", ["id"])
    got = {r["id"]: (r["b_id"], r["a_id"]) for r in neighbours(placed, ["k"], "pos", ["id"], {"b_": 2, "a_": -1}, 8).collect()}
    assert len(got) == len(rows)
    for own in in_order(rows).values():
        ids = [None, None, *[r[1] for r in own], None]
        assert all(got[r[1]] == (ids[i], ids[i + 3]) for i, r in enumerate(own))


def test_ties_are_placed_alike_in_every_evaluation(spark):
    df = spark.range(2000).select(F.lit("k").alias("k"), F.lit(5).cast("bigint").alias("t"), (F.col("id") * 7919 % 2000).alias("v"))
    place = lambda d: {r["v"]: r["pos"] for r in with_position(d, ["k"], "t", []).collect()}
    assert place(df) == place(df.repartition(7, "v"))


def test_folds_and_batches_keep_null_keys(spark):
    df = spark.createDataFrame([(None, "x", 0, 5), (None, "y", 6, 9), ("a", "z", 1, 2)], "k string, id string, s bigint, e bigint")
    folded = ordered.fold_islands(df, ["k"], "s", "e", ["e", "id"], 100, lambda part, final: [{"k": part[0]["k"], "n": len(part)}], "k string, n int").collect()
    assert {(r["k"], r["n"]) for r in folded} == {(None, 2), ("a", 1)}
    assert ordered.count_batches(df.withColumnRenamed("s", "t"), ["k"], "t", ["id"], 4, 3).count() == 3


def test_best_texts_by_map_and_by_join(spark):
    rng = random.Random(12)
    vocabulary = [f"word{i}" for i in range(30)]
    texts = spark.createDataFrame([(i if i else None, " ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 12])))) for i in range(200)] + [(500, None)], "text_id bigint, text string")
    queries = spark.createDataFrame([(q, " ".join(rng.choices(vocabulary, k=6))) for q in range(9)] + [(9, None), (10, "no")], "query_id bigint, query string")
    one = sorted(map(str, lexical_top(queries, texts, 4).collect()))
    assert one == sorted(map(str, lexical_top(queries, texts, 4, broadcast_words=0).collect())) and len(one) == 36
    assert lexical_top(queries.limit(0), texts, 4).collect() == []


def test_joins_on_time(spark):
    rows, left = frame(spark, 4)
    other, right = frame(spark, 5)
    left = left.withColumnRenamed("t", "at")
    r = right.select("k", F.col("t").alias("rt"), F.col("id").alias("rid"))
    got = {x["id"]: x["m"] for x in asof_join(left, r, ["k"], "at", "rt", "rid", "m").collect()}
    near = {x["id"]: x["m"] for x in nearest_time(left, r, ["k"], "at", "rt", "rid", "m").collect()}
    for k, i, t, _ in rows:
        before = [(x[2], x[1]) for x in other if x[0] == k and x[2] is not None and t is not None and x[2] <= t]
        assert got[i] == (max(before)[1] if before else None)
        all_ = [(abs(x[2] - t), x[1]) for x in other if x[0] == k and x[2] is not None] if t is not None else []
        assert near[i] is None if not all_ else abs(dict((x[1], x[2]) for x in other)[near[i]] - t) == min(all_)[0]
    a = left.select("k", "id", F.col("at").alias("s"), (F.col("at") + 250_000).alias("e")).where("k IS NOT NULL")
    b = r.select("k", "rid", F.col("rt").alias("rs"), (F.col("rt") + 900_000).alias("re"))
    want = sorted((i, y[1]) for k, i, t, _ in rows for y in other if k and k == y[0] and t is not None and y[2] is not None and t <= y[2] + 900_000 and y[2] <= t + 250_000)
    assert sorted((x["id"], x["rid"]) for x in overlap_join(a, b, ["k"], 300_000).collect()) == want


def test_suppression_and_packing(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), f"r{i}", rng.randrange(3000), rng.randrange(4)) for i in range(150)] + [("a", "null", None, 9)]
    df = spark.createDataFrame(rows, "k string, id string, t bigint, p int")
    got = {r["id"] for r in suppress(df, ["k"], "t", [("p", False), ("t", True), ("id", True)], 20, "k string, id string, t bigint").collect()}
    kept = []
    for r in sorted((r for r in rows if r[2] is not None), key=lambda r: (-r[3], r[2], r[1])):
        if not any(x[0] == r[0] and abs(x[2] - r[2]) <= 20 for x in kept):
            kept.append(r)
    assert got == {r[1] for r in kept}
    assert next_fit([5, 5, 1, 11, 2, 2, 2], 10, 2) == [0, 0, 1, 2, 3, 3, 4]
    assert uniform_picks(11, 3) == [0, 5, 10] and uniform_picks(5, 1) == [4] and uniform_picks(2, 9) == [0, 1]
    import numpy as np

    assert suppress_boxes(np.array([[0, 0, 10, 10], [1, 0, 10, 10], [20, 20, 30, 30]]), 0.7) == [0, 2]


def test_pieces_and_caps():
    assert ordered.pieces(0, 100, 40) == [(0, 40), (40, 80)] and ordered.pieces(0, 20, 40) == [(0, 20)] and ordered.pieces(0, 140, 40, 10) == [(0, 40), (40, 80), (80, 120), (120, 140)]
    values = {"s": [0, 6, 30, 32], "e": [5, 9, 31, 50]}
    assert ordered.all_runs(values, ordered.speech_step("s", "e", 15, 3)) == [(0, 1), (2, 2), (3, 3)]


def test_edits(spark):
    import pytest

    from quarryline.operators import editing
    from quarryline.operators.patching import PatchError

    blocks = spark.createDataFrame([("k", x) for x in "abc"], "k string, id string")
    plan = lambda *rows: spark.createDataFrame([("k", *r) for r in rows], "k string, id string, action string, section string, into string")
    got = editing.edit_plan(blocks, plan(("a", "keep", "s", None), ("b", "merge", None, "a"), ("c", "drop", None, None)), ["k"]).collect()
    assert [(r["section"], r["id"], r["sources"]) for r in got] == [("s", "a", ["a", "b"])]
    for bad in ([("a", "keep", "s", None)], [("a", "keep", "s", None), ("b", "merge", None, "c"), ("c", "drop", None, None)], [(x, "keep", "s", None) for x in "abcc"], [(x, "keep", "s", None) for x in "abcd"]):
        with pytest.raises(PatchError):
            editing.edit_plan(blocks, plan(*bad), ["k"])
    df = spark.createDataFrame([("a", None, "HIGH"), (" ", "b", "odd")], "id string, node_id string, level string")
    rows = editing.canonical(df, {"id": ["node_id", "missing"]}, {"level": {"high": "3", "": "1"}}).collect()
    assert [(r["id"], r["level"]) for r in rows] == [("a", "3"), ("b", "1")]
    assert editing.halves([1, 2, 3, 9], lambda p: sum(p) < 10) == [[1, 2], [3], [9]] and editing.halves([], len) == []
    with pytest.raises(PatchError):
        editing.halves([20], lambda p: sum(p) < 10)
    states = spark.createDataFrame([("x", 1, 5), ("x", 1, 5), ("y", 1, 3), ("z", 2, 0)], "sig string, h int, s int")
    assert [r["sig"] for r in editing.prune(states, "sig", ["h"], ["s"], 5).collect()] == ["y", "x"]
