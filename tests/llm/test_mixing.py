import random
from collections import defaultdict

from pyspark.sql import functions as F

from quarryline.llm.mixing import deviations, draw, edf, mix_plan, shares, sized, source_name, tokens


def test_deviation_is_below_one_block():
    rng = random.Random(9)
    for n in (1, 2, 5, 12):
        weights = [rng.choice([0.3, 1, 2.5, 7, 40]) for _ in range(n)]
        slots = edf(weights, 500)
        taken = sorted(s for own in slots for s in own)
        assert len(set(taken)) == len(taken)
        for w, own in zip(weights, slots):
            u = w / sum(weights)
            done = 0
            for t in range(500):
                done += t in set(own[done : done + 1])
                assert abs(done - u * (t + 1)) < 1 + 1e-9
    assert edf([0, 1, -2], 4) == [[], [0, 1, 2, 3], []]


def test_tokens_and_names(spark):
    df = spark.createDataFrame([("a_b c-d, 1\u00e9!", " Big-Source\t"), (None, "  "), ("", None)], "t string, s string")
    assert [tuple(r) for r in df.select(tokens(F.col("t")), source_name(F.col("s"))).collect()] == [(7, "big_source"), (0, None), (0, None)]


def test_plan_and_draw(spark):
    rng = random.Random(10)
    docs = [(i, rng.choice(["A-x", " a_X", "b", "c"]), " ".join(["w"] * rng.randrange(30))) for i in range(400)] + [(900, None, "w w"), (901, "b", None)]
    targets = [(1, "a_x", 1.0, 2, 3000), (1, "B", 2.0, 1, 3000), (1, "gone", 0.5, 3, 3000), (2, "c", 1.0, 9, 4000), (3, None, 1.0, 1, 10), (2, "b", None, 1, 4000)]
    df = spark.createDataFrame(docs, "d bigint, source string, text string")
    of = spark.createDataFrame(targets, "mix_id bigint, source string, weight double, max_repeats int, total_tokens bigint")
    sizes_of = sized(df, "d")
    plan = mix_plan(sizes_of, of, blocks=64)
    rows = {(r["mix_id"], r["source"]): r for r in shares(plan, draw(sizes_of, plan, "d")).collect()}
    assert all(r["deviation"] < 1 + 1e-9 for r in deviations(plan, 64).collect())
    sizes = defaultdict(int)
    for _, s, t in docs:
        if s:
            sizes[s.strip().lower().replace("-", "_")] += len((t or "").split())
    assert set(rows) == {(1, "a_x"), (1, "b"), (1, "gone"), (2, "c"), (2, "b")}
    for (m, s), share, repeats, total in (((1, "a_x"), 1 / 3.5, 2, 3000), ((1, "b"), 2 / 3.5, 1, 3000), ((1, "gone"), 0.5 / 3.5, 3, 3000), ((2, "c"), 1, 9, 4000)):
        r = rows[m, s]
        assert r["short"] == (repeats * sizes[s] < share * total) and abs(r["planned_tokens"] - min(share * total, repeats * sizes[s])) < 1e-5
    rows_of = {(r["mix_id"], r["source"]): r for r in plan.collect()}
    for bucket_rows in (100_000, 10):
        drawn = draw(sizes_of, plan, "d", bucket_rows=bucket_rows).collect()
        got = defaultdict(int)
        for r in drawn:
            got[r["mix_id"], r["source"]] += len((dict((d, t) for d, _, t in docs)[r["d"]] or "").split())
            assert 0 <= r["copy_no"] <= rows[r["mix_id"], r["source"]]["repeats"]
        assert len({(r["mix_id"], r["d"], r["copy_no"]) for r in drawn}) == len(drawn)
        for key, r in rows.items():
            assert r["planned_tokens"] - 1e-5 <= got[key] <= r["planned_tokens"] + 30 and got[key] == r["drawn_tokens"]
        for r in drawn:  # a document lies in a block that was served
            assert r["slot"] == rows_of[r["mix_id"], r["source"]]["slots"][min(r["block_no"], len(rows_of[r["mix_id"], r["source"]]["slots"]) - 1)] is not None
    assert mix_plan(sizes_of.limit(0), of).where("NOT short AND target_tokens > 0").collect() == []
    assert mix_plan(sizes_of, of.limit(0)).collect() == []


def test_a_block_that_nothing_fills_leaves_its_slot():
    left = {0: 2}

    def serve(i, k, late):
        if i == 0 and not left[0]:
            return False
        left[0] -= i == 0
        return not late

    slots = edf([1.0, 1.0], 8, serve)
    assert slots[0] == [0, 2, None, None] and sorted(s for own in slots for s in own if s is not None) == sorted({0, 2, *slots[1]}) and None not in slots[1]
