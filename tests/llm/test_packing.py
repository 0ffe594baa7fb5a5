import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quarryline.llm.packing import assign_packs, containers, pack_histogram


def item_by_item(lengths, capacity):
    """How often each fill occurs, placing one item at a time in the emptiest pack; packs equally full are interchangeable."""
    packs = []
    for n in sorted(lengths, reverse=True):
        best = min(packs, key=sum, default=None)
        if best is None or sum(best) + n > capacity:
            packs.append([n])
        else:
            best.append(n)
    return Counter(map(sum, packs))


def test_histogram_equals_items_one_by_one():
    rng = random.Random(1)
    for capacity in (10, 37, 120):
        for _ in range(60):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
            got, placed = Counter(), Counter()
            for packs, pattern in pack_histogram(Counter(lengths), capacity):
                got[sum(n * times for n, times in pattern)] += packs
                for n, times in pattern:
                    placed[n] += packs * times
            assert got == item_by_item(lengths, capacity) and placed == Counter(lengths)


def test_every_item_once_and_within_capacity(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"g{i % 17}", f"i{i}", rng.choice([None, 0, 3, 5, 40, 60, 99, 100, 101, 500]), "x") for i in range(2000)]
    rows += [(None, "n1", 50, "x"), (None, "n2", 60, "x")]
    df = spark.createDataFrame(rows, "g string, i string, n int, length string")
    for options in ({}, {"salt_rows": 20, "block": 7}):
        got = assign_packs(df, "g", "i", F.col("n"), 100, **options).collect()
        assert sorted((r["g"] or "", r["i"]) for r in got) == sorted((r[0] or "", r[1]) for r in rows)
        assert {r["i"] for r in got if r["kind"] == "oversized"} == {r[1] for r in rows if (r[2] or 0) > 100}
        packs = defaultdict(list)
        for r in got:
            if r["kind"] == "packed":
                packs[r["g"], r["pack"]].append(r["length"])
            else:
                assert r["pack"] is None
        assert max(sum(p) + len(p) - 1 for p in packs.values()) <= 100
        for g in {r[0] for r in rows}:
            mine = [p for (h, _), p in packs.items() if h == g]
            assert Counter(sum(p) + len(p) for p in mine) == item_by_item([(r[2] or 0) + 1 for r in rows if r[0] == g and (r[2] or 0) <= 100], 101)
            assert {k for h, k in packs if h == g} == set(range(len(mine)))
    assert assign_packs(df.limit(0), "g", "i", F.col("n"), 100).collect() == []


def test_containers_report_fill(spark):
    df = spark.createDataFrame([("g", "a", 60), ("g", "b", 39), ("g", "c", 100)], "g string, i string, n int")
    rows = containers(assign_packs(df, "g", "i", F.col("n"), 100), "g", "i", 100).collect()
    assert {(tuple(r["item_ids"]), r["items"], r["used"], r["fill"]) for r in rows} == {(("a", "b"), 2, 100, 1.0), (("c",), 1, 100, 1.0)}
