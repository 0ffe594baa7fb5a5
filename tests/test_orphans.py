import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quarryline.operators.orphans import OrphanLedger, arrivals, references
from quarryline.plans.skew import split_hot_join

T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def batch(spark, refs, parents, deleted, low=-1, high=10**9):
    keep = lambda rows: [(*r[:-1], at(r[-1])) for r in rows if low <= r[-1] < high]
    r = spark.createDataFrame(keep(refs), "entity string, id string, keys array<string>, ingested_at timestamp")
    p = spark.createDataFrame(keep(parents), "entity string, id string, ingested_at timestamp")
    d = spark.createDataFrame(keep(deleted), "entity string, id string, ingested_at timestamp")
    return references(r, "nodes", "keys", "things", "entity", F.col("id"), "keys"), arrivals(p, "things", "entity", "id"), arrivals(d, "things", "entity", "id")


def brute(refs, parents, deleted):
    out = set()
    firsts = {}
    for e, i, keys, t in refs:
        for k in keys or []:
            k = (k or "").strip()
            if k:
                firsts[e, i, k] = min(t, firsts.get((e, i, k), 10**9))
    for (e, i, k), t in firsts.items():
        times = [x for pe, pk, x in parents if pe == e and (pk or "").strip() == k]
        gone = [x for de, dk, x in deleted if de == e and dk == k]
        status = "missing" if not times else "late" if min(times) > t else "deleted" if gone and max(times) <= max(gone) else "held"
        if status != "held":
            out.add((e, i, k, status))
    return out


def collect(ledger):
    rows = ledger.orphans().select("entity", "record_id", "ref_key", "status").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def test_batches_agree_with_brute_force(spark):
    rng = random.Random(5)
    keys = [f"k{i}" for i in range(60)]
    refs = [("e" + str(rng.randrange(3)), f"r{rng.randrange(80)}", [rng.choice([*keys, " k1 ", "", None, "hub"]) for _ in range(rng.randrange(4))], rng.randrange(1000)) for _ in range(200)]
    refs += [("e0", "none", None, 5), ("e0", "empty", [], 5)]
    parents = [("e" + str(rng.randrange(3)), rng.choice(keys) + rng.choice(["", " "]), rng.randrange(1000)) for _ in range(150)] + [("e1", "hub", 300)]
    deleted = [("e" + str(rng.randrange(3)), rng.choice(keys), rng.randrange(1000)) for _ in range(40)]
    want = brute(refs, parents, deleted)
    whole = OrphanLedger(spark).advance(*batch(spark, refs, parents, deleted))
    assert collect(whole) == want
    parts = OrphanLedger(spark)
    for low, high in ((0, 200), (200, 650), (650, 10**9)):
        parts.advance(*batch(spark, refs, parents, deleted, low, high))
    assert collect(parts) == want
    counts = parts.snapshot("day").agg(F.sum("orphans"), F.sum("missing"), F.sum("late"), F.sum("deleted")).first()
    assert counts[0] == len(want) == sum(counts[1:])


def test_late_deleted_and_back(spark):
    refs = [("e", "a", ["x", "y", "z"], 10), ("e", "b", ["y"], 60)]
    parents = [("e", "x", 20), ("e", "y", 5), ("e", "y", 50), ("e", "z", 1)]
    deleted = [("e", "z", 30), ("e", "y", 40)]
    ledger = OrphanLedger(spark)
    ledger.advance(*batch(spark, refs, parents, deleted, 0, 15))
    assert collect(ledger) == {("e", "a", "x", "missing")}
    ledger.advance(*batch(spark, refs, parents, deleted, 15, 45))
    assert collect(ledger) == {("e", "a", "x", "late"), ("e", "a", "z", "deleted"), ("e", "a", "y", "deleted")}
    ledger.advance(*batch(spark, refs, parents, deleted, 45))
    assert collect(ledger) == {("e", "a", "x", "late"), ("e", "a", "z", "deleted")}
    assert OrphanLedger(spark).orphans().collect() == []


def test_hot_keys_are_split_and_lose_nothing(spark):
    left = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), F.col("id").alias("v"))
    left = left.unionByName(spark.createDataFrame([(None, -1)], "k string, v bigint"))
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), (None, 4)], "k string, w int")
    plain = sorted(map(str, left.join(right, left["k"].eqNullSafe(right["k"]), "left").select(left["k"], "v", "w").collect()))
    assert sorted(map(str, split_hot_join(left, right, ["k"], 50).select("k", "v", "w").collect())) == plain


def test_null_entities_and_repeats_over_batches(spark):
    refs = [(None, "a", ["x", "q"], 10), (None, "a", ["x", "q"], 200), ("e", "b", ["y"], 10), ("e", "b", ["y"], 250)]
    parents = [(None, "q", 5), ("e", "y", 300)]
    ledger = OrphanLedger(spark, buckets=8, snapshot_every=1)
    for low, high in ((0, 100), (100, 220), (220, 10**9)):
        ledger.advance(*batch(spark, refs, parents, [], low, high))
    assert collect(ledger) == {(None, "a", "x", "missing"), ("e", "b", "y", "late")} == brute(refs, parents, [])
    assert [(r["batch"], r["orphans"], r["late"]) for r in ledger.snapshots().orderBy("batch").collect()] == [(1, 2, 0), (2, 2, 0), (3, 2, 1)]


def test_a_batch_costs_what_it_concerns(spark):
    """The tenth batch touches as few buckets, and rewrites as few rows, as the second."""
    ledger, cost = OrphanLedger(spark, buckets=256), []
    for n in range(10):
        refs = [(f"e{n}", f"r{i}", [f"k{i % 7}", "gone"], n) for i in range(40)]
        parents = [(f"e{n}", f"k{i}", n) for i in range(7)]
        before = dict(ledger.held.held)
        ledger.advance(*batch(spark, refs, parents, []))
        changed = {b for b, path in ledger.held.held.items() if before.get(b) != path}
        assert changed <= ledger.touched and len(ledger.touched) <= ledger.spread
        cost.append(ledger.held.read(changed).count())
    assert max(cost[1:]) <= 2 * cost[1] and ledger.orphans().count() == 400
