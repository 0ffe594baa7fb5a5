from pyspark.sql import functions as F

from quarryline.operators import notes
from quarryline.sources import literature


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_earlier_symbols_pass_over_own_ones(spark):
    symbols = spark.createDataFrame([(k, f"s{i}", i * 10) for k in ("a", None) for i in range(8)] + [("a", "late", None)], "k string, id string, at bigint")
    batches = spark.createDataFrame([("a", "w", 60), (None, "w", 35), ("a", "none", None), ("a", "first", -1)], "k string, batch string, start bigint")
    own = spark.createDataFrame([("a", "w", "s6"), ("a", "w", "s4")], "k string, batch string, id string")
    got = rows(notes.earlier_symbols(batches, symbols, own, ["k"], 3), "k", "batch", "id")
    assert got == sorted([("a", "w", "s5"), ("a", "w", "s3"), ("a", "w", "s2"), (None, "w", "s3"), (None, "w", "s2"), (None, "w", "s1")], key=str)


def test_payload_parts(spark):
    probes = spark.createDataFrame([("w", "r1", "xaby"), ("w", "r2", "zzz")], "w string, id string, probe string")
    symbols = spark.createDataFrame([("w", "a", 1), ("w", "b", 2), ("w", "x", 3), ("w", "", 4)], "w string, symbol string, place int")
    assert rows(notes.relevant_symbols(probes, symbols, ["w"], 2, 1), "id", "symbol") == [("r1", "b"), ("r1", "x"), ("r2", "")]
    one = spark.createDataFrame([("w", " r ", True, "a"), ("w", None, True, "a"), ("w", "", True, "a")], "w string, ref string, direct boolean, origin string")
    two = spark.createDataFrame([("w", "r", False, "b"), ("w", "s", False, "b")], "w string, ref string, direct boolean, origin string")
    assert rows(notes.first_references([one, two], ["w"]), "ref", "direct", "origin") == [("r", True, "a"), ("s", False, "b")]
    line = spark.createDataFrame([("w", f"{i}", i, i in (0, 1), i in (3, 4)) for i in range(6)] + [("v", f"{i}", i, False, False) for i in range(6)], "w string, id string, pos int, of_left boolean, of_right boolean")
    assert rows(notes.across_boundary(line, ["w"], 1), "w", "id") == [("v", "1"), ("v", "2"), ("v", "3"), ("v", "4"), ("w", "1"), ("w", "3")]
    times = spark.createDataFrame([([1, 5, 9],), ([50, 20],), ([],), ([None, 40, 20],)], "t array<bigint>")
    assert [r[0] for r in times.select(notes.local_or_nearest("t", F.lit(4), F.lit(56))).collect()] == [[5, 9], [50, 20], [], [40, 20]]
    assert [r[0] for r in times.select(notes.local_or_nearest("t", F.lit(29), F.lit(31))).collect()] == [[9], [20], [], [40]]


def test_assembly(spark):
    parts = spark.createDataFrame([("k", 2, ["c"], ["x"]), ("k", 1, ["a", "b"], ["y", "x"]), (None, 1, None, None)], "k string, n int, r array<string>, u array<string>")
    assert rows(notes.concatenated(parts, ["k"], "n", "r", "u"), "k", "r", "u") == [("k", ["a", "b", "c"], ["y", "x"]), (None, [], [])]
    outline = spark.createDataFrame([(None, "s", 1, "e1"), (None, "s", 2, "e2")], "k string, section string, place int, episode string")
    found = spark.createDataFrame([(None, "e2", 3)], "k string, episode string, blocks bigint")
    assert rows(notes.assembled(outline, found, ["k"]), "section", "blocks", "missing") == [("s", 3, ["e1"])]
    assert [r[0] for r in spark.range(1).select(notes.sample_offsets(F.lit(3.0), F.lit(1.0), 9)).collect()] == [[-3.0, -2.0, -1.0, 0.0, 1.0, 2.0, 3.0]]
    assert [r[0] for r in spark.range(1).select(notes.sample_offsets(F.lit(3.0), F.lit(1.0), 4)).collect()] == [[-3.0, 0.0, 3.0]]


def test_candidates_and_corrections(spark):
    records = spark.createDataFrame([(None, "o", "x", 0.5), ("k", "p", None, 0.9)], "k string, id string, content string, confidence double")
    drafts = spark.createDataFrame([(None, "o", 1, "x", 0.7), (None, "o", 2, "y", 0.1), (None, "o", 3, "y", 0.9), (None, "o", 4, "z", 0.2), (None, "o", 5, "w", 0.2)], "k string, id string, place int, content string, score double")
    got = rows(notes.candidate_sets(records, drafts, ["k"], 4).where("id = 'o'").withColumn("score", F.round("score", 3)), "candidate", "score")
    assert got == [("o:model2", 0.1), ("o:model4", 0.2), ("o:null", -0.5), ("o:source", 0.7)]
    blocks = spark.createDataFrame([(None, 0, "a"), (None, 1, "b")], "k string, block_no int, latex string")
    fixes = spark.createDataFrame([(None, 0, "A", 0.9, 1), (None, 0, "B", 0.9, 2), (None, 1, " b ", 0.9, 3), (None, 1, " ", 0.9, 4), (None, 7, "c", 0.9, 5), (None, 1, "c", 0.1, 6)], "k string, block_no int, latex string, confidence double, place int")
    got = rows(notes.corrected(blocks, fixes, ["k"], 0.5), "block_no", "latex", "fixes", "outcome")
    assert got == sorted([(0, "B", 2, None), (1, "b", 0, None), (1, " ", 0, "empty"), (7, "c", 0, "no such block"), (1, "c", 0, "not sure enough")], key=str)


def test_plans_and_blocks(spark):
    expected = spark.createDataFrame([("s", x, i) for i, x in enumerate("abcdef")], "s string, id string, pos int")
    plan = spark.createDataFrame([("s", 1, 0, "a"), ("s", 1, 1, "b"), ("s", 2, 0, "d"), ("s", 2, 1, "c"), ("s", 3, 0, "e"), ("s", 4, 0, "e"), ("s", 3, 1, "f"), ("s", 3, 2, "zz")], "s string, block int, place int, id string")
    assert rows(notes.canonical_groups(expected, plan, ["s"]), "id", "group_no") == [("a", 0), ("b", 0), ("c", 1), ("d", 2), ("e", 3), ("f", 4)]
    planned = spark.createDataFrame([("b", "x", 0), ("b", "y", 1), ("c", "x", 0)], "k string, id string, pos int")
    said = spark.createDataFrame([("b", 0, "y"), ("b", 1, "x"), ("b", 2, "q"), ("c", 0, "x")], "k string, place int, id string")
    assert rows(notes.block_faults(planned, said, ["k"]), "k", "foreign", "missing", "in_order") == [("b", 1, 0, False), ("c", 0, 0, True)]
    items = spark.createDataFrame([("k", 1, "claim", ["a"], False), ("k", 2, "retraction", ["a"], False), ("k", 3, "claim", ["gone"], False), ("k", 4, "equation", ["a"], True), ("k", 5, "claim", [], False)], "k string, place int, kind string, cited array<string>, is_formula boolean")
    allowed = spark.createDataFrame([("k", "a", None)], "k string, id string, latex string")
    assert rows(notes.plan_faults(items, allowed, ["k"]), "place", "fault") == [(2, "no statement"), (3, "cites what is not there"), (4, "no formula")]


def test_marks_and_quotas(spark):
    ids = spark.createDataFrame([(["x", "audit:no", "audit:0.8"],), (["audit:0.79", "audit:1"],), ([],), (None,)], "ids array<string>")
    assert [r[0] for r in ids.select(notes.marked_unsafe(F.col("ids"), ("audit:",))).collect()] == [True, False, False, False]
    evidence = spark.createDataFrame([("k", f"e{i}", f"a{i}", "crop", i / 10) for i in range(8)] + [("k", "n", "", "crop", 0.9), ("k", "m", "am", "face", 0.9)], "k string, id string, asset string, kind string, confidence double")
    free = notes.eligible(evidence, spark.createDataFrame([("k", "a7")], "k string, asset string"), ["k"], ("crop",), 0.4)
    assert rows(free, "asset", "rank") == [("a4", 3), ("a5", 2), ("a6", 1)]
    unsafe = spark.createDataFrame([("k", f"b{i}", i) for i in range(3)], "k string, id string, place int")
    assert rows(notes.replacements(unsafe, free, ["k"], 2), "block_id", "asset") == [("b0", "a6"), ("b1", "a5"), ("b2", None)]


def test_artifacts_are_united(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1", "v": "y"}\n{"id": "1", "v": "x"}\n{broken\n{"id": "2", "v": null}\n')
    (tmp_path / "b.json").write_text('{"id": "1", "v": "x"}\n')
    got = literature.united_artifacts(spark, str(tmp_path), "id string, v string", ["id"], "v")
    assert rows(got, "id", "vs") == [("1", ["x", "y"]), ("2", [])]
