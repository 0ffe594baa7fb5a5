import random

import xxhash
from pyspark.sql import functions as F

from quarryline.llm.splitting import cut_points, part_of, place_parts, split_oversized


def check(text, limit, overlap, ends):
    pieces = cut_points(text, limit, overlap, ends)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text) and pieces[-1][2] == "end"
    assert all(0 < e - b <= limit for b, e, _ in pieces) or not text
    assert all(b2 == e1 - overlap for (_, e1, _), (b2, _, _) in zip(pieces, pieces[1:]))
    assert text[: pieces[0][1]] + "".join(text[b + overlap : e] for b, e, _ in pieces[1:]) == text
    return pieces


def test_pieces_rebuild_any_text():
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choice("ab  .\nя🙂") for _ in range(rng.randrange(300)))
        limit = rng.randint(2, 60)
        check(text, limit, rng.randrange(limit), [i for i in range(len(text)) if rng.random() < 0.05])


def test_order_of_boundaries():
    assert check("aaaa. bbbb cccc", 12, 0, [])[0] == (0, 11, "word")
    assert check("aaaaaa. bb cc dddddddd", 12, 0, [])[0] == (0, 8, "sentence")
    assert check("aaaaaa. bb cc dddddddd", 12, 0, [7])[0] == (0, 7, "part")
    assert check("aaaaaa bbbbbbb", 12, 0, [])[0] == (0, 7, "word")
    assert check("a" * 30, 12, 3, [])[0] == (0, 12, "hard")


def test_parts_are_verified():
    text = "one\ntwo\nxxx"
    part = lambda i, t: {"id": i, "size": len(t), "hash": xxhash.xxh64_intdigest(t.encode(), seed=42)}
    assert place_parts(text, [part("a", "one"), part("e", ""), part("b", "two"), part("c", "yyy")]) == [("a", 0, 3), ("b", 4, 7), ("c", 8, 8)]


def test_tables(spark):
    texts = [f"{chr(97 + i) * 30}" for i in range(10)]
    parts = spark.createDataFrame([("k", i, f"s{i}", t) for i, t in enumerate(texts)], "k string, n int, id string, t string")
    listed = parts.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("n", part_of(F.col("id"), F.col("t")).alias("p")))).alias("l")).select("k", F.transform("l", lambda x: x["p"]).alias("parts"))
    whole = spark.createDataFrame([("k", "\n".join(texts), "clash"), ("short", "abc", ""), ("null", None, ""), ("empty", "", "")], "k string, text string, piece_no string")
    rows = split_oversized(whole.join(listed, "k", "left"), ["k"], 100, 10).orderBy("piece_no").collect()
    assert {r["k"] for r in rows} == {"k"} and [r["piece_no"] for r in rows] == list(range(1, len(rows) + 1))
    assert rows[0]["part_ids"] == ["s0", "s1", "s2"] and rows[0]["cut_kind"] == "part"
    for r in rows:
        assert set(r["part_ids"]) == {f"s{i}" for i in range(10) if 31 * i < r["end_pos"] and 31 * i + 30 > r["begin_pos"]}
