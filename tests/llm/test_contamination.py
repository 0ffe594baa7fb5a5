import random
import unicodedata

from quarryline.llm.contamination import Signatures, leaked_items, partitions, readings, words


def brute(docs, items, run):
    grams = lambda t: {tuple(w[i : i + run]) for w in readings(t) for i in range(len(w) - run + 1)}
    return {(i, d) for i, a in items for d, b in docs if grams(a) & grams(b)}


def test_words():
    assert words("Caf\u00e9 \\emph{na\u00efve}~x\u200by STRA\u00dfE") == ["cafe", "naive", "xy", "strasse"]
    assert words(unicodedata.normalize("NFD", "\u0451\u043b\u043a\u0430 caf\u00e9")) == words("\u0435\u043b\u043a\u0430 cafe")
    assert words("cros-\n sing") == ["crossing"] and readings("well-\nknown") == [["wellknown"], ["well", "known"]]
    assert words("a\\\\bc \\quad d") == ["a", "bc", "d"]
    assert readings(None) == [] and readings("") == []


def test_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([5, 11, 12, 40, 60])))) for i in range(30)]
    items += [(30, items[3][1]), (31, None), (32, "")]
    docs = []
    for d in range(150):
        body = rng.choices(vocabulary, k=rng.choice([0, 3, 50, 400]))
        if d % 2:
            passage = items[rng.randrange(30)][1].split()
            n = rng.choice([5, 11, 12, 13, 30])
            start = rng.randrange(max(1, len(passage) - n + 1))
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage[start : start + n]
        text = " ".join(body)
        docs.append((d, rng.choice([text, text.upper(), text.replace(" ", ",\n "), text.replace(" w", " \\textbf{w", 3)])))
    docs += [(503, "\u00bd " * 6), (504, "\u00bd " * 6 + "and more of it")]  # twelve words in eleven characters
    items += [(33, "\u00bd " * 12), (34, " ".join(rng.choices(vocabulary, k=15))), (35, " ".join(rng.choices(vocabulary, k=18)))]
    docs += [(505, "x y " + items[34][1] + " z"), (506, items[35][1].upper())]
    docs += [(500, None), (501, ""), (502, " ".join(rng.choices(vocabulary, k=20_000) + items[5][1].split() * 2))]
    df = spark.createDataFrame([(*d, "x") for d in docs], "d bigint, text string, item string")
    of = spark.createDataFrame([(*i, 1) for i in items], "i bigint, text string, doc int")
    want = brute(docs, items, 12)
    assert len(want) > 20
    for broadcast_rows in (1_000_000, 0):
        got = leaked_items(df, of, "d", "i", broadcast_rows=broadcast_rows).collect()
        assert {(r["i"], r["d"]) for r in got} == want and len(got) == len(want)
    assert leaked_items(df, of.limit(0), "d", "i").collect() == []
    assert leaked_items(df.limit(0), of, "d", "i").collect() == []


def test_partitions_follow_from_the_miss():
    for size, bands, rows in partitions(12, 5, 1e-6):
        least = 8 / (2 * (size - 4) - 8)
        assert (1 - least**rows) ** bands <= 1e-6 and bands * rows <= 64
    s = Signatures(12, 5, 1e-6)
    for n in (11, 12, 13, 14, 24, 25, 60, 100):
        for size, _, _ in s.parts:
            begins = s.cuts(n, size)
            assert all(any(b <= i and i + 12 <= b + size for b in begins) for i in range(n - 11)) and all(b + min(size, n) <= n for b in begins)


def test_mixed_hyphens(spark):
    item = "one well known exam ple is two three four five six seven eight nine ten"
    texts = ["one well-\nknown example is two three four five six seven eight nine", "one well-\nknown exam-\nple is two three four five six seven eight nine"]
    docs = spark.createDataFrame(list(enumerate(texts)), "d bigint, text string")
    items = spark.createDataFrame([(1, item.replace("exam ple", "example"))], "i bigint, text string")
    assert sorted(map(tuple, leaked_items(docs, items, "d", "i").collect())) == [(1, 0), (1, 1)]
    assert len(readings("a-\nb c-\nd e-\nf")) == 8
