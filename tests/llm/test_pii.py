import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.llm import pii
from quarryline.llm.pii import dawid_skene, find, redact

#: (text, [(type, item)]): items are found by their text, so positions need not be counted by hand.
LABELLED = [
    ("Write to jane.doe+x@mail.example.org or +44 20 7946 0958.", [("email", "jane.doe+x@mail.example.org"), ("phone", "+44 20 7946 0958")]),
    ("reach me under owen dot hartwell at stud dot example dot net", [("email", "owen dot hartwell at stud dot example dot net")]),
    ("пишите на lev точка petrov собака math точка example", [("email", "lev точка petrov собака math точка example")]),
    ("the product x@y is 3, see eq@12.3 and @handle_bot", []),
    ("Звоните 8 (812) 000-25-81, если закрыто.", [("phone", "8 (812) 000-25-81")]),
    ("Call six one seven, five five five, zero one two six now", [("phone", "six one seven, five five five, zero one two six")]),
    ("Appelez le 01 99 00 95 40.", [("phone", "01 99 00 95 40")]),
    ("Bitte (030) 23125 909 anrufen.", [("phone", "(030) 23125 909")]),
    ("Paid by Helen Hartwell (SSN 666-12-3456).", [("person_name", "Helen Hartwell"), ("id_number", "666-12-3456")]),
    ("СНИЛС 000-742-621 49 и паспорт 00 71 № 768784", [("id_number", "000-742-621 49"), ("id_number", "00 71 № 768784")]),
    ("Matrix 0 331 482 x 12 entries, ISBN 000-0-00-012345-6 (draft)", []),
    ("Use 1 000 000 000 points and 212 steps of 555 ms.", []),
    ("Send the sheets to Flat 5, 12B Orchard Hill Road, Northtown.", [("address", "Flat 5, 12B Orchard Hill Road, Northtown")]),
    ("Живёт она тут: г. Речной, ул. Садовая, д. 31, кв. 57, телефон тот же", [("address", "г. Речной, ул. Садовая, д. 31, кв. 57")]),
    ("Sprechstunde: Anke Hartwell, 00042 Neustadt, Gartenweg 7b, heute", [("person_name", "Anke Hartwell"), ("address", "00042 Neustadt, Gartenweg 7b")]),
    ("Copies à déposer au 17 bis, rue des Tilleuls, 00020 Orville", [("address", "17 bis, rue des Tilleuls, 00020 Orville")]),
    ("we thank Prof. Hartwell, Ruth for the scan", [("person_name", "Hartwell, Ruth")]),
    ("and then ruth hartwell asked why", [("person_name", "ruth hartwell")]),
    ("ключ отдали так: Глеб Петрович (8 495 000 48 95)", [("person_name", "Глеб Петрович"), ("phone", "8 495 000 48 95")]),
    ("Anna is the name of the algorithm's variable; the Hartwell lemma and Dorsk's theorem hold.", []),
    ("", []),
]


FAR = [
    "reach lev точка petrov собака math точка example", "owen.hartwell (at) stud (dot) example (dot) net", "OWEN AT STUD DOT EXAMPLE", "x klammeraffe y punkt de", "a@b.de",
]


@pytest.mark.parametrize("text", FAR)
def test_no_email_is_skipped_for_want_of_a_hint(text):
    found = list(pii._TOKEN.finditer(text))
    assert pii._EMAIL.search(text) and pii._may_hold_email(text, found, [pii._FLAGS[m.group()] for m in found])


def _corpus(spark, copies):
    heads = [f"{g} Zelinkova {v} the proof" for g, v in zip(("Ruth", "Anna", "Clara", "Helen", "Nora"), ("wrote", "found", "checked", "read", "sent"))]
    texts = [*heads, "and then ruth zelinkova asked why", *[f"the {w} set is open and the map is closed" for w in "abcdefghij"], *[f"Jorunn {s} came" for s in ("Zelinkova", "Hartwell", "Zelinkova")], "Ruth Hartwell left", "Jorunn Kvalheim came late", "Prof. Kvalheim"]
    rows = [(i + 1000 * n, t) for n in range(copies) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "d bigint, text string")


def test_names_do_not_depend_on_the_size_of_the_corpus(spark):
    found = []
    for copies in (1, 2, 10, 100):
        got = {(r["d"] % 1000, r["pii_type"], r["begin_pos"], r["end_pos"]) for r in find(_corpus(spark, copies).repartition(4), "d").collect()}
        found.append(got)
    assert all(f == found[0] for f in found)
    assert (5, "person_name", 9, 23) in found[0]  # ruth zelinkova, in lower case
    assert (20, "person_name", 0, 15) in found[0]  # after a given name that is learned


def test_lexicon_beyond_the_broadcast(spark):
    documents = _corpus(spark, 3)
    assert sorted(map(tuple, find(documents, "d", lexicon_words=0).collect())) == sorted(map(tuple, find(documents, "d").collect()))


def test_null_and_repeated_ids_are_redacted(spark):
    texts = [r["text"] for r in _corpus(spark, 1).collect()]
    rows = [(None, "Write to jane.doe@mail.example.org now"), (7, "Write to jane.doe@mail.example.org now"), (7, "Nothing personal at all here"), (7, "call +44 20 7946 0958 please"), (None, None), (8, "")]
    frame = spark.createDataFrame([*rows, *((i + 100, t) for i, t in enumerate(texts))], "d bigint, text string").withColumn("items", F.lit("clash"))
    got = sorted((str(r["d"]), str(r["text"])) for r in redact(frame, "d").collect() if r["d"] is None or r["d"] < 100)
    assert got == sorted([("None", "Write to [EMAIL] now"), ("7", "Write to [EMAIL] now"), ("7", "Nothing personal at all here"), ("7", "call [PHONE] please"), ("None", "None"), ("8", "")])


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, "x") for i, (t, _) in enumerate(LABELLED * 12)]
    return spark.createDataFrame([*rows, (10_000, None, "x")], "d bigint, text string, kind string")


def test_items_and_places(documents):
    got = {(r["d"], r["pii_type"], r["begin_pos"], r["end_pos"]) for r in find(documents, "d").collect()}
    want = {(i, kind, t.index(item), t.index(item) + len(item)) for i, (t, items) in enumerate(LABELLED * 12) for kind, item in items}
    assert got == want


def test_redaction_keeps_the_rest(documents):
    rows = {r["d"]: r["text"] for r in redact(documents, "d").collect()}
    assert rows[0] == "Write to [EMAIL] or [PHONE]." and rows[3] == LABELLED[3][0] and rows[10_000] is None
    assert rows[8] == "Paid by [PERSON_NAME] (SSN [ID_NUMBER])." and rows[len(LABELLED) - 1] == ""


def test_empty_table(documents):
    assert find(documents.limit(0), "d").collect() == []


#: Addresses whose only sign of one is an abbreviation, a place or a preposition.
BARE = ["Kelmoorstr. 66b, 00047 Orvathstadt", "Orvather Straße 142", "00024 Neustadt, Alte Gasse 63b", "Lange Str. 5, 00040 Neustadt", "12 av. Foch, 00020 Orville", "An der Lohe 5", "Auf dem Berg 12", "Zur Mühle 3a", "город Речной, Садовая, д. 5", "г. Речной, Садовая, д. 5", "000042, Садовая, д. 5", "Садовая, 5-12", "Садовая наб. 7", "12 Orchard Hill Rd", "Gartenweg 7b", "17 bis, rue des Tilleuls"]


@pytest.mark.parametrize("address", BARE)
def test_no_address_is_skipped_for_want_of_a_hint(address):
    for text in (address, f"x\n{address}\n(x)", address.lower(), address.upper()):
        if pii._ADDRESS.search(text):
            found = list(pii._TOKEN.finditer(text))
            assert pii._may_hold_address(text, found, [pii._FLAGS[m.group()] for m in found])
    assert [(c.begin, c.end) for c in pii.candidates(f"x\n{address}\n(x)", pii.Lexicon({})) if c.kind == pii.ADDRESS] == [(2, 2 + len(address))]


def test_unpaired_dollars_hide_no_names():
    open_text = lambda t: pii._blank(t, list(pii._tex(t))).replace("\x00", "")
    assert open_text("pay 5$ now\nRuth Hartwell asks\n$x_1$ and $y$\nAnke Hartwell") == "pay 5$ now\nRuth Hartwell asks\n and \nAnke Hartwell"
    assert open_text("$5 says Ruth Hartwell. $x$ is 3") == "$5 says Ruth Hartwell.  is 3"
    assert open_text("US$5, Ruth Hartwell, 3$ and $x$") == "US$5, Ruth Hartwell, 3$ and "
    assert open_text("$" + "x+" * 300 + "y$\nRuth Hartwell asks\n$z$") == "\nRuth Hartwell asks\n"
    assert open_text("a $\\ker P = \\{z : Sw = 5v\\}$ b $$f\n= g$$ c \\$5 Ruth $\\operatorname{dist}(x, M)$") == "a  b  c \\$5 Ruth "
    lexicon = pii.Lexicon({})
    text = "cut $\\ge 2\nand Глеб Петрович asks\n$x$ and $y$"
    assert [text[c.begin : c.end] for c in pii.candidates(text, lexicon)] == ["Глеб Петрович"]


def test_em_recovers_reliable_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.6
    votes = np.zeros((4000, 5), int)
    for j, right in enumerate((0.95, 0.9, 0.9, 0.8, 0.7)):
        said = np.where(rng.random(4000) < right, truth, ~truth)
        votes[:, j] = np.where(rng.random(4000) < 0.8, np.where(said, 1, -1), 0)
    belief, _ = dawid_skene(votes, np.ones(4000))
    assert ((belief > 0.5) == truth).mean() > 0.93


def test_very_long_text():
    lexicon = pii.Lexicon({})
    text = "1 " * 100_000 + "a@b.example " * 2000 + "x" * 200_000
    assert sum(c.kind == "email" for c in pii.candidates(text, lexicon)) == 2000
