import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.functions import arrays as A
from quarryline.functions import likeness, loosejson, tex
from quarryline.functions import text as T
from quarryline.sources import literature, sinks


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"]).select(column.alias("x")).first()["x"]


def test_text(spark):
    col = F.col("t")
    assert one(spark, T.squeezed(col), t=" A b\tC ") == "abc" and one(spark, T.collapsed(col), t="  A  b ") == "a b"
    assert one(spark, T.clock(col), t=3725.5) == "01:02:05.500" and one(spark, T.clock(col), t=59.9996) == "01:00.000"
    assert one(spark, T.shortened(col, 15), t="abcdefghijklmnopqrst") == "abcde ... pqrst" and one(spark, T.shortened(col, 5), t="abcdefgh") == "abcde"
    assert one(spark, T.safe_id(col), t="../../req 1") == "req_1" and one(spark, T.safe_id(col), t="..") == "request"
    assert one(spark, T.sentences(col), t="One. Two! three? Да. Нет") == ["One.", "Two! three?", "Да.", "Нет"]
    assert one(spark, T.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b")))) == 0.5 and one(spark, T.jaccard(F.array(F.lit("a")), F.array().cast("array<string>"))) == 0
    assert one(spark, T.merged(F.array(F.lit("b"), F.lit(" "), F.lit(None)), F.array(F.lit("a"), F.lit("b")))) == ["b", "a"]
    assert [one(spark, T.cleanup_verdict(F.col("s"), col), s="x = 1 holds", t=t) for t in ("", "x = 1", "x = 2", "x = y 1")] == ["empty", "ok", "numbers", "new symbols"]


def test_restoring(spark):
    col = F.col("t")
    assert one(spark, T.restored_commands(col), t="\x08eta \theta\ta \x0crac 5\t6") == "\\beta \\theta\\ta \\frac 5\t6"
    assert one(spark, T.without(col, "board"), t="On the board. Kept. The board!") == "Kept." and one(spark, T.without(col, "board"), t="board") is None


def test_tex():
    assert tex.escaped("50% & a_b\\") == r"50\% \& a\_b\textbackslash{}"
    assert tex.escaped_outside_math("a_b $x_1$ c_d") == r"a\_b $x_1$ c\_d" and tex.escaped_outside_math("a_$b") == r"a\_\$b"
    assert tex.glyphs_in_math("a ≤ b and $x≤y$") == r"a \(\le\) b and $x\le y$"
    assert tex.outer_split(r"a;{b;c};\left(d;e\right);f", ";") == ["a", "{b;c}", r"\left(d;e\right)", "f"]
    long = "; ".join(["x_{1;2} + y"] * 9)
    assert tex.laid_out(long).count(r"\\") == 8 and tex.laid_out("a;b") == "a;b" and tex.laid_out("x" * 200) == "x" * 200
    assert tex.without_overlap("a" * 10 + "b" * 50, "b" * 50 + "c") == "a" * 10 + "b" * 50 + "c" and tex.without_overlap("ab ", " bc") == "ab\n\nbc"
    line = "one two three four five six seven eight nine ten"
    assert tex.without_overlap("start " + line, line.replace(" ", "\n", 3) + " more") == "start " + line + " more"


def test_json():
    assert loosejson.parsed('```json\n{"a": "\\alpha \t x"}\n```') == {"a": "\\alpha \t x"}
    assert loosejson.parsed('<think>{</think> sure: {"a": [1, 2]} done') == {"a": [1, 2]} and loosejson.parsed("no") is None
    assert [loosejson.cut_off(t) for t in ('{"a": 1}', '{"a": [1', '{"a": "x', '{"a": "x\\"', "", "[]]")] == [False, True, True, True, True, False]


def test_likeness(spark):
    assert likeness.coverage(likeness.latex_tokens(r"x + y = \left(2"), likeness.latex_tokens("x - y = (2")) == (5 / 6, ["+"])
    assert likeness.echoes("alpha beta gamma delta epsilon zeta eta theta", "alpha beta gamma delta epsilon zeta eta theta".split()) and not likeness.echoes("short", ["a", "b", "c"])
    df = spark.createDataFrame([("A b", "ab"), ("abc", "xyz"), (None, "a")], "a string, b string")
    assert [r[0] for r in df.select(likeness.text_ratio("a", "b")).collect()] == [1.0, 0.0, 0.0]


def test_arrays(spark):
    v = [1.0, 2.0, 3.0, 100.0]
    df = spark.createDataFrame([(v, [0.0, 5.0, 5.0, 0.0, 0.0, 5.0, 0.0, 5.0]), ([], [])], "v array<double>, w array<double>")
    rows = df.select(A.median(F.col("v")).alias("m"), A.robust(F.col("v")).alias("r"), A.runs(F.col("w"), 1.0, 1).alias("runs")).collect()
    assert rows[0]["m"] == 2.5 and rows[1]["m"] is None and rows[1]["runs"] == []
    assert np.allclose(rows[0]["r"], np.clip((np.array(v) - 2.5) / 1.4826, -6, 6)) and [tuple(x) for x in rows[0]["runs"]] == [(1, 2), (5, 7)]
    assert one(spark, A.iou(F.array(*map(F.lit, (0, 0, 10, 10))), F.array(*map(F.lit, (5, 0, 15, 10))))) == pytest.approx(1 / 3)
    still = np.zeros((8, 8), np.uint8)
    assert A.composite([still, still + 9, still]).max() == 0 and A.composite([still, still]) is None and A.occlusion(still, still) == 0
    assert A.edge_map(np.eye(8)).max() == 1 and A.distinct_states([0, 1, 0, 5, 1], [0, 1, 2, 3, 4], 4, 2) == [0, 3]


def test_sources_and_sinks(spark, tmp_path):
    folder = tmp_path / "lit"
    (folder / "sub").mkdir(parents=True)
    (folder / "a.txt").write_text("one  two\nthree")
    (folder / "sub" / "b.md").write_text(" \n ")
    (folder / "c.bin").write_text("no")
    assert [(r["piece_no"], r["text"]) for r in literature.literature(spark, str(folder), 8).orderBy("piece_no").collect()] == [(0, "one two "), (1, "three")]
    assert literature.files(spark, str(folder)).count() == 3
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "x.json").write_text('{"id": "a"}')
    (tmp_path / "j" / "y.json").write_text("{broken")
    assert [r["id"] for r in literature.artifacts(spark, str(tmp_path / "j"), "id string").collect()] == ["a"]
    blocks = spark.createDataFrame([("l", 2, "equation", None, "x"), ("l", 1, "lemma", "T", "y"), ("m", 1, "paragraph", None, None)], "l string, n int, t string, h string, b string")
    sinks.write_texts(blocks.withColumn("x", sinks.rendered(F.col("t"), F.col("h"), F.col("b"))), str(tmp_path / "out"), "l", ["n"], "x")
    text = "".join(p.read_text() for p in sorted((tmp_path / "out" / "l=l").glob("*.txt")))
    assert text == "\\begin{lemma}[T]\ny\n\\end{lemma}\n\\[\nx\n\\]\n"
    rows = spark.createDataFrame([("a", "f1"), ("b", "f2")], "k string, fingerprint string")
    assert [r["k"] for r in sinks.to_do(rows, rows.where("k = 'a'"), ["k"]).collect()] == ["b"]


def test_streams(spark, tmp_path):
    from quarryline.streaming import status

    rows = spark.createDataFrame([("u", "2024-01-01 00:00:00"), ("u", "2024-01-01 00:10:00"), ("u", "2024-01-01 02:00:00"), ("v", "2024-01-03 00:00:00")], "k string, t string").select("k", F.col("t").cast("timestamp").alias("t"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t timestamp").parquet(str(tmp_path / "in"))
    query = status.session_counts(stream, "k", "t").writeStream.format("memory").queryName("sessions").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted((r["k"], r["events"]) for r in spark.table("sessions").collect()) == [("u", 1), ("u", 2)]
    once = status.first_arrivals(stream, ["k"], "t").writeStream.format("memory").queryName("firsts").outputMode("append").trigger(availableNow=True).start()
    once.awaitTermination(120)
    assert sorted(r["k"] for r in spark.table("firsts").collect()) == ["u", "v"]


def test_layout_follows_the_weightiest_joints():
    items = ",".join(f"A_{{{i}}}" for i in range(1, 30))
    rows = tex.laid_out(items).split("\n")
    assert rows[0] == r"\begin{multlined}" and rows[-1] == r"\end{multlined}" and len(rows) == 5 and "".join(rows[1:-1]).replace(" \\\\", "").replace(" ", "") == items
    assert all(len(r) <= 78 + 3 for r in rows)
    chain = " = ".join(f"f_{{{i}}}(x) + g_{{{i}}}(x)" for i in range(6))
    assert tex.laid_out(chain).startswith("\\begin{aligned}\nf_{0}(x) + g_{0}(x) &=f_{1}(x)") and tex.laid_out(chain).count("&=") == 5
    assert "aligned" not in tex.laid_out(", ".join(f"x_{{{i}}} = {i}" for i in range(20)))  # a list of equalities is no chain
    step = r" \Longrightarrow ".join(["a" * 40, "b" * 40, "c" * 20])
    assert tex.laid_out(step).split("\n")[2] == r"&\Longrightarrow\ " + "b" * 40 + r" \\"
    braces = r"\tilde{\beta}=\left\{\,\bigcap_{k=1}^{m}V(x,\,\varphi_k,\,\varepsilon)\;\Big|\;x\in X,\;\varepsilon>0\,\right\}"
    assert tex.laid_out(braces, 24) == braces
    assert tex.laid_out(r"\frac{a;b}{c;d}+\frac{e;f}{g;h}", 10) == r"\frac{a;b}{c;d}+\frac{e;f}{g;h}"


def test_headings():
    assert tex.heading("Топология на X* и пространство H") == "Топология на $X^*$ и пространство $H$"
    assert tex.heading("Сходимость f_n к f") == "Сходимость $f_n$ к $f$"
    assert tex.heading(r"Связь \xi_n и \sigma_k") == r"Связь $\xi_n$ и $\sigma_k$"
    assert tex.heading("A norm on X and I") == "A norm on $X$ and I" and tex.heading("plain words") == "plain words"
    assert tex.heading(r"\(x ≤ y\) и $z$") == r"$x \le y$ и $z$"
    for symbol in "αβγδεϵζηθικλμνξοπρστυφϕχψωΓΔΘΛΞΠΣΦΨΩ":
        made = tex.heading(f"Сходимость {symbol}_n")
        assert made.count("$") == 2 and "_{n}" in made
