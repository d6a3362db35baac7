"""Cases of page, line and heading functions that the tables do not hold."""

from pyspark.sql import functions as F

from leafmark.functions import routing


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return row.select(column.alias("x")).first().x


def test_page_type_of_unknown_measures(spark):
    null = F.lit(None)
    assert one(spark, routing.page_type(null, null, null, null, null, null, null, null), t="") == "IMAGE_ONLY"
    assert one(spark, routing.page_type(F.col("c"), F.lit(5), null, null, null, null, null, F.lit(0.95)), c=399) == "PRODUCT_SHOWCASE_COLLAGE"
    assert one(spark, routing.page_type(F.col("c"), F.lit(1), F.lit(0.41), F.lit(False), null, null, null, F.lit(0.9)), c=400) == "MIXED"


def test_rejection(spark):
    gate = routing.rejection(F.col("t"), F.col("c"), ["the"])
    cases = [("the", 0.59, "REJECTED_LOW_CONFIDENCE"), ("", 0.9, "REJECTED_HALLUCINATION"), (None, 0.9, "REJECTED_HALLUCINATION"), ("l | -", 0.9, "REJECTED_HALLUCINATION"), ("...!", 0.9, "REJECTED_HALLUCINATION"), ("bcdfg", 0.9, "REJECTED_HALLUCINATION"),
             ("bcdf", 0.9, None), ("xq", 0.7, "REJECTED_HALLUCINATION"), ("12", 0.7, None), ("5 %", 0.7, None), ("(The)", 0.7, None), ("bcd", 0.7, "REJECTED_HALLUCINATION"), ("aei", None, "REJECTED_HALLUCINATION"), ("house", None, None), ("đb", None, None), ("q 5", 0.7, None)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, c double, want string")
    assert [(r.t, r.x) for r in rows.select("i", "t", gate.alias("x")).orderBy("i").collect()] == [(t, w) for t, _, w in cases]


def test_texts(spark):
    assert one(spark, routing.evaluation_lines(F.col("t")), t="# Trang 3 x\r\n\n> **Footer**: a  b\n---\n| :-- | - |\n| x | y |\n") == ["a b", "x | y"]
    assert one(spark, routing.evaluation_lines(F.lit(None)), t="") == []
    assert one(spark, routing.reading_text(F.col("t")), t=" a\r\n\tb\r") == "a b"
    assert one(spark, routing.reading_order_share(F.col("t"), F.lit(None)), t="a") == 1.0
    assert one(spark, routing.reading_order_share(F.col("t"), F.lit("second line of it all\nfirst line of it all")), t="first line of it all\nsecond line of it all") == 0.5
    assert one(spark, routing.with_strokes(F.col("t"), {"HDQT": "HĐQT"}), t="HDQT, XHDQT (HDQT)") == "HĐQT, XHDQT (HĐQT)"


def test_lines(spark):
    amounts = lambda t: one(spark, routing.trailing_amounts(F.col("t")), t=t)
    assert amounts("Tài sản 1.234 - (5)") == ["Tài sản", "1.234", "-", "(5)"]
    assert (amounts("Năm 2024"), amounts("12 13"), amounts("")) == (["Năm 2024"], ["12", "13"], [])
    number = lambda t: one(spark, routing.numbering(F.col("t")), t=t)
    assert (number("XLIV - A").kind, number("XLIV - A").path) == ("roman", [44])
    assert (number("PHỤ LỤC 12").path, number("Mục K").path, number("Đ. a").path) == ([12], [0], [272])
    assert number("2.3.1 Name").path == [2, 3, 1] and number("1. 2024") is None and number("plain") is None
    said = lambda t: tuple(one(spark, routing.language_evidence(F.col("t")), t=t))
    assert said("cong ty and cash flow") == ("unknown", "mixed_lexical_evidence") and said("the cash flow là") == ("vi", "vietnamese_character_ratio")
    assert said("the board") == ("en", "english_lexical_evidence") and said("the board ü") == ("unknown", "insufficient_lexical_evidence")


def test_glyph_noise_and_median(spark):
    lines = spark.createDataFrame([(1, ""), (1, None), (2, "I"), (2, "whole words here"), (3, "whole words here")], "page int, t string")
    assert {r.page: (r.lines, r.noise) for r in routing.glyph_noise(lines, "page", "t").collect()} == {1: (0, True), 2: (1 + 1, True), 3: (1, False)}
    sizes = spark.createDataFrame([(1, 7.0, 2), (1, 9.0, 2), (2, 5.0, 1), (2, 8.0, 2), (3, None, 1)], "k int, v double, w int")
    assert {r.k: r.median for r in routing.weighted_median(sizes, ["k"], "v", "w").collect()} == {1: 8.0, 2: 8.0}
