"""Matched blocks, plain texts, broken headings and rule files by cases."""

import json

import pytest

from leafmark.operators import bindings
from leafmark.sources.tables import rules


def test_matched_texts(spark):
    have = spark.createDataFrame([(1, 1, "whole words"), (1, 2, "whole  words"), (1, 3, "abcd"), (1, 4, "some longer text here"), (1, 5, None), (2, 1, "alone here")], "page int, id long, text string")
    read = spark.createDataFrame([(1, 9, "some longer text"), (1, 10, "some longer text h"), (1, 11, "whole words"), (1, 12, "ole w"), (1, 13, "abcd"), (1, 14, "")], "page int, id long, text string")
    assert sorted(map(tuple, bindings.matched_texts(have, read).collect())) == [(1, 1, 11), (1, 4, 10)]
    assert bindings.matched_texts(have, read.limit(0)).count() == 0


def test_plain_text(spark):
    source = "# Head *one*\n\n\n\n> **bold** [link](a(b).png) &amp; `x_y`\n- item\n---\n<!-- gone -->\n| a | b\\|c |\n| --- | :---: |\n```py\n# kept *as is*\n```\n$$\n**m**\n$$\n2 < 3<br>4 \\* 5"
    want = "Head one\n\nbold link & x_y\nitem\na\tb|c\n# kept *as is*\n**m**\n2 < 3\n4 * 5\n"
    rows = spark.createDataFrame([(1, source), (2, None), (3, "")], "i int, t string").select("i", bindings.plain_text("t").alias("t")).orderBy("i").collect()
    assert [r.t for r in rows] == [want, None, "\n"]


def test_merged_headings(spark):
    line = lambda n, text, y, size=12.0, head=True: (1, n, head, 1, True, 10.0, y, 90.0, y + 12, size, text)
    rows = [line(1, "RESULTS OF", 0.0), line(2, "THE YEAR", 13.0), line(3, "1. Sales", 26.0), line(4, "body", 39.0, head=False), line(5, "OTHER", 52.0), line(6, "larger", 65.0, 20.0), line(7, "Ends.", 100.0), line(8, "Not joined", 113.0)]
    frame = spark.createDataFrame(rows, "doc int, n int, is_heading boolean, page int, bold boolean, x0 double, y0 double, x1 double, y1 double, size double, text string")
    assert [(r.n, r.lines, r.text) for r in bindings.merged_headings(frame).orderBy("n").collect()] == [(1, 2, "RESULTS OF THE YEAR"), (3, 1, "1. Sales"), (5, 1, "OTHER"), (6, 1, "larger"), (7, 1, "Ends."), (8, 1, "Not joined")]


def test_rules(spark, tmp_path):
    good = {"schema_version": "v1", "updated_at_utc": "2024-01-01T00:00:00Z", "curator": "me", "normalization_policy": "NFC_CASEFOLD", "approved_global_aliases": {"õf the": ["of the", {"alias": "of thé", "required_before": "and"}]}, "disallowed_false_positives": {}}
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(good, indent=1, ensure_ascii=False), encoding="utf-8")
    assert sorted(r.alias for r in rules(spark, str(path), "v1").collect()) == ["of the", "of thé"]
    bad = [good | {"more": 1}, good | {"schema_version": "v2"}, good | {"curator": " "}, good | {"disallowed_false_positives": {"õf the": ["of the"]}}, good | {"approved_global_aliases": {"a": [{"alias": "b", "other": 1}]}}]
    for text in [*map(json.dumps, bad), json.dumps(good).replace('"curator"', '"curator": "x", "curator"')]:
        path.write_text(text, encoding="utf-8")
        with pytest.raises(ValueError):
            rules(spark, str(path), "v1")
