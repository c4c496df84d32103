import pytest

from slatemill.operators import geometry as G
from slatemill.operators import lookup as L

DDL = "doc_id string, page int, x0 double, y0 double, x1 double, y1 double, text string"


def test_lines_and_starts(spark, rows):
    data = [("d", 1, 50.0, 100.0, 90.0, 110.0, "1．已知函数"), ("d", 1, 50.0, 106.0, 90.0, 116.0, "2．太近的一行"), ("d", 1, 50.0, 140.0, 60.0, 150.0, "4．设"), ("d", 1, 70.0, 141.0, 90.0, 150.0, "函数　的图象"), ("d", 1, 50.0, 180.0, 60.0, 190.0, "5．x"), ("d", 1, 400.0, 220.0, 450.0, 230.0, "6．在右边的题目"), ("d", 1, 60.0, 160.0, 80.0, 170.0, "A．1"), ("d", 1, 60.0, 170.0, 80.0, 180.0, "B．2"), ("d", 1, 60.0, 900.0, 80.0, 910.0, "12"), ("d", 1, 60.0, 30.0, 80.0, 40.0, " ")]
    lines = G.reading_order(spark.createDataFrame(data, DDL), 1.0)
    assert [r["text"] for r in lines.orderBy("line_no").collect()][:3] == ["1．已知函数", "2．太近的一行", "4．设"] and lines.count() == 9
    assert G.without_footers(lines, 960.0).count() == 8
    assert {r["text"]: r["tail"] for r in G.row_tails(lines).collect()}["4．设"] == "函数 的图象"
    starts = G.question_anchors(lines)
    assert {r["number"] for r in starts.collect()} == {1, 4}
    assert {r["number"]: r["has_options"] for r in G.with_options(lines, starts, 60.0).collect()} == {1: False, 4: True}
    assert G.question_anchors(lines.limit(0)).count() == 0


def test_component_kinds(spark):
    marks = spark.createDataFrame([("d", 1, 200), ("d", 1, 300), ("d", 2, 200), ("d", 2, 500), ("d", 3, 300), ("d", 4, 300), ("d", 4, 600), ("e", 2, 300)], "doc_id string, page int, y int")
    pages = spark.createDataFrame([("d", 2), ("d", 4)], "doc_id string, page int")
    got = [(r["doc_id"], r["page"], r["y"], r["kind"]) for r in G.component_kinds(marks, pages).orderBy("doc_id", "page", "y").collect()]
    assert [g[3] for g in got] == ["course_goal", "knowledge", "example", "practice", "practice", "example", "practice", "after_class"]


def test_lookups_and_stages(spark, rows, tmp_path):
    known = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert rows(L.strict_lookup(spark.createDataFrame([("b",)], "k string"), known, "k")) == {("b", 2)}
    with pytest.raises(KeyError):
        L.strict_lookup(spark.createDataFrame([("z",)], "k string"), known, "k")
    lists = spark.createDataFrame([("t", ["b", "z", "a"])], "tier string, ids array<string>")
    assert rows(L.ordered_lookup(lists, "ids", known, "k"), "tier", "k", "v", "place") == {("t", "b", 2, 1), ("t", "a", 1, 3)}
    made = []
    for _ in range(2):
        assert L.stage(f"file://{tmp_path}", "s", "1", lambda: made.append(1) or known).count() == 2
    assert made == [1]
