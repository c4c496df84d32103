from pyspark.sql import functions as F

from slatemill.operators import ordered as O


def frame(spark, values, ddl):
    return spark.createDataFrame(values, ddl)


def test_forward_fill_and_segments_cross_pages(spark, rows):
    df = frame(spark, [("d", 1, 1, None), ("d", 1, 2, "A"), ("d", 2, 1, None), ("d", 3, 1, "B"), ("d", 3, 2, None), ("e", 1, 1, None)], "doc string, page int, pos int, h string")
    filled = O.forward_fill(df, ["doc"], "page", ["pos"], F.col("h"), "s")
    assert rows(filled, "doc", "page", "pos", "s") == {("d", 1, 1, None), ("d", 1, 2, "A"), ("d", 2, 1, "A"), ("d", 3, 1, "B"), ("d", 3, 2, "B"), ("e", 1, 1, None)}
    marked = O.segment_number(df, ["doc"], "page", ["pos"], F.col("h").isNotNull(), "n")
    assert rows(marked, "doc", "page", "pos", "n") == {("d", 1, 1, 0), ("d", 1, 2, 1), ("d", 2, 1, 1), ("d", 3, 1, 2), ("d", 3, 2, 2), ("e", 1, 1, 0)}


def test_folds(spark):
    nums = frame(spark, [("g", i, n) for i, n in enumerate([1, 5, 2, 2, 3, 9, 4])] + [("h", 0, 2), ("h", 1, None)], "g string, i int, n int")
    assert sorted(r["n"] for r in O.counting(nums, ["g"], ["i"], "n").collect()) == [1, 2, 3, 4]
    places = frame(spark, [("g", y) for y in (0, 10, 20, 30, 100)] + [("g", None)], "g string, y int")
    assert sorted(r["y"] for r in O.spaced(places, ["g"], "y", 12).collect()) == [0, 20, 100]
    assert O.spaced(places.limit(0), ["g"], "y", 12).count() == 0


def test_numbers_as_of_containing_runs(spark, rows):
    df = spark.range(1000).selectExpr("id % 7 a", "id")
    got = O.numbered(df, ["a", "id"]).orderBy("row_no").collect()
    assert [r["row_no"] for r in got] == list(range(1, 1001)) and [(r["a"], r["id"]) for r in got] == sorted((r["a"], r["id"]) for r in got)
    left = frame(spark, [("k", 5), ("k", 0), ("k", None), ("z", 9)], "k string, t int")
    right = frame(spark, [("k", 1, "x"), ("k", 5, "y"), ("k", 5, "w"), ("k", None, "n")], "k string, u int, v string")
    assert rows(O.as_of(left, right, ["k"], "t", "u", ["v"])) == {("k", 5, "y"), ("k", 0, None), ("k", None, None), ("z", 9, None)}
    points, spans = frame(spark, [("d", 1.0), ("d", 99.0), ("d", None)], "d string, y double"), frame(spark, [("d", 0.0, 50.0, "s"), ("d", 1.0, 1.0, "t"), ("d", 9.0, 1.0, "bad")], "d string, a double, b double, n string")
    assert rows(O.containing(points, spans, ["d"], "y", "a", "b", 10.0, ["n"]), "y", "n") == {(1.0, "s"), (1.0, "t")}
    assert rows(O.runs(frame(spark, [("g", 1, "a"), ("g", 2, "a"), ("g", 3, None), ("g", 4, None), ("g", 5, "a")], "g string, i int, k string"), ["g"], ["i"], F.col("k"), "r"), "i", "r") == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 3)}


def test_first_or_later(spark, rows):
    df = frame(spark, [("a", "q2"), ("a", "q1"), ("a", "q3"), (None, "q5"), (None, "q4"), ("b", "q6")], "g string, k string")
    assert rows(O.first_or_later(df, "g", "k", "n"), "k", "n") == {("q1", 1), ("q2", 2), ("q3", 2), ("q4", 1), ("q5", 2), ("q6", 1)}


def test_parts_parents_and_changes(spark, rows):
    parts = frame(spark, [("g", i, k, n) for i, (k, n) in enumerate([("practice", "练习"), ("practice", "练习（续）"), ("practice", "练习"), ("checkpoint", "考点"), ("practice", "练习（续）"), ("example", "例（续）"), ("example", "例（续）"), ("example", None)])], "g string, i int, kind string, label string")
    got = O.groups_of_parts(parts, ["g"], ["i"], "kind", "label", ("practice", "example"), "no")
    assert rows(got, "i", "no") == {(0, 1), (1, 1), (2, 2), (4, 3), (5, 4), (6, 4), (7, 5)}
    points, spans = frame(spark, [("d", 5.0, "p"), ("d", 99.0, "q")], "d string, y double, k string"), frame(spark, [("d", 0.0, 50.0, "s"), ("d", 4.0, 6.0, "t")], "d string, a double, b double, n string")
    assert rows(O.first_parent(points, spans, ["d"], "y", "a", "b", "n", "k", 10.0)) == {("p", "s")}
    assert rows(O.changes(frame(spark, [("g", 1, "a"), ("g", 2, "a"), ("g", 3, "b"), ("h", 1, "b")], "g string, i int, v string"), ["g"], ["i"], F.col("v")), "g", "i") == {("g", 1), ("g", 3), ("h", 1)}
    ends = frame(spark, [(5, 9), (12, 9), (None, 9)], "e int, p int")
    assert sorted(r[0] for r in ends.select(O.clipped_end(F.col("e"), F.col("p"))).collect()) == [5, 9, 9]
