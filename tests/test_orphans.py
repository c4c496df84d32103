from datetime import datetime

from slatemill.operators.orphans import CHILD, PARENT, orphan_references, orphan_report

T = lambda d: datetime(2025, 1, d)
C, P = "ref_field string, parent_table string, row_id string, ref_key string, ref_time timestamp_ntz", "parent_table string, ref_key string, deleted boolean, key_time timestamp_ntz"


def test_reasons_in_order(spark, rows):
    children = [("f", "p", "1", "a", T(5)), ("f", "p", "2", " b　", T(5)), ("f", "p", "3", "c", T(5)), ("f", "p", "4", "d", T(5)), ("f", "p", "4", "d", T(5)), ("f", "p", "5", " ", T(5)), ("f", "p", "6", None, T(5)), ("f", "p", "7", "d", None), ("f", "q", "8", "a", T(5))]
    parents = [("p", "a", False, T(1)), ("p", "b", False, T(1)), ("p", "b", True, T(9)), ("p", "d", None, T(6)), ("p", "d", False, T(7)), ("p", None, True, T(1))]
    got = rows(orphan_references(spark.createDataFrame(children, C), spark.createDataFrame(parents, P)))
    assert got == {("f", "2", "b", "deleted", "2025-01"), ("f", "3", "c", "missing", "2025-01"), ("f", "4", "d", "late", "2025-01"), ("f", "8", "a", "missing", "2025-01")}


def test_hot_key_and_report(spark, rows):
    children = spark.range(3000).selectExpr("'f' ref_field", "'p' parent_table", "cast(id as string) row_id", "if(id % 3 = 0, 'hot', concat('k', id % 50)) ref_key", "timestamp_ntz'2025-02-01' ref_time", "'x' deleted", "1 n")
    parents = spark.createDataFrame([("p", f"k{i}", False, T(1)) for i in range(40)], P)
    got = orphan_references(children, parents)
    assert {r[0] for r in got.select("ref_key").distinct().collect()} == {"hot", *(f"k{i}" for i in range(40, 50))}
    assert got.count() == sum(i % 3 == 0 or i % 50 >= 40 for i in range(3000))
    assert orphan_report(got).collect()[0]["n_keys"] == 11


def test_empty(spark):
    empty = spark.createDataFrame([], C), spark.createDataFrame([], P)
    assert orphan_references(*empty).count() == 0
    assert set(CHILD) == set(empty[0].columns) and set(PARENT) == set(empty[1].columns)
