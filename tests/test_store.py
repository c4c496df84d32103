import json

import pytest
from pyspark.sql import functions as F

from slatemill.operators import evaluation as E
from slatemill.operators import store as S
from slatemill.operators.components import components
from slatemill.sources import files, sinks
from slatemill.streaming import outbox


def test_lineage_with_diamond_cycle_and_dangling(spark, rows):
    edges = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("a", "gone"), ("x", "y"), ("y", "x"), ("d", "b"), (None, "a"), ("q", None)], "child string, parent string")
    got = rows(S.lineage(edges, spark.createDataFrame([("d",), ("x",)], "start string")))
    assert got == {("d", "b", 1), ("d", "c", 1), ("d", "a", 2), ("d", "gone", 3), ("x", "y", 1)}
    assert S.lineage(edges.limit(0)).count() == 0


def test_components(spark, rows):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("z1", "z2"), ("z2", "z1"), ("s", "s"), (None, "q")]
    got = dict(rows(components(spark.createDataFrame(chain, "u string, v string"))))
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"} and got["z2"] == "z1" and "s" not in got
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_writes(spark, rows):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert rows(S.ensure(spark.createDataFrame([("b", 9), ("c", 3), ("c", 3), (None, 4)], "k string, v int"), old, ["k"])) == {("c", 3)}
    assert rows(S.upsert(old, spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int"), ["k"])) == {("a", 1), ("b", 9), ("c", 3)}
    assert rows(S.row_difference(old, old.filter("k = 'a'"))) == {("b", 2, "left")}
    again = S.consistency(S.fingerprint(old, "t", ["k", "v"]), S.fingerprint(old.orderBy(F.desc("k")), "t", ["k", "v"]))
    assert again.first()["consistent"] is True
    assert S.consistency(S.fingerprint(old, "t", ["k", "v"]), S.fingerprint(old.union(old), "t", ["k", "v"])).first()["consistent"] is False
    nodes = spark.createDataFrame([("l:n1:rev:1", None), ("l:n2:rev:1", "l:n1:rev:1"), ("l:n1:rev:2", None)], "id string, up string")
    assert rows(S.clone_revision(nodes, "id", "up", ":rev:1", ":rev:3")) == {("l:n1:rev:3", None), ("l:n2:rev:3", "l:n1:rev:3")}


def test_blank_hits_and_last_wins(spark):
    gold = spark.createDataFrame([("q1", "s", "g", "k1", "l1", "m", None), ("q2", "s", "g", "k2", "l2", "m", "p"), ("q3", None, None, "k3", "l", "m", "p")], "test_question_id string, stage string, grade string, knowledge_id string, lesson_id string, module string, min_knowledge_point string")
    found = spark.createDataFrame([("q1", ["zz"], "a", 0), ("q2", ["k2"], "a", 0), ("q2", ["k1"], "b", 0)], "test_question_id string, knowledge_ids array<string>, file string, pos int")
    catalog = spark.createDataFrame([("k1", "l1", "m", "p1"), ("k2", "l2", "m", "p")], "knowledge_id string, lesson_id string, module string, min_knowledge_point string")
    got = {r["test_question_id"]: r for r in E.hits(gold, found, catalog).collect()}
    assert got["q1"]["point_hit"] and not got["q1"]["lesson_hit"]  # blank agrees with blank
    assert not got["q2"]["knowledge_hit"] and got["q2"]["module_hit"] and not got["q3"]["predicted"]
    assert not {r["test_question_id"]: r for r in E.hits(gold, found, catalog, strict=True).collect()}["q1"]["point_hit"]
    assert E.rates(E.hits(gold.limit(0), found, catalog)).first()["point_rate"] == 0.0


def test_sources_and_sinks(spark, tmp_path, rows):
    (tmp_path / "predictions_chunk_1.json").write_text('﻿{"predictions": [{"question_id": "a"}, {"question_id": "b"}]}')
    (tmp_path / "predictions_chunk_2.json").write_text('[{"question_id": "c"}]')
    (tmp_path / "predictions_chunk_3.json").write_text('"none"')
    got = rows(files.prediction_chunks(spark, f"{tmp_path}/predictions_chunk_*.json", "question_id string"), "file", "pos", "question_id")
    assert got == {("predictions_chunk_1.json", 0, "a"), ("predictions_chunk_1.json", 1, "b"), ("predictions_chunk_2.json", 0, "c")}
    assert files.json_documents(spark, f"{tmp_path}/missing.json", "a string").count() == 0
    js = spark.createDataFrame([('window.DATA = {"a": [1, 2]};\n',)], "t string")
    assert files.assigned_json(js, "t", "a array<int>").first()["data"]["a"] == [1, 2]
    assert files.small_yaml("a: 1\nb:\n  c: 'x'  # note\n  d: true\ne:\n  - 1\n  - two\n") == {"a": 1, "b": {"c": "x", "d": True}, "e": [1, "two"]}
    (tmp_path / "m.tsv").write_text("数学\tok\tpages=15\theader=a\tvisual=b\tp.pdf\n")
    assert files.manifest(spark, f"{tmp_path}/m.tsv").first()["pages"] == 15
    lines = files.text_lines(spark.createDataFrame([("d", "a\r\n\n 12 \nb　")], "d string, t string"), ["d"], "t")
    assert rows(lines) == {("d", 1, "a"), ("d", 4, "b")}

    root, df = f"file://{tmp_path}/store", spark.createDataFrame([(1,)], "x int")
    assert sinks.current(spark, root) is None and sinks.snapshot({"t": df}, root) == "v00000001"
    assert sinks.snapshot({"t": df.union(df)}, root, expected="v00000001") == "v00000002" and sinks.read_snapshot(spark, root, "t").count() == 2
    with pytest.raises(RuntimeError):
        sinks.snapshot({"t": df}, root, expected="v00000001")
    made = sinks.write_chunks(spark.range(85).selectExpr("id"), ["id"], 40, f"file://{tmp_path}/chunks")
    assert rows(made, "chunk_no", "n_rows") == {(1, 40), (2, 40), (3, 5)}
    assert sinks.history(spark.range(40).selectExpr("id", "id t"), spark.createDataFrame([(99, 99)], "id long, t long"), "t").count() == 30


def test_streams_agree_with_batch(spark, tmp_path, rows):
    source = f"{tmp_path}/events"
    data = [(i % 9, f"2024-01-0{1 + i % 3} 0{i % 9}:00:00", i % 4, "ab"[i % 2], 1.0) for i in range(18)]
    batch = spark.createDataFrame(data, "event_id long, t string, user_id long, event_type string, value double").selectExpr("event_id", "cast(t as timestamp_ntz) ts", "user_id", "event_type", "value")
    batch.write.parquet(source)
    events = outbox.event_stream(spark, source, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")

    def run(df, name, mode):
        query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.table(name)

    want = rows(outbox.window_counts(batch.withColumn("ts", F.col("ts").cast("timestamp")), "1 day"))
    assert rows(run(outbox.window_counts(events, "1 day", "1 hour"), "counts", "complete")) == want
    assert run(outbox.deduplicated(events, "event_id", "10 days"), "once", "append").count() == 9
    late = rows(outbox.stalled(batch.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "2024-01-03 09:30:00", "2 HOURS"), "user_id", "status")
    assert late and all(s == "retry_wait" for _, s in late)
    sent = []
    outbox.dispatch(events, lambda df, n: sent.append((n, df.count())), f"{tmp_path}/d").awaitTermination()
    assert sum(n for _, n in sent) == 18
    stalled = run(outbox.stalled_stream(events, "user_id", 3_600_000, "1 second"), "stalled", "append")
    last = max(t for _, t, *_ in data)
    beats = {u: max(t for _, t, v, *_ in data if v == u) for u in range(4)}
    assert {r["user_id"] for r in stalled.collect()} == {u for u, t in beats.items() if t[:13] < last[:13]} and all(r["status"] == "retry_wait" for r in stalled.collect())


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 120
    json.dumps(entry.oracle_sql())
