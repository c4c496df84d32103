import numpy as np
import pytest
from pyspark.sql import functions as F

from slatemill.functions import pixels
from slatemill.operators import graph as H
from slatemill.operators import store as S
from slatemill.plans.cut import cut, scratch, shared_dir
from slatemill.sources import docx, files, sinks


def test_tree_counts_repeated_names_once(spark, rows):
    points = spark.createDataFrame([("l", "题", "甲", "一", "k1"), ("l", "题", "甲", "二", "k2"), ("l", "题", "乙", "一", "k3"), ("l", "题", "乙", "三", "k4"), ("m", "别", None, "四", "k5")], "lesson_id string, lesson_title string, module string, point string, k string")
    got = {r["node_id"]: (r["node_type"], r["parent_id"], r["order_index"]) for r in H.seed_nodes(points).collect()}
    assert got["l:node:root"] == ("lesson", None, 0) and got["l:node:module:甲"][2] == 1 and got["l:node:checkpoint:一"] == ("exam_point", "l:node:module:甲", 2)
    assert got["l:node:module:乙"][2] == 4 and got["l:node:checkpoint:三"] == ("exam_point", "l:node:module:乙", 5) and got["m:node:module:unknown"][2] == 1 and len(got) == 9
    assert H.seed_nodes(points.limit(0)).count() == 0


def test_rerun_keeps_what_is_published(spark, rows):
    lessons = spark.createDataFrame([("l", "数学", "published", "l:rev:1", "l:rev:1"), ("m", "数学", "published", "gone", None)], "lesson_id string, subject string, status string, active_revision_id string, published_revision_id string")
    revisions = spark.createDataFrame([("l:rev:1", "l", 1), ("l:rev:4", "l", 4)], "lesson_revision_id string, lesson_id string, revision_no int")
    reruns = H.next_revisions(lessons, revisions)
    assert rows(reruns) == {("l", "l:rev:1", "l:rev:5", 5)}
    assert rows(H.move_active(lessons, reruns), "lesson_id", "active_revision_id", "published_revision_id", "status") == {("l", "l:rev:5", "l:rev:1", "reviewing"), ("m", "gone", None, "published")}
    tasks = spark.createDataFrame([("t1", "l:rev:1", "n1"), ("t2", "l:rev:4", "n1")], "task_id string, revision_id string, node_id string")
    assert rows(H.cloned_tasks(tasks, reruns)) == {("t1:rev:5", "t1", "l:rev:5", "n1:rev:5", "reviewing")}
    assert H.rerun_records(reruns).count() == 8
    stale = H.mark_stale(H.seed_artifacts(lessons), reruns)
    assert {r["artifact_type"] for r in stale.filter("lifecycle_status = 'stale'").collect()} == set(H.DERIVED) and stale.count() == 14


def test_decisions_and_publication_are_two_steps(spark, rows):
    reviews = spark.createDataFrame([("r1", "pending"), ("r2", "in_review"), ("r3", "pending")], "review_task_id string, status string")
    decide = lambda *d: H.decide(reviews, spark.createDataFrame(list(d), "review_task_id string, action string"))
    assert rows(decide(("r1", "approve"), ("r2", "request_changes"))) == {("r1", "approved"), ("r2", "changes_requested"), ("r3", "pending")}
    with pytest.raises(Exception, match="unsupported action"):
        decide(("r1", "burn")).collect()
    lessons = spark.createDataFrame([("l", "reviewing", "l:rev:2", "l:rev:1"), ("m", "reviewing", "m:rev:1", None)], "lesson_id string, status string, active_revision_id string, published_revision_id string")
    assert rows(H.publish(lessons, spark.createDataFrame([("l:rev:2",), ("l:rev:2",)], "lesson_revision_id string"))) == {("l", "published", "l:rev:2", "l:rev:2"), ("m", "reviewing", "m:rev:1", None)}


def test_exports_and_patches_again(spark, rows):
    lessons = spark.createDataFrame([("l",)], "lesson_id string")
    exports, artifacts = lessons.withColumn("history_id", F.lit("h")), H.seed_artifacts(lessons)
    none = spark.createDataFrame([], "run_id string, storage_uri string")
    made = H.register_exports(exports, none, artifacts)
    assert {(r["artifact_type"], r["parent_id"]) for r in made.collect()} == {("export_bundle_manifest", "l:reviewed_publishable_bundle"), ("export_file", "export_h/manifest.json")} and made.count() == 3
    assert H.register_exports(exports, made.select("run_id", "storage_uri"), artifacts).count() == 0
    patches = spark.createDataFrame([("p", "c", "pending"), ("q", "c", "accepted"), ("r", "c", "pending")], "patch_id string, component_id string, status string")
    assert rows(H.settle_patches(patches, spark.createDataFrame([("p", False), ("q", False)], "patch_id string, accepted boolean")), "patch_id", "status") == {("p", "rejected"), ("q", "accepted"), ("r", "pending")}


def test_answers_reviews_quality_readiness(spark, rows):
    texts = spark.createDataFrame([("题【答案】 B 【分析】因为",), ("题【答案】C",), ("无",), (None,)], "t string")
    assert [r[0] for r in texts.select(H.answer_between(F.col("t"))).collect()] == ["B", "C", None, None]
    questions = spark.createDataFrame([("a", "低"), ("b", "高"), ("c", "低")], "question_id string, risk string")
    assert rows(H.seed_reviews(questions, spark.createDataFrame([("c", "复核中")], "question_id string, queue_status string"))) == {("review_b", "b", "pending"), ("c", "c", "in_review")}
    quality = H.quality_rows(spark.createDataFrame([("g", 0), ("h", 2)], "group_id string, n_reviews int"))
    assert rows(quality.filter("check_code = 'Q2_visual_gate'"), "group_id", "score", "passed") == {("g", 94, True), ("h", 78, False)} and quality.count() == 8
    checks = spark.createDataFrame([("a", True, "failed"), ("a", False, "skipped"), ("b", False, "failed"), ("b", True, "skipped"), ("c", True, "passed"), ("d", None, None)], "k string, required boolean, status string")
    assert rows(H.readiness(checks, ["k"])) == {("a", "NOT_READY"), ("b", "CONDITIONALLY_READY"), ("c", "READY"), ("d", "READY")}


def test_deep_lineage_in_few_rounds(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(40)], "child string, parent string")
    got = {(r["start"], r["node"]): r["depth"] for r in S.lineage(chain, spark.createDataFrame([("n0",)], "start string")).collect()}
    assert len(got) == 40 and got["n0", "n40"] == 40
    kept = S.set_null(chain, "parent", spark.createDataFrame([("n1",)], "k string"), "k")
    assert kept.filter("parent is null").count() == 1 and kept.count() == 40


def test_scratch_and_shared_folder(spark):
    from pathlib import Path

    folder = Path(shared_dir(spark)[len("file://") :])
    before = set(folder.iterdir())
    with scratch(spark):
        assert cut(spark.range(3)).count() == 3 and set(folder.iterdir()) != before
    assert set(folder.iterdir()) == before


def test_pictures(spark):
    white = np.full((20, 30, 3), 255, np.uint8)
    red = white.copy()
    red[5:10, 10:20] = (200, 0, 0)
    df = spark.createDataFrame([("w", 30, 20, bytearray(white.tobytes())), ("r", 30, 20, bytearray(red.tobytes())), ("n", 30, 20, None), ("x", 9, 9, bytearray(b"abc"))], "id string, width int, height int, rgb binary")
    got = {r["id"]: tuple(r)[3:] for r in pixels.picture_statistics(df).collect()}
    assert got == {"w": (0.0, 0, 0, 0.0), "r": (0.0833, 50, 0, 0.0833), "n": (None,) * 4, "x": (None,) * 4}
    assert pixels.picture_statistics(df.limit(0)).count() == 0


def test_docx(spark, rows, tmp_path):
    import zipfile

    w, a, r = ("http://schemas.openxmlformats.org/wordprocessingml/2006/main", "http://schemas.openxmlformats.org/drawingml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships")
    p = lambda text, pic="": f"<w:p><w:r><w:t>{text}</w:t>{pic}</w:r></w:p>"
    body = p("1． 题　干") + p(" ") + f"<w:tbl><w:tr><w:tc>{p('格')}</w:tc></w:tr></w:tbl>" + p("2．", '<a:blip r:embed="i1"/><a:blip r:embed="none"/><a:blip r:embed="i2"/>')
    with zipfile.ZipFile(tmp_path / "x.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}" xmlns:a="{a}" xmlns:r="{r}"><w:body>{body}</w:body></w:document>')
        z.writestr("word/_rels/document.xml.rels", '<Relationships><Relationship Id="i1" Target="media/a.png"/><Relationship Id="i2" Target="media/b.png"/><Relationship Id="i3" Target="styles.xml"/></Relationships>')
    (tmp_path / "y.docx").write_bytes(b"no zip")
    assert rows(docx.paragraphs(spark, f"{tmp_path}/*.docx")) == {("x.docx", 0, "1． 题 干"), ("x.docx", 2, "2．")}
    assert rows(docx.pictures(spark, f"{tmp_path}/*.docx")) == {("x.docx", 3, 1, "media/a.png"), ("x.docx", 3, 2, "media/b.png")}


def test_clients_databases_reports(spark, tmp_path):
    tried = []

    def call():
        tried.append(1)
        if len(tried) < 3:
            raise OSError
        return "done"

    assert files.retried(call, wait=0) == "done" and len(tried) == 3
    with pytest.raises(OSError):
        files.retried(lambda: (_ for _ in ()).throw(OSError()), tries=2, wait=0)
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    spark.range(100).selectExpr("id", "id * 2 AS twice").write.format("jdbc").option("url", url).option("dbtable", "numbers").save()
    assert files.jdbc_table(spark, url, "numbers", "id", (0, 100), 4).agg(F.sum("twice")).first()[0] == 9900 and files.jdbc_table(spark, url, "numbers").filter("id < 3").count() == 3
    lines = sinks.report_lines("t", [("h", spark.createDataFrame([(1, None)], "a int, b string"), ["a", "b"])])
    assert lines == ["# t", "", "## h", "", "| a | b |", "|---|---|", "| 1 |  |"]
