"""The lesson graph: seeding its tables, and the keyed changes (append, merge, mark) that later steps make to them.

Every step takes tables and gives tables; ids are composed of natural keys, so a step that runs again gives the same rows, and
rows that exist already are found by an anti join. Nothing is changed in place: a change is a join on the key.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatemill.functions import text as T
from slatemill.operators.store import ensure, latest

#: Jobs of an import with capability, class and priority, and which waits for which. Fixed values.
JOBS = (("page_ingest", "vision", "L", 20), ("component_split", "vision", "L", 30), ("source_tree_build", "structure", "M", 40), ("task_extract", "task-extraction", "M", 50), ("subject_enrich", "subject.", "M", 60), ("checkpoint_suggest", "checkpoint", "M", 70), ("quality_gate", "export", "S", 80))
WAITS = (
    ("page_ingest", "component_split", "finishes_before"), ("component_split", "source_tree_build", "finishes_before"), ("component_split", "task_extract", "finishes_before"), ("source_tree_build", "task_extract", "requires_structure"), ("task_extract", "subject_enrich", "requires_tasks"),
    ("subject_enrich", "checkpoint_suggest", "requires_subject_enrichment"), ("source_tree_build", "checkpoint_suggest", "requires_structure"), ("subject_enrich", "quality_gate", "quality_input"), ("checkpoint_suggest", "quality_gate", "quality_input"),
)
#: Artifacts of an import in the order they are made, each with those it is derived from. Fixed values.
ARTIFACTS = (
    ("page_ocr_artifact", ()), ("component_bundle", ("page_ocr_artifact",)), ("source_tree_snapshot", ("component_bundle",)), ("task_bundle", ("source_tree_snapshot", "component_bundle")), ("subject_enrichment_artifact", ("task_bundle",)),
    ("checkpoint_candidate_artifact", ("source_tree_snapshot", "subject_enrichment_artifact")), ("reviewed_publishable_bundle", ("subject_enrichment_artifact", "checkpoint_candidate_artifact")),
)
#: Artifacts that a rerun makes stale, and from which an export is made.
DERIVED = ("source_tree_snapshot", "task_bundle", "reviewed_publishable_bundle")


def _listed(keys: DataFrame, rows: list[Column]) -> DataFrame:
    """Each key with each of a few fixed rows (structs): an array literal taken apart, not a join."""
    return keys.select("*", F.posexplode(F.array(*rows)).alias("place", "_x")).select(*keys.columns, (F.col("place") + 1).alias("place"), "_x.*")


def seed_nodes(points: DataFrame) -> DataFrame:
    """(lesson_id, node_id, node_type, parent_id, title, order_index) of points (lesson_id, lesson_title, module, point, k): root, modules and checkpoints.

    Modules and points come in the order of their least k. A checkpoint named under several modules belongs to the first, a
    module named twice is one node; order_index counts both in the order of the walk. A lesson's tree is bounded by its catalog.
    """
    named = points.groupBy("lesson_id", "module", "point").agg(F.min("k").alias("k"))
    modules = named.groupBy("lesson_id", "module").agg(F.min("k").alias("mk"))
    node = lambda kind, name: F.concat("lesson_id", F.lit(f":node:{kind}:"), T.slug(name))
    walk = named.join(modules.withColumnRenamed("module", "m"), (F.col("m").eqNullSafe(F.col("module"))) & (named["lesson_id"] == modules["lesson_id"])).drop(modules["lesson_id"]).withColumn("node_id", node("checkpoint", "point"))
    checks = walk.groupBy("lesson_id", "node_id").agg(F.min(F.struct("mk", "k", "module", "point")).alias("x")).select("lesson_id", "node_id", F.lit("exam_point").alias("node_type"), node("module", "x.module").alias("parent_id"), F.col("x.point").alias("title"), F.col("x.mk").alias("mk"), F.lit(1).alias("deep"), F.col("x.k").alias("k"))
    blocks = modules.withColumn("node_id", node("module", "module")).groupBy("lesson_id", "node_id").agg(F.min(F.struct("mk", "module")).alias("x")).select("lesson_id", "node_id", F.lit("knowledge_block").alias("node_type"), F.concat("lesson_id", F.lit(":node:root")).alias("parent_id"), F.col("x.module").alias("title"), F.col("x.mk").alias("mk"), F.lit(0).alias("deep"), F.col("x.mk").alias("k"))
    below = blocks.unionByName(checks).withColumn("order_index", F.row_number().over(Window.partitionBy("lesson_id").orderBy("mk", "deep", "k", "node_id")))
    root = points.groupBy("lesson_id").agg(F.min("lesson_title").alias("title")).select("lesson_id", F.concat("lesson_id", F.lit(":node:root")).alias("node_id"), F.lit("lesson").alias("node_type"), F.lit(None).cast("string").alias("parent_id"), "title", F.lit(0).alias("order_index"))
    return root.unionByName(below.select(*root.columns))


def seed_jobs(lessons: DataFrame) -> DataFrame:
    """(lesson_id, job_id, job_type, capability, resource_class, priority) of the import of each lesson (lesson_id, subject)."""
    rows = _listed(lessons.select("lesson_id", "subject"), [F.struct(F.lit(t).alias("job_type"), F.lit(c).alias("capability"), F.lit(r).alias("resource_class"), F.lit(p).alias("priority")) for t, c, r, p in JOBS])
    capability = F.when(F.col("capability") == "subject.", F.concat("capability", T.slug("subject"))).otherwise(F.col("capability"))
    return rows.select("lesson_id", F.concat_ws(":", "lesson_id", "job_type").alias("job_id"), "job_type", capability.alias("capability"), "resource_class", "priority")


def seed_waits(lessons: DataFrame) -> DataFrame:
    """(lesson_id, upstream_job_id, downstream_job_id, dependency_type)."""
    rows = _listed(lessons.select("lesson_id"), [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(t).alias("dependency_type")) for a, b, t in WAITS])
    return rows.select("lesson_id", F.concat_ws(":", "lesson_id", "a").alias("upstream_job_id"), F.concat_ws(":", "lesson_id", "b").alias("downstream_job_id"), "dependency_type")


def seed_artifacts(lessons: DataFrame) -> DataFrame:
    """(lesson_id, artifact_id, artifact_type, place, lifecycle_status), all valid, place being the order they are made in."""
    rows = _listed(lessons.select("lesson_id"), [F.struct(F.lit(t).alias("artifact_type")) for t, _ in ARTIFACTS])
    return rows.select("lesson_id", F.concat_ws(":", "lesson_id", "artifact_type").alias("artifact_id"), "artifact_type", "place", F.lit("valid").alias("lifecycle_status"))


def seed_artifact_edges(lessons: DataFrame) -> DataFrame:
    """(child, parent) of the artifacts of each lesson."""
    rows = _listed(lessons.select("lesson_id"), [F.struct(F.lit(t).alias("c"), F.lit(p).alias("p")) for t, parents in ARTIFACTS for p in parents])
    return rows.select(F.concat_ws(":", "lesson_id", "c").alias("child"), F.concat_ws(":", "lesson_id", "p").alias("parent"))


def by_risk(risk: Column, high: float, middle: float, low: float) -> Column:
    """A confidence by a review risk."""
    return F.when(risk == "高", high).when(risk == "中", middle).otherwise(low)


def answer_between(text: Column) -> Column:
    """What stands between the first 【答案】 and the next 【分析】 or 【答案】; null without the first mark."""
    return F.when(text.contains("【答案】"), F.regexp_replace(F.split_part(F.split_part(text, F.lit("【答案】"), F.lit(2)), F.lit("【分析】"), F.lit(1)), f"^{T.WS}+|{T.WS}+$", ""))


def seed_tasks(questions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Tasks of questions (question_id, group_id, checkpoint, risk, audit_status, tags, text, short_text) with the node that bears their checkpoint's name.

    catalog: (name, node_id), names once. A checkpoint that is not in it leaves the task at the group's root and gives no override.
    A text that is missing or empty is replaced by the short one.
    """
    named = questions.withColumn("name", T.checkpoint_name("checkpoint")).join(catalog.select("name", "node_id"), "name", "left")
    risk = F.col("risk")
    return named.select(
        "question_id",
        F.coalesce("node_id", F.concat("group_id", F.lit(":root"))).alias("node_id"),
        by_risk(risk, 0.65, 0.82, 0.95).alias("component_confidence"),
        F.when(F.col("node_id").isNotNull(), by_risk(risk, 0.74, 0.88, 0.96)).alias("override_confidence"),
        F.when(F.array_contains("tags", "基础版"), "student_basic").otherwise("student_standard").alias("visibility"),
        F.when(F.col("audit_status") == "PASS_BY_VISUAL_GATE", "published").otherwise("reviewing").alias("status"),
        F.coalesce(F.nullif("text", F.lit("")), "short_text").alias("student_stem"),
        answer_between(F.col("text")).alias("answer"),
    )


def seed_reviews(questions: DataFrame, queue: DataFrame) -> DataFrame:
    """Reviews (review_task_id, question_id, status) of the questions (question_id, risk) that are queued or not of low risk; queue: (question_id, queue_status)."""
    joined = questions.join(queue.withColumn("queued", F.lit(True)), "question_id", "left").filter(F.col("queued") | (F.col("risk") != "低"))
    return joined.select(F.when(F.col("queued"), F.col("question_id")).otherwise(F.concat(F.lit("review_"), "question_id")).alias("review_task_id"), "question_id", F.when(F.col("queue_status") == "复核中", "in_review").otherwise("pending").alias("status"))


def quality_rows(groups: DataFrame) -> DataFrame:
    """The four quality rows of each group (group_id, n_reviews): all pass, but the visual gate only without reviews."""
    waiting = F.col("n_reviews") > 0
    row = lambda code, severity, score, passed: F.struct(F.lit(code).alias("check_code"), severity.alias("severity"), score.cast("int").alias("score"), passed.alias("passed"))
    info, yes = F.lit("info"), F.lit(True)
    rows = [row("Q0_pairing", info, F.lit(100), yes), row("Q1_structure", info, F.lit(96), yes), row("Q2_visual_gate", F.when(waiting, "warning").otherwise("info"), F.when(waiting, 78).otherwise(94), ~waiting), row("Q3_task_binding", info, F.lit(92), yes)]
    return _listed(groups.select("group_id", "n_reviews"), rows).drop("n_reviews", "place")


def mark_stale(artifacts: DataFrame, lessons: DataFrame, types: tuple[str, ...] = DERIVED) -> DataFrame:
    """artifacts with those stale that are valid, of one of the types and of one of the lessons (lesson_id); the others unchanged."""
    hit = artifacts.join(lessons.select("lesson_id").distinct().withColumn("_hit", F.lit(True)), "lesson_id", "left")
    stale = F.col("_hit") & (F.col("lifecycle_status") == "valid") & F.col("artifact_type").isin(*types)
    return hit.withColumn("lifecycle_status", F.when(stale, "stale").otherwise(F.col("lifecycle_status"))).select(*artifacts.columns)


def next_revisions(lessons: DataFrame, revisions: DataFrame) -> DataFrame:
    """(lesson_id, old_revision_id, new_revision_id, revision_no): the revision that a rerun of each lesson adds after its active one, which must exist."""
    top = revisions.groupBy("lesson_id").agg((F.max("revision_no") + 1).alias("revision_no"))
    known = lessons.select("lesson_id", F.col("active_revision_id").alias("old_revision_id")).join(revisions.select(F.col("lesson_revision_id").alias("old_revision_id")).distinct(), "old_revision_id", "left_semi")
    return known.join(top, "lesson_id").select("lesson_id", "old_revision_id", F.concat_ws(":rev:", "lesson_id", F.col("revision_no").cast("string")).alias("new_revision_id"), "revision_no")


def cloned_tasks(tasks: DataFrame, reruns: DataFrame) -> DataFrame:
    """Copies of the tasks (task_id, revision_id, node_id) of each rerun's old revision, their ids and nodes carrying the new number, in review."""
    number = F.concat(F.lit(":rev:"), F.col("revision_no").cast("string"))
    return tasks.join(reruns, F.col("revision_id") == F.col("old_revision_id")).select(F.concat("task_id", number).alias("task_revision_id"), "task_id", F.col("new_revision_id").alias("lesson_revision_id"), F.concat("node_id", number).alias("node_revision_id"), F.lit("reviewing").alias("status"))


def rerun_records(reruns: DataFrame) -> DataFrame:
    """(lesson_revision_id, record_kind, record_id, depends_on, status) of the jobs, artifacts, review and quality row of each rerun."""
    chain = lambda names: list(zip(names, (None, *names)))
    rows = [("job", a, b, "succeeded") for a, b in chain(("source_tree_rerun", "task_extract_rerun", "quality_gate_rerun"))] + [("artifact", a, b, "valid") for a, b in chain(DERIVED)]
    rows += [("review", "review", None, "pending"), ("quality", "Q4_manual_review_required", "reviewed_publishable_bundle", "failed")]
    made = _listed(reruns.select("new_revision_id"), [F.struct(F.lit(k).alias("record_kind"), F.lit(a).alias("a"), F.lit(b).cast("string").alias("b"), F.lit(s).alias("status")) for k, a, b, s in rows])
    name = lambda c: F.concat("new_revision_id", F.lit(":"), F.col(c))
    return made.select(F.col("new_revision_id").alias("lesson_revision_id"), "record_kind", name("a").alias("record_id"), name("b").alias("depends_on"), "status")


def move_active(lessons: DataFrame, reruns: DataFrame) -> DataFrame:
    """lessons with the active pointer on the new revision and in review where there is one; the published pointer stays."""
    joined = lessons.join(reruns.select("lesson_id", "new_revision_id"), "lesson_id", "left")
    moved = {"active_revision_id": F.coalesce("new_revision_id", "active_revision_id"), "status": F.when(F.col("new_revision_id").isNotNull(), "reviewing").otherwise(F.col("status"))}
    return joined.withColumns(moved).select(*lessons.columns)


def decide(reviews: DataFrame, decisions: DataFrame) -> DataFrame:
    """reviews (review_task_id, status, ...) after the decisions (review_task_id, action): approve or request_changes; any other action is an error."""
    action = F.col("action")
    status = F.when(action.isNull(), F.col("status")).when(action == "approve", "approved").when(action == "request_changes", "changes_requested").otherwise(F.raise_error(F.concat(F.lit("unsupported action "), action)).cast("string"))
    return reviews.join(decisions.select("review_task_id", "action"), "review_task_id", "left").withColumn("status", status).select(*reviews.columns)


def publish(lessons: DataFrame, approved: DataFrame) -> DataFrame:
    """lessons with the published pointer on their active revision where that is approved (lesson_revision_id); the second step after the decision."""
    hit = lessons.join(approved.select(F.col("lesson_revision_id").alias("active_revision_id")).distinct().withColumn("_ok", F.lit(True)), "active_revision_id", "left")
    changed = {"published_revision_id": F.when(F.col("_ok"), F.col("active_revision_id")).otherwise(F.col("published_revision_id")), "status": F.when(F.col("_ok"), "published").otherwise(F.col("status"))}
    return hit.withColumns(changed).select(*lessons.columns)


def register_exports(exports: DataFrame, existing: DataFrame, artifacts: DataFrame, formats: tuple[str, ...] = ("docx", "pdf")) -> DataFrame:
    """New artifacts (run_id, artifact_type, storage_uri, parent_id) of exports (lesson_id, history_id): a manifest each, derived from the lesson's latest valid bundle, and its files.

    existing: (run_id, storage_uri) of artifacts that are there already; they are passed over, so registering again adds nothing.
    """
    source = latest(artifacts.filter((F.col("lifecycle_status") == "valid") & F.col("artifact_type").isin(*DERIVED)).select("lesson_id", "artifact_id", "place"), ["lesson_id"], [F.col("place")]).select("lesson_id", "artifact_id")
    runs = exports.join(source, "lesson_id", "left").select(F.concat(F.lit("export_"), "history_id").alias("run_id"), "lesson_id", "artifact_id")
    row = lambda kind, uri, parent: F.struct(F.lit(kind).alias("artifact_type"), uri.alias("storage_uri"), parent.alias("parent_id"))
    manifest = F.concat_ws("/", "run_id", F.lit("manifest.json"))
    files = [row("export_file", F.concat(F.col("run_id"), F.lit("/"), F.col("lesson_id"), F.lit(f".{f}")), manifest) for f in formats]
    made = _listed(runs, [row("export_bundle_manifest", manifest, F.col("artifact_id")), *files]).select("run_id", "artifact_type", "storage_uri", "parent_id")
    return ensure(made, existing, ["run_id", "storage_uri"])


def settle_patches(patches: DataFrame, decisions: DataFrame) -> DataFrame:
    """patches (patch_id, component_id, status) with pending ones accepted or rejected by decisions (patch_id, accepted); one already settled stays."""
    joined = patches.join(decisions.select("patch_id", "accepted"), "patch_id", "left")
    settled = F.when((F.col("status") == "pending") & F.col("accepted").isNotNull(), F.when(F.col("accepted"), "accepted").otherwise("rejected")).otherwise(F.col("status"))
    return joined.withColumn("status", settled).select(*patches.columns)


def recover_stalled(jobs: DataFrame, now) -> DataFrame:
    """jobs (job_id, status, timeout_at, ...) with ``recovered``: running ones whose time is out wait for a retry, all others stay."""
    out = (F.col("status") == "running") & (F.col("timeout_at") < F.lit(now).cast("timestamp_ntz"))
    return jobs.withColumn("recovered", F.coalesce(out, F.lit(False))).withColumn("status", F.when(F.col("recovered"), "retry_wait").otherwise(F.col("status")))


def readiness(results: DataFrame, by: list[str]) -> DataFrame:
    """by with ``readiness`` of results (required, status): a required failure is NOT_READY, else a skip CONDITIONALLY_READY, else READY."""
    failed, skipped = F.bool_or(F.col("required") & (F.col("status") == "failed")), F.bool_or(F.col("status") == "skipped")
    return results.groupBy(*by).agg(F.when(F.coalesce(failed, F.lit(False)), "NOT_READY").when(F.coalesce(skipped, F.lit(False)), "CONDITIONALLY_READY").otherwise("READY").alias("readiness"))
