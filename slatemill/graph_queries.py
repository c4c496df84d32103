"""Queries over the lesson graph: what seeding makes, what later steps change, details by chains of semi joins."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.catalog_queries import _N
from slatemill.functions import rules as R
from slatemill.functions import text as T
from slatemill.line_queries import _audited, _tagged_questions
from slatemill.operators import graph as H
from slatemill.operators import store as S
from slatemill.registry import SQL, query
from slatemill.sources.tables import read

_SLUG = lambda c: f"coalesce(nullif(trim(regexp_replace(lower(trim(coalesce({c}, ''))), '[^\\p{{L}}\\p{{N}}]+', '_', 'g'), '_'), ''), 'unknown')"


def _points(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "knowledge_points", "lesson_id", "lesson_title", F.col("level_2_module").alias("module"), F.col("level_3_min_knowledge_point").alias("point"), F.col("knowledge_id").alias("k"))


def _lessons(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lesson", "lesson_id", "subject", "status", "active_revision_id", F.nullif(F.trim("published_revision_id"), F.lit("")).alias("published_revision_id")).distinct()


_LESSONS = "l AS (SELECT DISTINCT lesson_id, subject, status, active_revision_id, nullif(trim(published_revision_id, ' '), '') AS published_revision_id FROM lesson)"


@query(rf"""WITH k AS (SELECT lesson_id, level_2_module AS module, level_3_min_knowledge_point AS point, min(knowledge_id) AS k FROM knowledge_points GROUP BY ALL), m AS (SELECT lesson_id, module, min(k) AS mk FROM k GROUP BY ALL),
w AS (SELECT k.*, mk, k.lesson_id || ':node:checkpoint:' || {_SLUG("k.point")} AS node_id FROM k JOIN m ON m.lesson_id = k.lesson_id AND m.module IS NOT DISTINCT FROM k.module),
c AS (SELECT lesson_id, node_id, 'exam_point' AS node_type, lesson_id || ':node:module:' || {_SLUG("module")} AS parent_id, point AS title, mk, 1 AS deep, k FROM w QUALIFY row_number() OVER (PARTITION BY lesson_id, node_id ORDER BY mk, k) = 1),
b AS (SELECT lesson_id, lesson_id || ':node:module:' || {_SLUG("module")} AS node_id, 'knowledge_block' AS node_type, lesson_id || ':node:root' AS parent_id, module AS title, mk, 0 AS deep, mk AS k FROM m QUALIFY row_number() OVER (PARTITION BY lesson_id, lesson_id || ':node:module:' || {_SLUG("module")} ORDER BY mk) = 1)
SELECT lesson_id, node_id, node_type, parent_id, title, (row_number() OVER (PARTITION BY lesson_id ORDER BY mk, deep, k, node_id))::INT AS order_index FROM (SELECT * FROM b UNION ALL SELECT * FROM c)
UNION ALL SELECT lesson_id, lesson_id || ':node:root', 'lesson', NULL, min(lesson_title), 0 FROM knowledge_points GROUP BY lesson_id""")
def seeded_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The source tree of every catalog lesson: root, modules, checkpoints, numbered in the order of the walk."""
    return H.seed_nodes(_points(spark, d))


_JOBS = "(VALUES ('page_ingest', 'vision', 'L', 20), ('component_split', 'vision', 'L', 30), ('source_tree_build', 'structure', 'M', 40), ('task_extract', 'task-extraction', 'M', 50), ('subject_enrich', 'subject.', 'M', 60), ('checkpoint_suggest', 'checkpoint', 'M', 70), ('quality_gate', 'export', 'S', 80)) AS j(t, c, r, p)"
_WAITS = "(VALUES ('page_ingest', 'component_split', 'finishes_before'), ('component_split', 'source_tree_build', 'finishes_before'), ('component_split', 'task_extract', 'finishes_before'), ('source_tree_build', 'task_extract', 'requires_structure'), ('task_extract', 'subject_enrich', 'requires_tasks'), ('subject_enrich', 'checkpoint_suggest', 'requires_subject_enrichment'), ('source_tree_build', 'checkpoint_suggest', 'requires_structure'), ('subject_enrich', 'quality_gate', 'quality_input'), ('checkpoint_suggest', 'quality_gate', 'quality_input')) AS w(a, b, t)"


@query(rf"""WITH {_LESSONS}, x AS (SELECT lesson_id, subject FROM l) SELECT lesson_id, lesson_id || ':' || t AS job_id, t AS job_type, CASE WHEN c = 'subject.' THEN c || {_SLUG("subject")} ELSE c END AS capability, r AS resource_class, p::INT AS priority FROM x, {_JOBS}""")
def seeded_jobs(spark: SparkSession, d: str) -> DataFrame:
    return H.seed_jobs(_lessons(spark, d))


@query(f"""WITH {_LESSONS}, d AS (SELECT lesson_id || ':' || a AS up, lesson_id || ':' || b AS down FROM l, {_WAITS}) SELECT down AS job_id, count(*) AS n_waits_for, string_agg(up, ',' ORDER BY up) AS waits_for FROM d GROUP BY 1""")
def job_waits(spark: SparkSession, d: str) -> DataFrame:
    """For each import job those that it waits for."""
    waits = H.seed_waits(_lessons(spark, d))
    return waits.groupBy(F.col("downstream_job_id").alias("job_id")).agg(F.count("*").alias("n_waits_for"), F.array_join(F.array_sort(F.collect_list("upstream_job_id")), ",").alias("waits_for"))


_ART = "(VALUES (1, 'page_ocr_artifact'), (2, 'component_bundle'), (3, 'source_tree_snapshot'), (4, 'task_bundle'), (5, 'subject_enrichment_artifact'), (6, 'checkpoint_candidate_artifact'), (7, 'reviewed_publishable_bundle')) AS a(place, t)"
_EDGE = "(VALUES (2, 1), (3, 2), (4, 3), (4, 2), (5, 4), (6, 3), (6, 5), (7, 5), (7, 6)) AS e(c, p)"


@query(f"""WITH RECURSIVE {_LESSONS}, a AS (SELECT * FROM {_ART}), e AS (SELECT * FROM {_EDGE}), r AS (SELECT c AS s, p AS n, 1 AS depth FROM e UNION SELECT r.s, e.p, r.depth + 1 FROM r JOIN e ON e.c = r.n), m AS (SELECT s, n, min(depth) AS depth FROM r GROUP BY ALL)
SELECT lesson_id || ':' || x.t AS artifact_id, lesson_id || ':' || y.t AS ancestor_id, m.depth FROM l, m JOIN a x ON x.place = m.s JOIN a y ON y.place = m.n""")
def artifact_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Every artifact with all it is derived from; several ways lead to one ancestor, the shortest counts."""
    return S.lineage(H.seed_artifact_edges(_lessons(spark, d))).select(F.col("start").alias("artifact_id"), F.col("node").alias("ancestor_id"), "depth")


@query(f"""WITH {_LESSONS} SELECT lesson_id, t AS artifact_type, CASE WHEN status = 'reviewing' AND t IN ('source_tree_snapshot', 'task_bundle', 'reviewed_publishable_bundle') THEN 'stale' ELSE 'valid' END AS lifecycle_status FROM l, {_ART}""")
def artifact_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    """The artifacts after a rerun of the lessons in review: what is derived from the tree is stale, the rest stays valid."""
    lessons = _lessons(spark, d)
    return H.mark_stale(H.seed_artifacts(lessons), lessons.filter("status = 'reviewing'")).select("lesson_id", "artifact_type", "lifecycle_status")


@query(f"""WITH {_LESSONS}, x AS (SELECT lesson_id, status FROM l WHERE status IN ('published', 'reviewing')), f(t, s) AS (VALUES ('export_bundle_manifest', 'manifest.json'), ('export_file', 'docx'), ('export_file', 'pdf'))
SELECT 'export_' || lesson_id AS run_id, t AS artifact_type, CASE WHEN s = 'manifest.json' THEN 'export_' || lesson_id || '/manifest.json' ELSE 'export_' || lesson_id || '/' || lesson_id || '.' || s END AS storage_uri,
CASE WHEN s <> 'manifest.json' THEN 'export_' || lesson_id || '/manifest.json' WHEN status = 'published' THEN lesson_id || ':reviewed_publishable_bundle' END AS parent_id FROM x, f WHERE NOT (s = 'pdf' AND lesson_id LIKE 'math%')""")
def export_registration(spark: SparkSession, d: str) -> DataFrame:
    """What registering an export of every lesson adds, the PDF of mathematics being there already; stale bundles are no source."""
    lessons = _lessons(spark, d).filter("status in ('published', 'reviewing')")
    artifacts = H.mark_stale(H.seed_artifacts(lessons), lessons.filter("status = 'reviewing'"))
    run = F.concat(F.lit("export_"), "lesson_id")
    existing = lessons.filter("lesson_id like 'math%'").select(run.alias("run_id"), F.concat(run, F.lit("/"), F.col("lesson_id"), F.lit(".pdf")).alias("storage_uri"))
    return H.register_exports(lessons.select("lesson_id", F.col("lesson_id").alias("history_id")), existing, artifacts)


# ---------------------------------------------------------------- tasks, reviews, quality

_AUDIT = "au AS (" + SQL["question_audit"].replace("WITH q AS", "WITH q0 AS").replace("FROM q)", "FROM q0)").replace("FROM q),", "FROM q0),") + ")"
_QUESTIONS = rf"""{_AUDIT}, q AS (SELECT DISTINCT question_id, group_id, checkpoint, component_kind, component_label, local_number, review_status, text_preview, text_preview_source FROM split_questions),
nq AS (SELECT *, row_number() OVER (PARTITION BY checkpoint ORDER BY question_id) AS nth, coalesce(len(text_preview), 0) AS n FROM q),
t AS (SELECT nq.*, au.risk, au.audit_status, (component_kind = 'example' OR (component_kind = 'practice' AND nth <= 1) OR component_kind = 'after_class') AS basic FROM nq JOIN au USING (question_id))"""


@query(rf"""WITH {_QUESTIONS}, cat AS (SELECT level_3_min_knowledge_point AS name, min(knowledge_id) AS node_id FROM knowledge_points GROUP BY 1)
SELECT question_id, coalesce(node_id, group_id || ':root') AS node_id, CASE risk WHEN '高' THEN 0.65 WHEN '中' THEN 0.82 ELSE 0.95 END::DOUBLE AS component_confidence, CASE WHEN node_id IS NOT NULL THEN CASE risk WHEN '高' THEN 0.74 WHEN '中' THEN 0.88 ELSE 0.96 END END::DOUBLE AS override_confidence,
CASE WHEN basic THEN 'student_basic' ELSE 'student_standard' END AS visibility, CASE WHEN audit_status = 'PASS_BY_VISUAL_GATE' THEN 'published' ELSE 'reviewing' END AS status, md5(coalesce(nullif(text_preview, ''), component_label)) AS stem_md5
FROM t LEFT JOIN cat ON cat.name = regexp_replace(trim(checkpoint, ' '), '^考点\s*\d+\s*[:：]?\s*', '')""")
def seeded_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Tasks of all questions with the point that their checkpoint names, confidences by risk, visibility and status."""
    catalog = read(spark, d, "knowledge_points", F.col("level_3_min_knowledge_point").alias("name"), "knowledge_id").groupBy("name").agg(F.min("knowledge_id").alias("node_id"))
    questions = _tagged_questions(spark, d).withColumns({"text": F.col("text_preview"), "short_text": F.col("component_label")})
    return H.seed_tasks(questions, catalog).select("question_id", "node_id", "component_confidence", "override_confidence", "visibility", "status", F.md5("student_stem").alias("stem_md5"))


@query(r"""SELECT DISTINCT doc_id, md5(regexp_replace(split_part(split_part(text, '【答案】', 2), '【分析】', 1), '^[\s\x{3000}\x{a0}]+|[\s\x{3000}\x{a0}]+$', '', 'g')) AS answer_md5 FROM documents WHERE contains(text, '【答案】')""")
def answer_fields(spark: SparkSession, d: str) -> DataFrame:
    """The answer field that seeding takes out of a text."""
    rows = read(spark, d, "documents", "doc_id", "text").select("doc_id", H.answer_between(F.col("text")).alias("a"))
    return rows.filter("a is not null").select("doc_id", F.md5("a").alias("answer_md5"))


_QUEUE = "qu AS (SELECT question_id, CASE WHEN local_number % 2 = 0 THEN '复核中' ELSE '待复核' END AS queue_status, component_label AS title FROM q WHERE review_status = 'needs_review' AND component_kind = 'advanced')"
_REVIEWS = f"{_QUESTIONS}, {_QUEUE}, rv AS (SELECT CASE WHEN qu.question_id IS NOT NULL THEN t.question_id ELSE 'review_' || t.question_id END AS review_task_id, t.question_id, t.group_id, t.local_number, CASE WHEN queue_status = '复核中' THEN 'in_review' ELSE 'pending' END AS status FROM t LEFT JOIN qu USING (question_id) WHERE qu.question_id IS NOT NULL OR risk <> '低')"


def _queue(questions: DataFrame) -> DataFrame:
    return questions.filter("review_status = 'needs_review' and component_kind = 'advanced'").select("question_id", F.when(F.col("local_number") % 2 == 0, "复核中").otherwise("待复核").alias("queue_status"), F.col("component_label").alias("title"))


def _reviews(spark: SparkSession, d: str) -> DataFrame:
    questions = _audited(spark, d)
    return H.seed_reviews(questions, _queue(questions).drop("title"))


@query(f"WITH {_REVIEWS} SELECT review_task_id, question_id, status FROM rv")
def seeded_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews of queued questions and of those that are not of low risk."""
    return _reviews(spark, d)


@query(f"""WITH {_REVIEWS}, g AS (SELECT q.group_id, count(rv.question_id) AS n FROM q LEFT JOIN rv USING (question_id) GROUP BY 1), v(k, c) AS (VALUES (0, 'Q0_pairing'), (1, 'Q1_structure'), (2, 'Q2_visual_gate'), (3, 'Q3_task_binding'))
SELECT group_id, c AS check_code, CASE WHEN k = 2 AND n > 0 THEN 'warning' ELSE 'info' END AS severity, (CASE k WHEN 0 THEN 100 WHEN 1 THEN 96 WHEN 3 THEN 92 ELSE CASE WHEN n > 0 THEN 78 ELSE 94 END END)::INT AS score, NOT (k = 2 AND n > 0) AS passed FROM g, v""")
def seeded_quality(spark: SparkSession, d: str) -> DataFrame:
    groups = read(spark, d, "split_questions", "question_id", "group_id").distinct()
    counts = groups.join(_reviews(spark, d).select("question_id", "review_task_id"), "question_id", "left").groupBy("group_id").agg(F.count("review_task_id").alias("n_reviews"))
    return H.quality_rows(counts)


@query(f"""WITH {_REVIEWS}, s AS (SELECT review_task_id, CASE local_number % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'changes_requested' ELSE status END AS status FROM rv) SELECT * FROM s""")
def decided_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews after decisions on two thirds of them."""
    reviews = _reviews(spark, d)
    numbers = read(spark, d, "split_questions", "question_id", "local_number").distinct()
    action = F.when(F.col("local_number") % 3 == 0, "approve").when(F.col("local_number") % 3 == 1, "request_changes")
    decisions = reviews.join(numbers, "question_id").select("review_task_id", action.alias("action")).filter("action is not null")
    return H.decide(reviews, decisions).select("review_task_id", "status")


@query(f"""WITH {_REVIEWS}, k AS (SELECT group_id, question_id, row_number() OVER (PARTITION BY group_id ORDER BY question_id) AS n FROM q), i AS (SELECT group_id, question_id, queue_status, title FROM qu JOIN q USING (question_id) UNION ALL SELECT DISTINCT group_id, 'unknown_' || group_id, '待复核', 'extra' FROM q)
SELECT i.group_id, i.question_id, coalesce(title, '') AS title, CASE WHEN q.question_id IS NULL THEN queue_status END AS queue_status, q.component_kind FROM i LEFT JOIN q ON q.question_id = i.question_id AND q.group_id = i.group_id""")
def review_payload(spark: SparkSession, d: str) -> DataFrame:
    """The review queue with the questions it is about; an item without its question is kept as it is."""
    questions = _audited(spark, d)
    keyed = questions.select("group_id", "question_id", "component_kind", F.lit(True).alias("found"))
    items = _queue(questions).join(questions.select("question_id", "group_id"), "question_id").unionByName(questions.select("group_id").distinct().select(F.concat(F.lit("unknown_"), "group_id").alias("question_id"), F.lit("待复核").alias("queue_status"), F.lit("extra").alias("title"), "group_id"))
    joined = items.join(keyed, ["group_id", "question_id"], "left")
    return joined.select("group_id", "question_id", F.coalesce("title", F.lit("")).alias("title"), F.when(F.col("found").isNull(), F.col("queue_status")).alias("queue_status"), "component_kind")


# ---------------------------------------------------------------- reruns and publication

_LOG = "r AS (SELECT DISTINCT lesson_revision_id, lesson_id, revision_no, status, approval_status FROM lesson_revision), top AS (SELECT lesson_id, max(revision_no) + 1 AS n FROM r GROUP BY 1), nx AS (SELECT l.lesson_id, l.active_revision_id AS old_id, l.lesson_id || ':rev:' || n AS new_id, n FROM l JOIN top USING (lesson_id) WHERE l.active_revision_id IN (SELECT lesson_revision_id FROM r))"


def _reruns(spark: SparkSession, d: str) -> DataFrame:
    return H.next_revisions(_lessons(spark, d), read(spark, d, "lesson_revision", "lesson_revision_id", "lesson_id", "revision_no").distinct())


@query(f"WITH {_LESSONS}, {_LOG} SELECT l.lesson_id, coalesce(new_id, active_revision_id) AS active_revision_id, published_revision_id, CASE WHEN new_id IS NOT NULL THEN 'reviewing' ELSE status END AS status FROM l LEFT JOIN nx USING (lesson_id)")
def rerun_lessons(spark: SparkSession, d: str) -> DataFrame:
    """The lessons after a rerun of all: the active pointer on the new revision, the published one unmoved."""
    return H.move_active(_lessons(spark, d), _reruns(spark, d)).select("lesson_id", "active_revision_id", "published_revision_id", "status")


@query(f"""WITH {_LESSONS}, {_LOG}, t AS (SELECT DISTINCT task_projection_id AS task_id, trim(lesson_revision_id, ' ') AS rev, source_node_local_id AS node FROM task_projection)
SELECT task_id || ':rev:' || n AS task_revision_id, task_id, new_id AS lesson_revision_id, node || ':rev:' || n AS node_revision_id, 'reviewing' AS status FROM t JOIN nx ON t.rev = nx.old_id""")
def rerun_tasks(spark: SparkSession, d: str) -> DataFrame:
    """The copies of tasks that a rerun makes, with their nodes remapped to the new revision."""
    tasks = read(spark, d, "task_projection", F.col("task_projection_id").alias("task_id"), F.trim("lesson_revision_id").alias("revision_id"), F.col("source_node_local_id").alias("node_id")).distinct()
    return H.cloned_tasks(tasks, _reruns(spark, d))


@query(f"""WITH {_LESSONS}, {_LOG}, ok AS (SELECT DISTINCT lesson_revision_id FROM r WHERE approval_status = 'approved') SELECT lesson_id, CASE WHEN ok.lesson_revision_id IS NOT NULL THEN active_revision_id ELSE published_revision_id END AS published_revision_id, CASE WHEN ok.lesson_revision_id IS NOT NULL THEN 'published' ELSE status END AS status FROM l LEFT JOIN ok ON ok.lesson_revision_id = active_revision_id""")
def published_pointers(spark: SparkSession, d: str) -> DataFrame:
    """The lessons after publishing those whose active revision is approved."""
    approved = read(spark, d, "lesson_revision", "lesson_revision_id", "approval_status").filter("approval_status = 'approved'").select("lesson_revision_id")
    return H.publish(_lessons(spark, d), approved).select("lesson_id", "published_revision_id", "status")


@query("""WITH l AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS job_id, l_orderkey AS run_id, l_linestatus AS s, l_shipdate AS t FROM lineitem), j AS (SELECT job_id, run_id, max(CASE WHEN s = 'O' THEN 'running' ELSE 'succeeded' END) AS status, max(t) AS timeout_at FROM l GROUP BY ALL)
SELECT job_id, CASE WHEN status = 'running' AND timeout_at < TIMESTAMP '1997-01-01' THEN 'retry_wait' ELSE status END AS status, status = 'running' AND timeout_at < TIMESTAMP '1997-01-01' AS recovered FROM j""")
def recovered_jobs(spark: SparkSession, d: str) -> DataFrame:
    """Jobs after recovery: running ones whose time is out wait for a retry."""
    rows = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate")
    jobs = rows.groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("job_id")).agg(F.max(F.when(F.col("l_linestatus") == "O", "running").otherwise("succeeded")).alias("status"), F.max("l_shipdate").alias("timeout_at"))
    return H.recover_stalled(jobs, "1997-01-01").select("job_id", "status", "recovered")


@query("""WITH p AS (SELECT o_orderkey AS patch_id, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'pending' ELSE 'accepted' END AS status FROM orders), d AS (SELECT o_orderkey AS patch_id, o_totalprice > 150000 AS accepted FROM orders WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%')
SELECT patch_id, CASE WHEN status = 'pending' AND accepted IS NOT NULL THEN CASE WHEN accepted THEN 'accepted' ELSE 'rejected' END ELSE status END AS status FROM p LEFT JOIN d USING (patch_id)""")
def settled_patches(spark: SparkSession, d: str) -> DataFrame:
    """Pending changes settled by decisions; those settled before stay."""
    rows = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    patches = rows.select(F.col("o_orderkey").alias("patch_id"), F.col("o_custkey").alias("component_id"), F.when(F.col("o_orderstatus").isin("P", "O"), "pending").otherwise("accepted").alias("status"))
    decisions = rows.filter("o_orderpriority like '1%' or o_orderpriority like '2%'").select(F.col("o_orderkey").alias("patch_id"), (F.col("o_totalprice") > 150000).alias("accepted"))
    return H.settle_patches(patches, decisions).select("patch_id", "status")


@query(f"""WITH {_LESSONS}, {_LOG}, j(p, t, w) AS (VALUES (1, 'source_tree_rerun', NULL), (2, 'task_extract_rerun', 'source_tree_rerun'), (3, 'quality_gate_rerun', 'task_extract_rerun'))
SELECT new_id AS lesson_revision_id, 'job' AS record_kind, new_id || ':' || t AS record_id, new_id || ':' || w AS depends_on, 'succeeded' AS status FROM nx, j UNION ALL SELECT new_id, 'artifact', new_id || ':' || a, new_id || ':' || b, 'valid' FROM nx, (VALUES ('source_tree_snapshot', NULL), ('task_bundle', 'source_tree_snapshot'), ('reviewed_publishable_bundle', 'task_bundle')) AS x(a, b)
UNION ALL SELECT new_id, 'review', new_id || ':review', NULL, 'pending' FROM nx UNION ALL SELECT new_id, 'quality', new_id || ':Q4_manual_review_required', new_id || ':reviewed_publishable_bundle', 'failed' FROM nx""")
def rerun_records(spark: SparkSession, d: str) -> DataFrame:
    """The jobs, artifacts, review and quality row that come with every rerun, each with what it depends on."""
    return H.rerun_records(_reruns(spark, d))


@query(f"""WITH a AS ({SQL["question_audit"]}), b AS (SELECT * FROM a WHERE audit_status <> 'PASS_BY_VISUAL_GATE'), q AS (SELECT DISTINCT question_id, component_kind FROM split_questions) SELECT q.question_id, coalesce(audit_status, 'PASS_BY_VISUAL_GATE') AS audit_status, coalesce(issues, '') AS issues, CASE WHEN audit_status = 'NEEDS_MODEL_OR_HUMAN_REVIEW' THEN '高' WHEN component_kind = 'advanced' THEN '中' ELSE '低' END AS risk FROM q LEFT JOIN b USING (question_id)""")
def question_risks(spark: SparkSession, d: str) -> DataFrame:
    """Questions with their audit; one that has none has passed."""
    audits = _audited(spark, d).filter("audit_status <> 'PASS_BY_VISUAL_GATE'").select("question_id", "audit_status", "issues")
    rows = read(spark, d, "split_questions", "question_id", "component_kind").distinct().join(audits, "question_id", "left")
    return rows.select("question_id", F.coalesce("audit_status", F.lit("PASS_BY_VISUAL_GATE")).alias("audit_status"), F.coalesce("issues", F.lit("")).alias("issues"), R.review_risk("audit_status", "component_kind").alias("risk"))


@query(r"""WITH t AS (SELECT DISTINCT regexp_extract(task_id, '^(.*?):task:', 1) AS lesson_id, regexp_extract(task_id, '[^:]*$') AS k, task_id FROM task), s AS (SELECT DISTINCT lesson_id, local_task_id AS k, task_projection_id FROM task_projection WHERE local_task_id IS NOT NULL AND lesson_id IS NOT NULL), o AS (SELECT coalesce(t.lesson_id, s.lesson_id) AS lesson_id, coalesce(t.k, s.k) AS k, task_id, task_projection_id FROM t FULL OUTER JOIN s ON s.lesson_id = t.lesson_id AND s.k = t.k)
SELECT lesson_id, k AS task_key, task_id, task_projection_id, CASE WHEN task_id IS NULL THEN 'only_student' WHEN task_projection_id IS NULL THEN 'only_teacher' ELSE 'aligned' END AS alignment, row_number() OVER (PARTITION BY lesson_id ORDER BY regexp_extract(k, '^s(\d+)_q(\d+)$', 1)::INT, regexp_extract(k, '^s(\d+)_q(\d+)$', 2)::INT, task_id, task_projection_id) AS place FROM o""")
def paired_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Teacher's and student's tasks of each lesson aligned by section and question, in the order of both as numbers."""
    from slatemill.operators.ordered import nth

    teacher = read(spark, d, "task", "task_id").distinct().select(F.regexp_extract("task_id", "^(.*?):task:", 1).alias("lesson_id"), F.regexp_extract("task_id", "[^:]*$", 0).alias("task_key"), "task_id")
    student = read(spark, d, "task_projection", "lesson_id", F.col("local_task_id").alias("task_key"), "task_projection_id").filter("task_key is not null and lesson_id is not null").distinct()
    part = lambda k: F.regexp_extract("task_key", r"^s(\d+)_q(\d+)$", k).cast("int")
    both = teacher.join(student, ["lesson_id", "task_key"], "full_outer").withColumns({"s": part(1), "q": part(2)})
    side = F.when(F.col("task_id").isNull(), "only_student").when(F.col("task_projection_id").isNull(), "only_teacher").otherwise("aligned")
    return nth(both.withColumn("alignment", side), ["lesson_id"], ["s", "q", F.asc_nulls_last("task_id"), F.asc_nulls_last("task_projection_id")], "place").select("lesson_id", "task_key", "task_id", "task_projection_id", "alignment", "place")


# ---------------------------------------------------------------- details

_JOB = "jb AS (SELECT DISTINCT l_orderkey AS run_id, l_orderkey * 10 + l_linenumber AS job_id FROM lineitem), ar AS (SELECT DISTINCT l_partkey * 1000000 + l_suppkey AS artifact_id, CASE WHEN l_returnflag = 'R' THEN l_orderkey END AS run_id, CASE WHEN l_linestatus = 'F' THEN l_orderkey * 10 + l_linenumber END AS job_id FROM lineitem)"


@query(f"""WITH {_JOB}, run AS (SELECT o_orderkey AS run_id FROM orders WHERE o_orderstatus = 'P'), dep AS (SELECT a.job_id AS up, b.job_id AS down FROM jb a JOIN jb b ON b.job_id = a.job_id + 1 UNION SELECT a.job_id, b.job_id FROM jb a JOIN jb b ON a.job_id % 10 = 1 AND b.job_id = a.job_id + 10),
d AS (SELECT jb.run_id, up, down FROM dep JOIN jb ON jb.job_id = up UNION SELECT jb.run_id, up, down FROM dep JOIN jb ON jb.job_id = down), a AS (SELECT run_id, artifact_id FROM ar WHERE run_id IS NOT NULL UNION SELECT jb.run_id, artifact_id FROM ar JOIN jb USING (job_id)),
x AS (SELECT run_id, 'jobs' AS collection, count(*) AS n FROM jb GROUP BY ALL UNION ALL SELECT run_id, 'dependencies', count(*) FROM d GROUP BY ALL UNION ALL SELECT run_id, 'artifacts', count(*) FROM a GROUP BY ALL) SELECT run_id, collection, n FROM x SEMI JOIN run USING (run_id)""")
def run_detail(spark: SparkSession, d: str) -> DataFrame:
    """What belongs to each run: its jobs, the dependencies that one of them is on either side of, the artifacts of the run or of a job."""
    rows = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    job = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    runs = read(spark, d, "orders", "o_orderkey", "o_orderstatus").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("run_id"))
    jobs = rows.select(F.col("l_orderkey").alias("run_id"), job.alias("job_id")).distinct()
    follows = jobs.select("job_id", F.explode(F.array(F.struct((F.col("job_id") + 1).alias("down")), F.struct(F.when(F.col("job_id") % 10 == 1, F.col("job_id") + 10).alias("down")))).alias("x")).select(F.col("job_id").alias("up"), "x.down").filter("down is not null")
    follows = follows.join(jobs.select(F.col("job_id").alias("down")), "down", "left_semi").select("up", "down").distinct()
    artifacts = rows.select((F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("artifact_id"), F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("run_id"), F.when(F.col("l_linestatus") == "F", job).alias("job_id")).distinct()
    mine = jobs.join(runs, "run_id", "left_semi")
    of_deps = S.either_side(follows, ["up", "down"], mine, "run_id", ("up", "job_id"), ("down", "job_id"))
    of_artifacts = artifacts.filter("run_id is not null").select("run_id", "artifact_id").join(runs, "run_id", "left_semi").unionByName(artifacts.select("artifact_id", "job_id").join(mine, "job_id").select("run_id", "artifact_id")).distinct()
    out = None
    for name, table in (("jobs", mine), ("dependencies", of_deps), ("artifacts", of_artifacts)):
        part = table.groupBy("run_id").agg(F.lit(name).alias("collection"), F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""WITH {_LESSONS}, r AS (SELECT DISTINCT lesson_revision_id, lesson_id, approval_status FROM lesson_revision), t AS (SELECT DISTINCT task_projection_id, lesson_id, difficulty_confidence FROM task_projection),
w AS (SELECT DISTINCT task_projection_id AS target FROM t WHERE difficulty_confidence < 0.6 UNION SELECT DISTINCT lesson_revision_id FROM r WHERE approval_status = 'pending'), v AS (SELECT t.lesson_id, target FROM w JOIN t ON t.task_projection_id = target UNION SELECT l.lesson_id, target FROM w JOIN l ON l.active_revision_id = target),
x AS (SELECT lesson_id, 'revisions' AS collection, count(DISTINCT lesson_revision_id) AS n FROM r GROUP BY ALL UNION ALL SELECT lesson_id, 'tasks', count(DISTINCT task_projection_id) FROM t GROUP BY ALL UNION ALL SELECT lesson_id, 'reviews', count(*) FROM v GROUP BY ALL) SELECT lesson_id, collection, n FROM x SEMI JOIN l USING (lesson_id)""")
def lesson_detail(spark: SparkSession, d: str) -> DataFrame:
    """What belongs to each lesson: its revisions, its tasks, and the reviews of one of its tasks or of its active revision."""
    lessons = _lessons(spark, d)
    revisions = read(spark, d, "lesson_revision", "lesson_revision_id", "lesson_id", "approval_status").distinct()
    tasks = read(spark, d, "task_projection", "task_projection_id", "lesson_id", "difficulty_confidence").distinct()
    reviews = tasks.filter("difficulty_confidence < 0.6").select(F.col("task_projection_id").alias("target")).unionByName(revisions.filter("approval_status = 'pending'").select(F.col("lesson_revision_id").alias("target"))).distinct()
    targets = tasks.select("lesson_id", F.col("task_projection_id").alias("target")).unionByName(lessons.select("lesson_id", F.col("active_revision_id").alias("target"))).distinct()
    out = None
    for name, table, key in (("revisions", revisions, "lesson_revision_id"), ("tasks", tasks, "task_projection_id"), ("reviews", reviews.join(targets, "target"), "target")):
        part = table.join(lessons.select("lesson_id"), "lesson_id", "left_semi").groupBy("lesson_id").agg(F.lit(name).alias("collection"), F.count_distinct(key).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@query("""WITH e AS (SELECT user_id, event_type, value < 3 AS failed, value BETWEEN 3 AND 4 AS skipped, event_type <> 'click' AS required FROM events) SELECT user_id, CASE WHEN bool_or(required AND failed) THEN 'NOT_READY' WHEN bool_or(skipped) THEN 'CONDITIONALLY_READY' ELSE 'READY' END AS readiness FROM e GROUP BY 1""")
def producer_readiness(spark: SparkSession, d: str) -> DataFrame:
    """Whether each producer's checks let it go on."""
    rows = read(spark, d, "events", "user_id", "event_type", "value")
    status = F.when(F.col("value") < 3, "failed").when(F.col("value").between(3, 4), "skipped").otherwise("passed")
    return H.readiness(rows.select("user_id", (F.col("event_type") != "click").alias("required"), status.alias("status")), ["user_id"])


@query(f"""WITH {_REVIEWS}, g(code, required) AS (VALUES ('Q0_pairing', true), ('Q1_structure', true), ('Q2_visibility', true), ('Q3_answer_binding', true), ('Q4_asset_binding', true), ('Q5_tiering', false)), e(code) AS (VALUES ('Q0_pairing'), ('Q1_structure'), ('Q2_visual_gate'), ('Q3_task_binding'))
SELECT coalesce(g.code, e.code) AS code, CASE WHEN e.code IS NULL THEN 'only_listed' WHEN g.code IS NULL THEN 'only_emitted' ELSE 'both' END AS side, required FROM g FULL OUTER JOIN e ON g.code = e.code""")
def quality_gates(spark: SparkSession, d: str) -> DataFrame:
    """The quality gates that are listed against those whose rows are emitted."""
    listed = spark.createDataFrame([("Q0_pairing", True), ("Q1_structure", True), ("Q2_visibility", True), ("Q3_answer_binding", True), ("Q4_asset_binding", True), ("Q5_tiering", False)], "code string, required boolean")
    emitted = seeded_quality(spark, d).select(F.col("check_code").alias("e")).distinct()
    both = listed.join(emitted, F.col("code") == F.col("e"), "full_outer")
    return both.select(F.coalesce("code", "e").alias("code"), F.when(F.col("e").isNull(), "only_listed").when(F.col("code").isNull(), "only_emitted").otherwise("both").alias("side"), "required")
