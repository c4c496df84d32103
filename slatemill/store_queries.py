"""Queries over the versioned store: states, lineage, idempotence, fingerprints, constraints, search, review, events."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.functions import text as T
from slatemill.operators import ordered as O
from slatemill.operators import store as S
from slatemill.registry import query
from slatemill.sources.tables import read
from slatemill.streaming import outbox

_REV = "r AS (SELECT DISTINCT lesson_revision_id, lesson_id, revision_no, status, content_hash, base_artifact_id, created_at FROM lesson_revision)"


def _revisions(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lesson_revision", "lesson_revision_id", "lesson_id", "revision_no", "status", "content_hash", "base_artifact_id", "created_at").distinct()


_TABLES = {"lesson": "lesson_id", "lesson_revision": "lesson_revision_id", "task_projection": "task_projection_id", "task": "task_id", "predictions": "prediction_id", "coverage_set_review": "test_question_id", "split_questions": "question_id", "knowledge_points": "knowledge_id"}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys FROM {t}" for t, k in _TABLES.items()) + " UNION ALL SELECT 'open reviews', count(*), count(DISTINCT prediction_id) FROM predictions WHERE review_status IN ('pending', 'in_review', 'changes_requested', 'rerun_requested', 'needs_teacher_review')")
def store_summary(spark: SparkSession, d: str) -> DataFrame:
    """Rows and different keys of each table, and reviews that are open; one pruned scan of a key column a table."""
    out = None
    for table, key in _TABLES.items():
        part = read(spark, d, table, key).agg(F.lit(table).alias("table_name"), F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"))
        out = part if out is None else out.unionByName(part)
    waiting = read(spark, d, "predictions", "prediction_id", "review_status").filter(F.col("review_status").isin("pending", "in_review", "changes_requested", "rerun_requested", "needs_teacher_review"))
    return out.unionByName(waiting.agg(F.lit("open reviews").alias("table_name"), F.count("*").alias("n_rows"), F.count_distinct("prediction_id").alias("n_keys")))


@query(f"""WITH {_REV}, l AS (SELECT DISTINCT * FROM lesson), p AS (SELECT lesson_id, count(DISTINCT task_projection_id) AS n FROM task_projection GROUP BY 1), w AS (SELECT lesson_id, count(*) FILTER (WHERE status <> 'published' OR status IS NULL) AS n FROM r GROUP BY 1),
s AS (SELECT lesson_revision_id, arg_max(status, created_at) AS status FROM r GROUP BY 1)
SELECT l.lesson_id, coalesce(p.n, 0) AS n_tasks, coalesce(w.n, 0) AS n_open, a.status AS active_status, b.status AS published_status FROM l LEFT JOIN p USING (lesson_id) LEFT JOIN w USING (lesson_id) LEFT JOIN s a ON a.lesson_revision_id = l.active_revision_id LEFT JOIN s b ON b.lesson_revision_id = nullif(trim(l.published_revision_id), '')""")
def lesson_list(spark: SparkSession, d: str) -> DataFrame:
    """Lessons with counts of tasks and open revisions and the states of their two revision pointers."""
    revisions = _revisions(spark, d)
    state = S.latest(revisions.select("lesson_revision_id", "status", "created_at"), ["lesson_revision_id"], [F.col("created_at")]).select("lesson_revision_id", "status")
    tasks = read(spark, d, "task_projection", "lesson_id", "task_projection_id").groupBy("lesson_id").agg(F.count_distinct("task_projection_id").alias("n_tasks"))
    waiting = revisions.groupBy("lesson_id").agg(F.count_if((F.col("status") != "published") | F.col("status").isNull()).alias("n_open"))
    point = lambda to, status: state.select(F.col("lesson_revision_id").alias(to), F.col("status").alias(status))
    lessons = read(spark, d, "lesson").distinct().withColumn("p", F.nullif(F.trim("published_revision_id"), F.lit("")))
    joined = lessons.join(tasks, "lesson_id", "left").join(waiting, "lesson_id", "left").join(point("active_revision_id", "active_status"), "active_revision_id", "left").join(point("p", "published_status"), "p", "left")
    return joined.select("lesson_id", F.coalesce("n_tasks", F.lit(0)).alias("n_tasks"), F.coalesce("n_open", F.lit(0)).alias("n_open"), "active_status", "published_status")


@query(f"WITH {_REV} SELECT lesson_revision_id, arg_max(status, struct_pack(a := created_at, b := status)) AS status, max(created_at) AS since FROM r GROUP BY 1")
def latest_revision_state(spark: SparkSession, d: str) -> DataFrame:
    """The present state of each revision of the append-only log."""
    last = S.latest(_revisions(spark, d).select("lesson_revision_id", "status", "created_at"), ["lesson_revision_id"], [F.col("created_at"), F.col("status")])
    return last.select("lesson_revision_id", "status", F.col("created_at").alias("since"))


@query(f"WITH {_REV} SELECT l.lesson_id, coalesce(max(r.revision_no), 0) + 1 AS next_no FROM (SELECT DISTINCT lesson_id FROM lesson) l LEFT JOIN r USING (lesson_id) GROUP BY 1")
def next_revision_no(spark: SparkSession, d: str) -> DataFrame:
    highest = _revisions(spark, d).groupBy("lesson_id").agg(F.max("revision_no").alias("m"))
    return read(spark, d, "lesson", "lesson_id").distinct().join(highest, "lesson_id", "left").select("lesson_id", (F.coalesce("m", F.lit(0)) + 1).alias("next_no"))


@query(f"""WITH RECURSIVE {_REV}, n AS (SELECT DISTINCT lesson_id, lesson_revision_id, revision_no FROM r), e AS (SELECT a.lesson_revision_id AS child, b.lesson_revision_id AS parent FROM n a JOIN n b ON a.lesson_id = b.lesson_id AND b.revision_no = a.revision_no - 1),
c AS (SELECT child AS start_id, parent AS node, 1 AS depth FROM e UNION SELECT c.start_id, e.parent, c.depth + 1 FROM c JOIN e ON e.child = c.node) SELECT start_id, node, min(depth) AS depth FROM c WHERE start_id <> node GROUP BY ALL""")
def revision_lineage(spark: SparkSession, d: str) -> DataFrame:
    """All ancestors of each revision, a revision's parent being the one before it."""
    nodes = _revisions(spark, d).select("lesson_id", "lesson_revision_id", "revision_no").distinct()
    before = nodes.select("lesson_id", F.col("lesson_revision_id").alias("parent"), (F.col("revision_no") + 1).alias("revision_no"))
    edges = nodes.join(before, ["lesson_id", "revision_no"]).select(F.col("lesson_revision_id").alias("child"), "parent")
    return S.lineage(edges).withColumnRenamed("start", "start_id")


@query("""WITH t AS (SELECT DISTINCT task_projection_id, trim(lesson_revision_id) AS k FROM task_projection) SELECT DISTINCT k AS lesson_revision_id FROM t WHERE k <> '' AND k NOT IN (SELECT lesson_revision_id FROM lesson_revision WHERE lesson_revision_id IS NOT NULL)""")
def ensured_revisions(spark: SparkSession, d: str) -> DataFrame:
    """Revision keys that an insert-if-absent of all referenced ones would add."""
    wanted = read(spark, d, "task_projection", "lesson_revision_id").select(F.nullif(F.trim("lesson_revision_id"), F.lit("")).alias("lesson_revision_id"))
    return S.ensure(wanted, read(spark, d, "lesson_revision", "lesson_revision_id"), ["lesson_revision_id"])


@query("""WITH k AS (SELECT lesson_id AS key, list(DISTINCT content_hash) AS h FROM lesson_revision GROUP BY 1), n AS (SELECT DISTINCT task_projection_id, lesson_id AS key, content_hash FROM task_projection)
SELECT task_projection_id, CASE WHEN k.key IS NULL THEN 'created' WHEN list_contains(k.h, n.content_hash) THEN 'idempotent' ELSE 'new_revision' END AS outcome FROM n LEFT JOIN k USING (key)""")
def import_outcome(spark: SparkSession, d: str) -> DataFrame:
    new = read(spark, d, "task_projection", "task_projection_id", F.col("lesson_id").alias("key"), "content_hash").distinct()
    return S.import_bundle(new, read(spark, d, "lesson_revision", F.col("lesson_id").alias("key"), "content_hash"), "key", "content_hash").select("task_projection_id", "outcome")


@query("SELECT md5(text) AS content_hash, count(*) AS n_copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def repeated_documents(spark: SparkSession, d: str) -> DataFrame:
    """Contents that recur, by hash: what an idempotent import takes once."""
    return read(spark, d, "documents", "doc_id", "text").groupBy(F.md5("text").alias("content_hash")).agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("first_id")).filter("n_copies > 1")


#: Tables with their key, what orders the states of a key, and the columns that every delivery changes.
_STATES = {"lesson": ("lesson_id", "updated_at", ()), "lesson_revision": ("lesson_revision_id", "created_at", ("ingested_at",)), "task_projection": ("task_projection_id", "created_at", ("ingested_at",)), "knowledge_points": ("knowledge_id", "loaded_at", ())}
_COLUMNS = {
    "lesson": "lesson_id document_group_id subject stage grade season title active_revision_id published_revision_id status created_at updated_at".split(), "lesson_revision": "lesson_revision_id lesson_id base_artifact_id revision_no status approval_status bundle_jsonb content_hash created_by created_at".split(),
    "task_projection": "task_projection_id lesson_id lesson_revision_id local_task_id source_node_local_id subject grade question_type stem answer difficulty_level difficulty_confidence checkpoint_codes subject_tags content_hash created_at".split(),
    "knowledge_points": "knowledge_id lesson_id stage grade season lesson_no lesson_title level_1_lesson_topic level_2_module level_3_min_knowledge_point source_difficulty_star source_page confidence review_status source_pdf_path loaded_at".split(),
}


#: The day of the mirror.
_MIRRORED = "2026-01-01"


def _hash_sql(table: str, rows: str) -> str:
    text = ", ".join(f"coalesce({f'to_json({c})::VARCHAR' if c in ('checkpoint_codes', 'subject_tags') else f'{c}::VARCHAR'}, chr(0))" for c in _COLUMNS[table])
    return f"SELECT '{table}' AS table_name, count(*) AS n_rows, coalesce(bit_xor(a), 0) AS content_xor, coalesce(sum(b % 2147483647), 0)::BIGINT AS content_sum FROM (SELECT ('0x' || substr(h, 1, 15))::BIGINT AS a, ('0x' || substr(h, 17, 15))::BIGINT AS b FROM (SELECT md5(concat_ws(chr(31), {text})) AS h FROM {rows}))"


def _state_sql(table: str, mirror: bool) -> str:
    key, order, _ = _STATES[table]
    where = f"WHERE {order} < TIMESTAMP '{_MIRRORED}'" if mirror else ""
    return f"(SELECT * FROM {table} {where} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order} DESC) = 1)"


def _states(spark: SparkSession, d: str, table: str, mirror: bool) -> DataFrame:
    """The present state of each key, or its state in a mirror that has heard of nothing since a day."""
    key, order, _ = _STATES[table]
    rows = read(spark, d, table, *_COLUMNS[table])
    rows = rows.filter(F.col(order) < F.lit(_MIRRORED).cast("timestamp_ntz")) if mirror else rows
    return S.latest(rows, [key], [F.col(order)]).select(*_COLUMNS[table])


def _prints(spark: SparkSession, d: str, mirror: bool | None) -> DataFrame:
    out = None
    for table, columns in _COLUMNS.items():
        rows = read(spark, d, table, *columns) if mirror is None else _states(spark, d, table, mirror)
        part = S.fingerprint(rows, table, columns)
        out = part if out is None else out.unionByName(part)
    return out


@query(" UNION ALL ".join(_hash_sql(t, t) for t in _COLUMNS))
def table_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Rows and content hash of each table over all its columns, as delivered."""
    return _prints(spark, d, None)


@query("WITH a AS (" + " UNION ALL ".join(_hash_sql(t, _state_sql(t, False)) for t in _COLUMNS) + "), b AS (" + " UNION ALL ".join(_hash_sql(t, _state_sql(t, True)) for t in _COLUMNS) + ") SELECT table_name, a.n_rows AS left_rows, b.n_rows AS right_rows, a.n_rows = b.n_rows AND a.content_xor = b.content_xor AND a.content_sum = b.content_sum AS consistent FROM a JOIN b USING (table_name)")
def consistency_report(spark: SparkSession, d: str) -> DataFrame:
    """The present state of each table against its mirror; ok or not, by count and hash."""
    return S.consistency(_prints(spark, d, False), _prints(spark, d, True))


@query(f"""WITH a AS (SELECT {', '.join(_COLUMNS['lesson_revision'])} FROM {_state_sql('lesson_revision', False)}), b AS (SELECT {', '.join(_COLUMNS['lesson_revision'])} FROM {_state_sql('lesson_revision', True)})
SELECT lesson_revision_id, status, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT lesson_revision_id, status, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def mirror_difference(spark: SparkSession, d: str) -> DataFrame:
    """The rows in which the revisions' snapshot and its mirror differ."""
    return S.row_difference(_states(spark, d, "lesson_revision", False), _states(spark, d, "lesson_revision", True)).select("lesson_revision_id", "status", "side")


@query("""WITH r AS (SELECT lesson_id FROM lesson WHERE status = 'reviewing'), v AS (SELECT DISTINCT lesson_revision_id FROM lesson_revision WHERE lesson_id IN (SELECT lesson_id FROM r)), t AS (SELECT DISTINCT task_projection_id, lesson_id, lesson_revision_id FROM task_projection)
SELECT 'lesson' AS table_name, count(DISTINCT lesson_id) AS n_left, 0::BIGINT AS n_emptied FROM lesson WHERE lesson_id NOT IN (SELECT lesson_id FROM r) UNION ALL SELECT 'lesson_revision', count(DISTINCT lesson_revision_id), 0 FROM lesson_revision WHERE lesson_revision_id NOT IN (SELECT lesson_revision_id FROM v)
UNION ALL SELECT 'task_projection', count(*), 0 FROM t WHERE (lesson_id IS NULL OR lesson_id NOT IN (SELECT lesson_id FROM r)) AND (lesson_revision_id IS NULL OR lesson_revision_id NOT IN (SELECT lesson_revision_id FROM v))
UNION ALL SELECT 'task', count(*), count(*) FILTER (WHERE l IN (SELECT lesson_id FROM r)) FROM (SELECT DISTINCT task_id, regexp_extract(task_id, '^(.*?):task:', 1) AS l FROM task)""")
def cascaded_delete(spark: SparkSession, d: str) -> DataFrame:
    """What is left after the lessons in review are deleted: revisions and projections go with them, tasks keep their row and lose the reference."""
    gone = read(spark, d, "lesson", "lesson_id", "status").filter("status = 'reviewing'").select("lesson_id").distinct()
    revisions = read(spark, d, "lesson_revision", "lesson_revision_id", "lesson_id").distinct()
    left = S.cascade(revisions, "lesson_id", gone, "lesson_id")
    dropped = revisions.join(gone, "lesson_id", "left_semi").select("lesson_revision_id").distinct()
    tasks = read(spark, d, "task_projection", "task_projection_id", "lesson_id", "lesson_revision_id").distinct()
    tasks = S.cascade(S.cascade(tasks, "lesson_id", gone, "lesson_id"), "lesson_revision_id", dropped, "lesson_revision_id")
    loose = read(spark, d, "task", "task_id").distinct().withColumn("lesson_id", F.regexp_extract("task_id", "^(.*?):task:", 1))
    emptied = S.set_null(loose, "lesson_id", gone, "lesson_id")
    count = lambda name, table, key, more=F.lit(0): table.agg(F.lit(name).alias("table_name"), F.count_distinct(key).alias("n_left"), more.cast("long").alias("n_emptied"))
    out = count("lesson", S.cascade(read(spark, d, "lesson", "lesson_id"), "lesson_id", gone, "lesson_id"), "lesson_id")
    for part in (count("lesson_revision", left, "lesson_revision_id"), count("task_projection", tasks, "task_projection_id"), count("task", emptied, "task_id", F.count_if(F.col("lesson_id").isNull()))):
        out = out.unionByName(part)
    return out


#: Constraints: name, kind, table and columns. The driver's tables stand in for those of the store that have no data here.
_UNIQUE = (("unique_revision_no", "lesson_revision", ("lesson_id", "revision_no"), "lesson_revision_id"), ("unique_attempt_no", "lineitem", ("l_orderkey", "l_linenumber"), "l_partkey"), ("unique_local_task", "task_projection", ("lesson_revision_id", "local_task_id"), "task_projection_id"))
_CHECK = (
    ("review_status_known", "predictions", "prediction_id", "review_status", "review_status IN ('accepted', 'pending', 'in_review', 'approved', 'changes_requested', 'rejected', 'published')"), ("publication_status_known", "lesson", "lesson_id", "status", "status IN ('preparing', 'published', 'failed', 'revoked', 'superseded')"), ("job_status_known", "orders", "o_orderkey", "o_orderstatus", "o_orderstatus IN ('F', 'O', 'P')"),
    ("projection_confidence_in_range", "task_projection", "task_projection_id", "difficulty_confidence", "difficulty_confidence >= 0 AND difficulty_confidence <= 1"), ("bank_confidence_in_range", "task", "task_id", "confidence", "confidence >= 0 AND confidence <= 1"), ("component_confidence_in_range", "ocr_lines", "line_id", "score", "score >= 0 AND score <= 1"),
    ("positive_sort_index", "split_questions", "question_id", "local_number", "local_number > 0"),
)
_REFERENCE = (
    ("revision_has_lesson", "lesson_revision", "lesson_revision_id", "lesson_id", "lesson", "lesson_id"), ("projection_has_lesson", "task_projection", "task_projection_id", "lesson_id", "lesson", "lesson_id"), ("projection_has_revision", "task_projection", "task_projection_id", "lesson_revision_id", "lesson_revision", "lesson_revision_id"),
    ("bank_revision_has_item", "coverage_set_review", "test_question_id", "knowledge_id", "knowledge_points", "knowledge_id"), ("source_link_has_revision", "predictions", "prediction_id", "test_question_id", "coverage_set_review", "test_question_id"), ("publication_has_lesson", "coverage_set_review", "test_question_id", "lesson_id", "knowledge_points", "lesson_id"),
    ("publication_has_revision", "lesson", "lesson_id", "active_revision_id", "lesson_revision", "lesson_revision_id"), ("build_has_lesson", "orders", "o_orderkey", "o_custkey", "customer", "c_custkey"), ("item_has_build", "lineitem", "l_orderkey", "l_orderkey", "orders", "o_orderkey"),
    ("item_has_question_revision", "lineitem", "l_orderkey", "l_partkey", "part", "p_partkey"), ("page_has_document", "customer", "c_custkey", "c_nationkey", "nation", "n_nationkey"), ("component_has_page", "nation", "n_nationkey", "n_regionkey", "region", "r_regionkey"), ("component_revision_has_component", "lineitem", "l_orderkey", "l_suppkey", "supplier", "s_suppkey"),
)


@query(
    " UNION ALL ".join(
        [f"SELECT '{n}' AS constraint_name, count(*) AS n_violations FROM (SELECT {', '.join(c)} FROM (SELECT DISTINCT {', '.join(c)}, {k} FROM {t}) GROUP BY ALL HAVING count(*) > 1)" for n, t, c, k in _UNIQUE]
        + [f"SELECT '{n}', count(*) FILTER (WHERE NOT ({e})) FROM (SELECT DISTINCT {k}, {c} FROM {t})" for n, t, k, c, e in _CHECK]
        + [f"SELECT '{n}', count(*) FROM (SELECT DISTINCT {k} AS k, {c} AS c FROM {t}) WHERE c IS NOT NULL AND c NOT IN (SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL)" for n, t, k, c, p, pc in _REFERENCE]
    )
)
def constraint_violations(spark: SparkSession, d: str) -> DataFrame:
    """Violations of every unique key, check and reference; redelivered rows count once."""
    parts = [S.unique_violations(read(spark, d, t, *dict.fromkeys((*c, k))).distinct(), n, [*c]) for n, t, c, k in _UNIQUE]
    parts += [S.check_violations(read(spark, d, t, k, c).distinct(), n, F.expr(e)) for n, t, k, c, e in _CHECK]
    parts += [S.reference_violations(read(spark, d, t, F.col(k).alias("k"), F.col(c).alias("c")).distinct(), "c", read(spark, d, p, pc), pc, n) for n, t, k, c, p, pc in _REFERENCE]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("""WITH t AS (SELECT DISTINCT task_id FROM task) SELECT t.task_id, l.lesson_id, l.subject, l.status FROM t JOIN (SELECT DISTINCT lesson_id, subject, status FROM lesson) l ON starts_with(t.task_id, l.lesson_id || ':task:')""")
def tasks_of_lessons(spark: SparkSession, d: str) -> DataFrame:
    """Tasks by the lesson that their id begins with: a prefix join as an equi join on the extracted prefix."""
    tasks = read(spark, d, "task", "task_id").distinct().withColumn("lesson_id", F.regexp_extract("task_id", "^(.*?):task:", 1))
    return tasks.join(read(spark, d, "lesson", "lesson_id", "subject", "status").distinct(), "lesson_id").select("task_id", "lesson_id", "subject", "status")


def search_tasks(tasks: DataFrame, lessons: DataFrame, subject: str | None = None, published_only: bool = False, q: str | None = None) -> DataFrame:
    """tasks (task_projection_id, lesson_id, lesson_revision_id, subject, stem) that hold a term, of a subject, of a published revision; each filter only if given.

    The filters reach the scan; the published revisions are one semi join on trimmed keys.
    """
    if subject is not None:
        tasks = tasks.filter(F.col("subject") == subject)
    if q:
        tasks = tasks.filter(F.col("stem").contains(q))
    if published_only:
        shown = lessons.filter("status = 'published'").select("lesson_id", F.trim("published_revision_id").alias("_k")).filter("_k <> ''")
        tasks = tasks.withColumn("_k", F.trim("lesson_revision_id")).join(shown, ["lesson_id", "_k"], "left_semi").drop("_k")
    return tasks


_SEARCHES = ((None, True, "方程"), ("数学", False, "平行"), ("物理", True, None), (None, False, "体积"), ("化学", True, "溶液"))


@query("WITH t AS (SELECT DISTINCT task_projection_id, lesson_id, trim(lesson_revision_id, ' ') AS k, subject, stem FROM task_projection), l AS (SELECT DISTINCT lesson_id, trim(published_revision_id, ' ') AS k FROM lesson WHERE status = 'published' AND trim(published_revision_id, ' ') <> '') " + " UNION ALL ".join(f"SELECT {i} AS search_no, task_projection_id, subject FROM t WHERE true{f" AND subject = '{s}'" if s else ''}{f" AND contains(stem, '{q}')" if q else ''}{' AND EXISTS (SELECT 1 FROM l WHERE l.lesson_id = t.lesson_id AND l.k = t.k)' if pub else ''}" for i, (s, pub, q) in enumerate(_SEARCHES)))
def task_search(spark: SparkSession, d: str) -> DataFrame:
    """Searches by term, subject and publication, alone and together."""
    tasks = read(spark, d, "task_projection", "task_projection_id", "lesson_id", "lesson_revision_id", "subject", "stem").distinct()
    lessons = read(spark, d, "lesson", "lesson_id", "status", "published_revision_id").distinct()
    out = None
    for i, (subject, published, q) in enumerate(_SEARCHES):
        part = search_tasks(tasks, lessons, subject, published, q).select(F.lit(i).alias("search_no"), "task_projection_id", "subject")
        out = part if out is None else out.unionByName(part)
    return out


def of_status(rows: DataFrame, status: str | None = None, column: str = "status") -> DataFrame:
    """rows of a status; all of them if none is given."""
    return rows if status is None else rows.filter(F.col(column) == status)


@query("""WITH p AS (SELECT DISTINCT prediction_id, review_status FROM predictions) SELECT 'all' AS filter, count(*) AS n FROM p UNION ALL SELECT 'needs_teacher_review', count(*) FROM p WHERE review_status = 'needs_teacher_review' UNION ALL SELECT 'accepted', count(*) FROM p WHERE review_status = 'accepted'""")
def filtered_reviews(spark: SparkSession, d: str) -> DataFrame:
    """The list of reviews with and without its optional filter."""
    rows = read(spark, d, "predictions", "prediction_id", "review_status").distinct()
    count = lambda name, status: of_status(rows, status, "review_status").agg(F.lit(name).alias("filter"), F.count("*").alias("n"))
    return count("all", None).unionByName(count("needs_teacher_review", "needs_teacher_review")).unionByName(count("accepted", "accepted"))


@query("""SELECT DISTINCT lesson_revision_id FROM lesson_revision r WHERE EXISTS (SELECT 1 FROM lesson l WHERE l.active_revision_id = r.lesson_revision_id) OR EXISTS (SELECT 1 FROM lesson l WHERE trim(l.published_revision_id) = r.lesson_revision_id)""")
def pointed_revisions(spark: SparkSession, d: str) -> DataFrame:
    """Revisions that one pointer or the other names: a disjunction as the union of two semi joins."""
    lessons = read(spark, d, "lesson", "active_revision_id", "published_revision_id").withColumn("p", F.trim("published_revision_id"))
    revisions = read(spark, d, "lesson_revision", "lesson_revision_id").distinct()
    return S.either_semi(revisions, "lesson_revision_id", ("lesson_revision_id", lessons, "active_revision_id"), ("lesson_revision_id", lessons, "p"))


@query("""WITH p AS (SELECT DISTINCT prediction_id, review_status, created_at FROM predictions), w AS (SELECT *, CASE review_status WHEN 'needs_teacher_review' THEN 3 WHEN 'needs_review' THEN 2 ELSE 1 END AS weight FROM p ORDER BY weight DESC, created_at, prediction_id LIMIT 8)
SELECT lpad(row_number() OVER (ORDER BY weight DESC, created_at, prediction_id)::VARCHAR, 2, '0') AS queue_no, prediction_id, weight FROM w""")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    """The eight most pressing reviews, numbered; a top-k, so nothing is sorted as a whole."""
    weight = F.when(F.col("review_status") == "needs_teacher_review", 3).when(F.col("review_status") == "needs_review", 2).otherwise(1)
    rows = read(spark, d, "predictions", "prediction_id", "review_status", "created_at").distinct().withColumn("weight", weight)
    top = rows.orderBy(F.desc("weight"), F.asc_nulls_last("created_at"), "prediction_id").limit(8)
    from pyspark.sql import Window

    return top.select(F.format_string("%02d", F.row_number().over(Window.orderBy(F.desc("weight"), F.asc_nulls_last("created_at"), "prediction_id"))).alias("queue_no"), "prediction_id", "weight")


@query("""WITH l AS (SELECT subject, status, count(DISTINCT lesson_id) AS n FROM lesson GROUP BY ALL), v(vn, version) AS (VALUES (1, '常用版'), (2, '基础版'), (3, '进阶版')), a(an, audience) AS (VALUES (1, 'student'), (2, 'teacher')), f(fn, format) AS (VALUES (1, 'docx'), (2, 'pdf')), s AS (SELECT subject, sum(n)::BIGINT AS n_lessons FROM l WHERE status = 'published' GROUP BY 1)
SELECT subject, version, audience, format, n_lessons, ((vn - 1) * 4 + (an - 1) * 2 + fn)::BIGINT AS place FROM s, v, a, f""")
def export_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Versions, audiences and formats to export for each subject, in a fixed order; the matrix is an array literal, not a join."""
    lessons = read(spark, d, "lesson", "lesson_id", "subject", "status").filter("status = 'published'").groupBy("subject").agg(F.count_distinct("lesson_id").alias("n_lessons"))
    cells = [F.struct(F.lit(v).alias("version"), F.lit(a).alias("audience"), F.lit(f).alias("format")) for v in ("常用版", "基础版", "进阶版") for a in ("student", "teacher") for f in ("docx", "pdf")]
    return lessons.select("subject", "n_lessons", F.posexplode(F.array(*cells)).alias("p", "x")).select("subject", "x.*", "n_lessons", (F.col("p") + 1).cast("long").alias("place"))


@query("SELECT DISTINCT lesson_id, coalesce(nullif(trim(both '_' FROM regexp_replace(lower(trim(coalesce(title, ''))), '[^\\p{L}\\p{N}]+', '_', 'g')), ''), 'unknown') AS slug FROM lesson")
def lesson_slugs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lesson", "lesson_id", "title").select("lesson_id", T.slug("title").alias("slug")).distinct()


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n_events, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def outbox_windows(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts of events by type: the batch form of the streaming aggregation."""
    events = read(spark, d, "events", "ts", "event_type", "value").withColumn("ts", F.col("ts").cast("timestamp"))
    return outbox.window_counts(events, "1 day").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n_events", F.round("total", 2).alias("total"))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n_events FROM s GROUP BY user_id, n""")
def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events", "user_id", "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    return outbox.sessions(events, "6 hours").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query("SELECT user_id, max(ts) AS last_beat, 'retry_wait' AS status FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 12 HOUR")
def stalled_jobs(spark: SparkSession, d: str) -> DataFrame:
    """Producers whose last heartbeat is over twelve hours old at a given time."""
    events = read(spark, d, "events", "user_id", "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    return outbox.stalled(events, "user_id", "2024-01-30 12:00:00", "12 HOURS").withColumn("last_beat", F.col("last_beat").cast("timestamp_ntz"))


@query("SELECT region.r_name, nation.n_name, count(DISTINCT o_orderkey) AS n_runs, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus = 'F' GROUP BY ALL")
def runs_by_region(spark: SparkSession, d: str) -> DataFrame:
    """Runs rolled up along the catalog's hierarchy; the filter reaches the scan, and only key columns are shuffled."""
    orders = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").filter("o_orderstatus = 'F'")
    joined = orders.join(read(spark, d, "customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(read(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey")).join(read(spark, d, "region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name", "n_name").agg(F.count_distinct("o_orderkey").alias("n_runs"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    """Keys that are not unique though they should be."""
    return read(spark, d, "lineitem", "l_orderkey", "l_linenumber").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


@query("WITH j AS (SELECT event_id, props::JSON ->> '$.k' AS k, event_type FROM events) SELECT event_type, count(*) AS n, count(DISTINCT k) AS n_values, max(k::BIGINT) AS most FROM j GROUP BY 1")
def event_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Values read out of JSON payloads, by type of event."""
    rows = read(spark, d, "events", "event_type", "props").withColumn("k", F.get_json_object("props", "$.k"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("k").alias("n_values"), F.max(F.col("k").cast("long")).alias("most"))
