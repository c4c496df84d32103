"""Queries on quality: documents, required fields, question anchors on scanned pages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.functions import text as T
from slatemill.operators import geometry as G
from slatemill.registry import query
from slatemill.sources.tables import read

_REQUIRED = {"doc_pair": ("subject", "stage", "grade", "season", "teacher_path", "student_path"), "lesson": ("lesson_id", "title")}


@query(r"""WITH t AS (SELECT DISTINCT task_id, regexp_extract(task_id, '^(.*?):task:', 1) AS lesson_id, answer, explanation, confidence, risk_flags, page_start, page_end FROM task), f AS (SELECT lesson_id, array_to_string(list_sort(list(DISTINCT r)), ',') AS risks FROM (SELECT lesson_id, unnest(risk_flags) AS r FROM t) WHERE r IS NOT NULL GROUP BY 1)
SELECT t.lesson_id, count(*) AS n_tasks, count(*) FILTER (WHERE trim(regexp_replace(coalesce(answer, ''), '[\s\x{3000}\x{a0}]+', ' ', 'g')) <> '') AS n_answered, count(*) FILTER (WHERE trim(regexp_replace(coalesce(explanation, ''), '[\s\x{3000}\x{a0}]+', ' ', 'g')) <> '') AS n_explained, count(*) FILTER (WHERE confidence < 0.8) AS n_unsure, coalesce(string_agg(CASE WHEN confidence < 0.5 THEN task_id END, ',' ORDER BY task_id), '') AS unsure_ids, min(page_start) AS first_page, max(page_end) AS last_page, coalesce(any_value(f.risks), '') AS risks FROM t LEFT JOIN f USING (lesson_id) GROUP BY 1""")
def document_quality(spark: SparkSession, d: str) -> DataFrame:
    """Counts, page range and all risk flags of each document's tasks, in one aggregation."""
    rows = read(spark, d, "task", "task_id", "answer", "explanation", "confidence", "risk_flags", "page_start", "page_end").distinct().withColumn("lesson_id", F.regexp_extract("task_id", "^(.*?):task:", 1))
    filled = lambda c: F.count_if(T.norm(c) != "")
    flags = rows.select("lesson_id", F.explode("risk_flags").alias("r")).filter("r is not null").groupBy("lesson_id").agg(F.array_join(F.array_sort(F.collect_set("r")), ",").alias("risks"))
    counts = rows.groupBy("lesson_id").agg(F.count("*").alias("n_tasks"), filled("answer").alias("n_answered"), filled("explanation").alias("n_explained"), F.count_if(F.col("confidence") < 0.8).alias("n_unsure"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("confidence") < 0.5, F.col("task_id")))), ",").alias("unsure_ids"), F.min("page_start").alias("first_page"), F.max("page_end").alias("last_page"))
    return counts.join(flags, "lesson_id", "left").fillna("", ["risks"])


_FIELDS = [f"{s}.{f}" for s, fs in _REQUIRED.items() for f in fs] + ["nodes", "tasks", "schema_version"]


@query("SELECT DISTINCT split_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in _FIELDS) + "], lambda x: x IS NOT NULL), ',') AS missing FROM lesson_split")
def split_schema_check(spark: SparkSession, d: str) -> DataFrame:
    """Required fields that each split record lacks; empty if none."""
    rows = read(spark, d, "lesson_split", "split_id", "schema_version", "doc_pair", "lesson", "nodes", "tasks")
    return rows.select("split_id", F.array_join(F.array_compact(F.array(*[F.when(F.col(f).isNull(), f) for f in _FIELDS])), ",").alias("missing")).distinct()


_READING = r"rd AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY y0, x0, text) AS line_no FROM (SELECT DISTINCT line_id, doc_id, page, x0, y0, x1, y1, trim(regexp_replace(coalesce(text, ''), '[\s\x{3000}\x{a0}]+', ' ', 'g'), ' ') AS text FROM ocr_lines) WHERE text <> '')"


@query(rf"""WITH RECURSIVE {_READING}, nb AS (SELECT *, regexp_extract(text, '^\s*(\d{{1,3}})\s*[．.、]', 1) AS number, regexp_replace(text, '^\s*\d{{1,3}}\s*[．.、]\s*', '') AS rest, min(x0) OVER (PARTITION BY doc_id, page) AS lft FROM rd),
tl AS (SELECT a.doc_id, a.page, a.line_no, string_agg(b.text, '' ORDER BY b.x0, b.line_no, b.text) AS tail FROM nb a JOIN rd b ON a.doc_id = b.doc_id AND a.page = b.page AND b.line_no <> a.line_no AND b.x0 >= a.x1 AND b.y0 > a.y0 - 9 AND b.y0 < a.y0 + 9 WHERE a.number <> '' GROUP BY ALL),
st AS (SELECT nb.doc_id, nb.page, nb.line_no, number::INT AS number, y0 - 12 AS y FROM nb LEFT JOIN tl USING (doc_id, page, line_no) WHERE number <> '' AND x0 <= lft + 125 AND len(trim(rest || coalesce(tail, ''), ' ')) >= 4),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY y, line_no) AS i FROM st), f AS (SELECT *, y AS last, true AS kept FROM o WHERE i = 1 UNION ALL SELECT o.*, CASE WHEN o.y - f.last >= 12 THEN o.y ELSE f.last END, o.y - f.last >= 12 FROM f JOIN o ON o.doc_id = f.doc_id AND o.page = f.page AND o.i = f.i + 1),
op AS (SELECT f.doc_id, f.page, f.line_no, count(DISTINCT substr(trim(b.text, ' '), 1, 1)) AS n FROM f JOIN rd b ON b.doc_id = f.doc_id AND b.page = f.page AND b.y0 BETWEEN f.y AND f.y + 240 AND regexp_matches(b.text, '^\s*[AB]\s*[．.、]') WHERE kept GROUP BY ALL)
SELECT f.doc_id, f.page, f.line_no, f.number, coalesce(op.n = 2, false) AS has_options FROM f LEFT JOIN op USING (doc_id, page, line_no) WHERE kept""")
def page_question_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Where questions begin on scanned pages: numbers in the left gutter whose row goes on, at least twelve apart, and whether options follow."""
    lines = G.reading_order(read(spark, d, "ocr_lines", "line_id", "doc_id", "page", "x0", "y0", "x1", "y1", "text").distinct(), 1.0)
    return G.with_options(lines, G.question_anchors(lines)).select("doc_id", "page", "line_no", "number", "has_options")


@query(rf"""WITH {_READING}, s AS (SELECT line_id, doc_id, page, line_no, text, y0 * 1.6 AS y FROM rd) SELECT line_id, line_no FROM s WHERE NOT y > 2400 - 55 AND NOT (y > 2400 - 110 AND regexp_matches(text, '^\d{{1,4}}$')) AND text <> page::VARCHAR""")
def body_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines in reading order, scaled, without footers and without the number of their page."""
    lines = G.reading_order(read(spark, d, "ocr_lines", "line_id", "doc_id", "page", "x0", "y0", "x1", "y1", "text").distinct())
    return G.without_own_number(G.without_footers(lines, 2400.0)).select("line_id", "line_no")


@query("""WITH p AS (SELECT DISTINCT doc_id, page, line_id, score FROM ocr_lines), q AS (SELECT DISTINCT u.x.page AS page, u.x.parent_segment_id AS segment FROM split_questions, unnest(fragments) AS u(x)), i AS (SELECT page, count(*) AS n_images FROM q WHERE page IS NOT NULL GROUP BY 1)
SELECT doc_id, page, count(*) AS n_sure, coalesce(any_value(n_images), 0) AS n_images FROM p LEFT JOIN i USING (page) WHERE score >= 0.45 GROUP BY ALL""")
def sure_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each page that were read with enough certainty, and the pictures cut from pages of that number."""
    sure = read(spark, d, "ocr_lines", "doc_id", "page", "line_id", "score").distinct().filter("score >= 0.45")
    cuts = read(spark, d, "split_questions", "fragments").select(F.explode("fragments").alias("x")).select("x.page", F.col("x.parent_segment_id").alias("s")).filter("page is not null").distinct().groupBy("page").agg(F.count("*").alias("n_images"))
    return sure.groupBy("doc_id", "page").agg(F.count("*").alias("n_sure")).join(cuts, "page", "left").select("doc_id", "page", "n_sure", F.coalesce("n_images", F.lit(0)).alias("n_images"))


@query(r"""WITH RECURSIVE l AS (SELECT DISTINCT doc_id, page, pos, floor(y0)::INT AS y, text FROM ocr_lines), mk AS (SELECT DISTINCT doc_id, page, y FROM l WHERE regexp_matches(text, '^(例题讲解|强化训练|课后练习|能力进阶)')), cp AS (SELECT DISTINCT doc_id, page FROM l WHERE starts_with(text, '考点')),
la AS (SELECT doc_id, max(page * 100000 + y) AS last FROM mk WHERE page <> 1 GROUP BY 1), r AS (SELECT mk.*, cp.doc_id IS NOT NULL AS pointed, coalesce(last = mk.page * 100000 + y, false) AS is_last, row_number() OVER (PARTITION BY mk.doc_id ORDER BY mk.page, y) AS i FROM mk LEFT JOIN la USING (doc_id) LEFT JOIN cp ON cp.doc_id = mk.doc_id AND cp.page = mk.page),
k AS (SELECT r.*, CASE WHEN page = 1 THEN '' WHEN is_last AND NOT pointed THEN 'after_class' WHEN pointed THEN 'example' ELSE 'practice' END AS state, CASE WHEN page = 1 THEN CASE WHEN y < 260 THEN 'course_goal' ELSE 'knowledge' END WHEN is_last AND NOT pointed THEN 'after_class' WHEN pointed THEN 'example' ELSE 'practice' END AS kind FROM r WHERE i = 1
  UNION ALL SELECT r.*, CASE WHEN r.page = 1 THEN k.state WHEN r.is_last AND NOT r.pointed THEN 'after_class' WHEN r.pointed AND (r.y < 260 OR k.state IN ('', 'practice')) THEN 'example' ELSE 'practice' END, CASE WHEN r.page = 1 THEN CASE WHEN r.y < 260 THEN 'course_goal' ELSE 'knowledge' END WHEN r.is_last AND NOT r.pointed THEN 'after_class' WHEN r.pointed AND (r.y < 260 OR k.state IN ('', 'practice')) THEN 'example' ELSE 'practice' END FROM k JOIN r ON r.doc_id = k.doc_id AND r.i = k.i + 1)
SELECT doc_id, page, y, kind FROM k""")
def banner_kinds(spark: SparkSession, d: str) -> DataFrame:
    """The kind of each banner line by its place, the checkpoints of its page and the banner before it."""
    lines = read(spark, d, "ocr_lines", "doc_id", "page", "y0", "text").withColumn("y", F.floor("y0").cast("int"))
    marks = lines.filter(F.col("text").rlike("^(例题讲解|强化训练|课后练习|能力进阶)")).select("doc_id", "page", "y").distinct()
    return G.component_kinds(marks, lines.filter(F.col("text").startswith("考点")).select("doc_id", "page"))
