"""Queries over the catalog, coverage and predictions: curation, evaluation, page matching, gold sets."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.functions import rules as R
from slatemill.functions import text as T
from slatemill.operators import evaluation as E
from slatemill.operators import gold as G
from slatemill.operators.ordered import nth, numbered, page_lines
from slatemill.registry import query
from slatemill.sources.tables import read

#: Fragments of SQL that several twins share. Blanks are spelled as in functions.text.
_N = lambda c: rf"trim(regexp_replace(coalesce({c}, ''), '[\s\x{{3000}}\x{{a0}}]+', ' ', 'g'), ' ')"
_COVERAGE = "c AS (SELECT DISTINCT * FROM coverage_set_review)"
_PREDICTED = """
pr AS (SELECT test_question_id AS q, file, pos, final_top3 FROM (SELECT coalesce(test_question_id, question_id) AS test_question_id, file, pos, final_top3 FROM predictions) WHERE test_question_id IS NOT NULL),
last AS (SELECT q, arg_max(coalesce(list_transform(final_top3, lambda x: x.knowledge_id), []), struct_pack(file := file, pos := pos)) AS ids FROM pr GROUP BY q),
named AS (SELECT q, u.k, kp.lesson_id, kp.level_2_module AS module, kp.level_3_min_knowledge_point AS point FROM last, unnest(ids) AS u(k) LEFT JOIN knowledge_points kp ON kp.knowledge_id = u.k WHERE u.k IS NOT NULL),
scored AS (SELECT c.test_question_id, c.stage, c.grade, c.knowledge_id, c.lesson_id, c.module, c.min_knowledge_point, l.q IS NOT NULL AS predicted,
  coalesce(bool_or(trim(n.k) = trim(c.knowledge_id)), false) AS knowledge_hit, coalesce(bool_or(coalesce(trim(n.lesson_id), '') = coalesce(trim(c.lesson_id), '') AND n.q IS NOT NULL), false) AS lesson_hit,
  coalesce(bool_or(coalesce(trim(n.module), '') = coalesce(trim(c.module), '') AND n.q IS NOT NULL), false) AS module_hit, coalesce(bool_or(coalesce(trim(n.point), '') = coalesce(trim(c.min_knowledge_point), '') AND n.q IS NOT NULL), false) AS point_hit
  FROM c LEFT JOIN last l ON l.q = c.test_question_id LEFT JOIN named n ON n.q = c.test_question_id GROUP BY ALL)"""
_RATE = lambda f: f"round(coalesce(count(*) FILTER (WHERE {f})::DOUBLE / nullif(count(*), 0), 0), 4)"
_RATES = "count(*) AS n_questions, count(*) FILTER (WHERE predicted) AS n_predicted, " + ", ".join(f"{_RATE(f)} AS {f.replace('hit', 'rate')}" for f in E.LEVELS)


def _coverage(spark: SparkSession, d: str) -> DataFrame:
    """Coverage rows, redelivered ones once: by the key, so that only columns in use are shuffled."""
    return read(spark, d, "coverage_set_review").dropDuplicates(["test_question_id"])


def _scored(spark: SparkSession, d: str) -> DataFrame:
    found = read(spark, d, "predictions", "test_question_id", "question_id", "file", "pos", "final_top3")
    found = found.select(F.coalesce("test_question_id", "question_id").alias("test_question_id"), F.coalesce(F.transform("final_top3", lambda x: x["knowledge_id"]), F.array().cast("array<string>")).alias("knowledge_ids"), "file", "pos").filter("test_question_id is not null")
    catalog = read(spark, d, "knowledge_points", "knowledge_id", "lesson_id", F.col("level_2_module").alias("module"), F.col("level_3_min_knowledge_point").alias("min_knowledge_point"))
    gold = _coverage(spark, d).select("test_question_id", "stage", "grade", "knowledge_id", "lesson_id", "module", "min_knowledge_point")
    return E.hits(gold, found, catalog)


@query(f"WITH {_COVERAGE}, {_PREDICTED} SELECT test_question_id, predicted, knowledge_hit, lesson_hit, module_hit, point_hit FROM scored")
def topk_hits(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("test_question_id", "predicted", *E.LEVELS)


@query(f"WITH {_COVERAGE}, {_PREDICTED} SELECT {_RATES} FROM scored")
def hit_rates(spark: SparkSession, d: str) -> DataFrame:
    return E.rates(_scored(spark, d))


@query(f"WITH {_COVERAGE}, {_PREDICTED} SELECT coalesce(stage, 'None') || '/' || coalesce(grade, 'None') AS stage_grade, {_RATES} FROM scored GROUP BY 1")
def hit_rates_by_group(spark: SparkSession, d: str) -> DataFrame:
    scored = _scored(spark, d).withColumn("stage_grade", F.concat_ws("/", F.coalesce("stage", F.lit("None")), F.coalesce("grade", F.lit("None"))))
    return E.rates(scored, "stage_grade")


@query(f"""WITH {_COVERAGE}, {_PREDICTED} SELECT test_question_id, CASE WHEN NOT predicted THEN 'missing_prediction' WHEN NOT lesson_hit THEN 'lesson_miss' WHEN NOT module_hit THEN 'module_miss' WHEN NOT point_hit THEN 'point_miss' ELSE 'id_mismatch' END AS issue_type
FROM scored WHERE NOT (predicted AND lesson_hit AND module_hit AND point_hit AND knowledge_hit)""")
def eval_issues(spark: SparkSession, d: str) -> DataFrame:
    return E.issues(_scored(spark, d)).select("test_question_id", "issue_type")


@query("""WITH p AS (SELECT DISTINCT prediction_id, final_top3[1].knowledge_id AS k FROM predictions), g AS (SELECT coalesce(k, 'unmatched') AS candidate, count(*) AS n FROM p GROUP BY 1)
SELECT candidate, n, dense_rank() OVER (ORDER BY n DESC) AS rank FROM g""")
def top1_distribution(spark: SparkSession, d: str) -> DataFrame:
    first = read(spark, d, "predictions", "prediction_id", "final_top3").select("prediction_id", F.try_element_at("final_top3", F.lit(1))["knowledge_id"].alias("k")).distinct()
    return E.top_distribution(first, F.col("k"))


_CUE = lambda words: "|".join(words)
_COUNT = lambda c, words: " + ".join(f"({c} LIKE '%{w}%')::INT" for w in words)
_RULES = rf"""
t AS (SELECT *, {_N("question_text_ocr")} AS x FROM c),
h AS (SELECT *, substr(x, 1, 380) AS h380, substr(x, 1, 320) AS h320, substr(x, 1, 520) AS h520, regexp_extract(substr(x, 1, 180), '^\s*\d+\s*[.．、]\s*([^。；;．]{{0,80}})', 1) AS clause FROM t),
o AS (SELECT *, len(list_filter(regexp_extract_all(h380, '(^|[。；;．])\s*\d+\s*[.．、]\s*([^。；;．]{{0,45}})', 2), lambda y: regexp_matches(y, '{_CUE(R.OBJECTIVE_VERBS)}'))) >= 2 AND {_COUNT("h380", R.PROBLEM_VERBS)} <= 1 AS aims_380,
  len(list_filter(regexp_extract_all(h320, '(^|[。；;．])\s*\d+\s*[.．、]\s*([^。；;．]{{0,45}})', 2), lambda y: regexp_matches(y, '{_CUE(R.OBJECTIVE_VERBS)}'))) >= 2 AND {_COUNT("h320", R.PROBLEM_VERBS)} <= 1 AS aims_320 FROM h),
m AS (SELECT *, NOT aims_320 AND (regexp_matches(h320, '{_CUE(R.QUESTION_MARKS)}') OR regexp_matches(h320, '(^|[。；;])\s*\d+\s*[.．、)]')) AS marked FROM o),
v AS (SELECT *, aims_380 OR regexp_matches(substr(clause, 1, 24), '{_CUE(R.SINGLE_VERBS)}') OR (regexp_matches(clause, '{_CUE(R.SINGLE_VERBS)}') AND NOT regexp_matches(clause, '{_CUE(R.PROBLEM_VERBS)}')) OR h520 LIKE '%知识导航%' OR regexp_matches(substr(h520, 1, 80), '重要性|学生版删除') OR substr(h520, 1, 140) LIKE '%课程衔接%'
  OR ({_COUNT("h520", R.NAVIGATION_MARKS)} >= 2 AND NOT marked) AS navigates FROM m),
dup AS (SELECT substr(x, 1, 160) AS snippet, count(*) AS n FROM t WHERE substr(x, 1, 160) <> '' GROUP BY 1),
ruled AS (SELECT v.*, coalesce(dup.n, 0) AS duplicate_count, s.point_hit AS ph, s.lesson_hit AS lh FROM v LEFT JOIN dup ON dup.snippet = substr(v.x, 1, 160) LEFT JOIN scored s USING (test_question_id)),
verdict AS (SELECT *, CASE WHEN coalesce(status, '') <> 'ok' OR x = '' THEN 'RE_CROP_REQUIRED|P0|no_text' WHEN navigates THEN 'RE_CROP_REQUIRED|P0|navigation' WHEN duplicate_count >= 3 THEN 'RE_CROP_REQUIRED|P0|shared_snippet'
  WHEN NOT marked THEN 'REVIEW_REQUIRED|P1|no_question_marker' WHEN coalesce(selection_quality, '') = 'fallback_page_context' THEN 'REVIEW_REQUIRED|P1|fallback_page' WHEN NOT ph AND lh THEN 'REVIEW_REQUIRED|P1|point_miss' WHEN NOT ph THEN 'REVIEW_REQUIRED|P1|lesson_miss'
  WHEN coalesce(selection_quality, '') = 'nearby_question_match' THEN 'USABLE_WITH_REVIEW|P2|nearby_match' ELSE 'USABLE_GOLD|OK|gold' END AS verdict FROM ruled),
curated AS (SELECT test_question_id, stage, grade, duplicate_count, split_part(verdict, '|', 1) AS curation_status, split_part(verdict, '|', 2) AS priority, split_part(verdict, '|', 3) AS reason_code FROM verdict)"""


def _curated(spark: SparkSession, d: str) -> DataFrame:
    rows = G.duplicate_counts(_coverage(spark, d), "question_text_ocr")
    return G.curate(rows, _scored(spark, d).select("test_question_id", "point_hit", "lesson_hit"))


@query(f"WITH {_COVERAGE}, {_PREDICTED}, {_RULES} SELECT test_question_id, duplicate_count, curation_status, priority, reason_code FROM curated")
def curation_gate(spark: SparkSession, d: str) -> DataFrame:
    return _curated(spark, d).select("test_question_id", "duplicate_count", "curation_status", "priority", "reason_code")


@query(f"""WITH {_COVERAGE}, {_PREDICTED}, {_RULES} SELECT s AS curation_status, count(curation_status) AS total, coalesce(count(*) FILTER (WHERE stage = '初中'), 0) AS junior, coalesce(count(*) FILTER (WHERE stage = '高中'), 0) AS senior
FROM (VALUES ('USABLE_GOLD'), ('USABLE_WITH_REVIEW'), ('REVIEW_REQUIRED'), ('RE_CROP_REQUIRED')) AS d(s) LEFT JOIN curated ON curation_status = s GROUP BY s""")
def curation_summary(spark: SparkSession, d: str) -> DataFrame:
    counts = {"total": F.lit(True), "junior": F.col("stage") == "初中", "senior": F.col("stage") == "高中"}
    return G.zero_filled(_curated(spark, d), "curation_status", G.STATUSES, counts)


@query(f"""WITH {_COVERAGE}, {_PREDICTED}, {_RULES} SELECT CASE WHEN grouping(stage) = 0 THEN 'stage' WHEN grouping(grade) = 0 THEN 'grade' ELSE 'all' END AS group_name,
CASE WHEN grouping(stage) = 0 THEN coalesce(stage, 'None') WHEN grouping(grade) = 0 THEN coalesce(grade, 'None') ELSE 'all' END AS group_value, curation_status AS status, count(*) AS n
FROM curated GROUP BY GROUPING SETS ((curation_status), (stage, curation_status), (grade, curation_status))""")
def gold_groupings(spark: SparkSession, d: str) -> DataFrame:
    return G.grouped_summary(_curated(spark, d), "curation_status", ["stage", "grade"])


@query(f"WITH {_COVERAGE}, x AS (SELECT *, substr({_N('question_text_ocr')}, 1, 160) AS snippet FROM c) SELECT snippet, count(*) AS n FROM x WHERE snippet <> '' GROUP BY 1 HAVING count(*) > 1")
def duplicate_snippets(spark: SparkSession, d: str) -> DataFrame:
    return G.duplicate_counts(_coverage(spark, d), "question_text_ocr").filter("duplicate_count > 1").groupBy("snippet").agg(F.count("*").alias("n"))


@query(f"""WITH {_COVERAGE}, s AS (SELECT scope, count(*) AS total, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) - count(*) FILTER (WHERE status = 'ok') AS needs_crop, count(*) FILTER (WHERE selection_quality = 'strong_heading_match') AS strong, count(*) FILTER (WHERE selection_quality = 'nearby_question_match') AS nearby,
count(*) FILTER (WHERE selection_quality IN ('fallback_page_context', 'error') OR selection_quality IS NULL) AS fallback FROM c GROUP BY scope) SELECT * FROM s""")
def coverage_summary(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("selection_quality")
    return _coverage(spark, d).groupBy("scope").agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("ok"), (F.count("*") - F.count_if(F.col("status") == "ok")).alias("needs_crop"),
        F.count_if(q == "strong_heading_match").alias("strong"), F.count_if(q == "nearby_question_match").alias("nearby"), F.count_if(q.isin("fallback_page_context", "error") | q.isNull()).alias("fallback"),
    )


@query(f"""WITH {_COVERAGE}, k AS (SELECT *, row_number() OVER (ORDER BY md5('20260617' || test_question_id), test_question_id) AS i FROM c)
SELECT 'mkp_test_' || lpad(i::VARCHAR, greatest(4, len(i::VARCHAR))::INT, '0') AS blind_id, test_question_id AS original_test_question_id FROM k""")
def blind_id_map(spark: SparkSession, d: str) -> DataFrame:
    """Opaque ids in a seeded order, numbered over all rows without one task holding them."""
    return _numbered_coverage(spark, d).select(F.col("id").alias("blind_id"), F.col("test_question_id").alias("original_test_question_id"))


#: Terms that must not occur in what a model is given. Fixed values.
LEAK_TERMS = ("junior_g", "senior_g", "初一", "初二", "初三", "高一", "高二", "高三", "lesson_id", "knowledge_id", "source_pdf")
_BLIND = f"WITH {_COVERAGE}, k AS (SELECT *, 'mkp_test_' || lpad((row_number() OVER (ORDER BY md5('20260617' || test_question_id), test_question_id))::VARCHAR, 4, '0') AS id FROM c)"


def _numbered_coverage(spark: SparkSession, d: str) -> DataFrame:
    keyed = _coverage(spark, d).withColumn("shuffle", F.md5(F.concat(F.lit("20260617"), "test_question_id")))
    return numbered(keyed, ["shuffle", "test_question_id"]).withColumn("id", F.format_string("mkp_test_%04d", F.col("row_no")))


@query(_BLIND + " SELECT id AS test_question_id, '数学' AS subject, md5(coalesce(question_text_ocr, '')) AS text_md5, 'no stage grade lesson module knowledge source path labels in model input' AS leakage_policy FROM k")
def blind_rows(spark: SparkSession, d: str) -> DataFrame:
    """What a model is given: an opaque id and the text, no labels."""
    return _numbered_coverage(spark, d).select(F.col("id").alias("test_question_id"), F.lit("数学").alias("subject"), F.md5(F.coalesce("question_text_ocr", F.lit(""))).alias("text_md5"), F.lit("no stage grade lesson module knowledge source path labels in model input").alias("leakage_policy"))


_KEY_COLUMNS = ("scope", "stage", "grade", "lesson_id", "lesson_title", "module", "min_knowledge_point", "knowledge_id", "source_page", "selection_quality", "selection_reason", "status")


@query(_BLIND + f" SELECT id AS test_question_id, test_question_id AS original_test_question_id, {', '.join(_KEY_COLUMNS)} FROM k")
def answer_key(spark: SparkSession, d: str) -> DataFrame:
    """All labels by the opaque id, from the same numbering as the blind rows."""
    return _numbered_coverage(spark, d).select(F.col("id").alias("n"), *_KEY_COLUMNS, F.col("test_question_id").alias("original_test_question_id")).withColumnRenamed("n", "test_question_id")


@query("WITH b AS (SELECT concat_ws(' ', heldout_question_id, subject, text) AS x FROM heldout_blind), n(term) AS (VALUES " + ", ".join(f"('{t}')" for t in ("junior_g", "senior_g", "初一", "初二", "初三", "高一", "高二", "高三", "lesson_id", "knowledge_id", "source_pdf")) + ") SELECT term, (SELECT count(*) FROM b WHERE contains(x, term)) AS n_rows, contains('heldout_question_id subject text', term) AS in_names FROM n")
def leak_check(spark: SparkSession, d: str) -> DataFrame:
    """In how many blind rows each term occurs that would tell the answer, and whether a column's name holds it; all terms are counted in one scan."""
    rows = read(spark, d, "heldout_blind")
    return E.leaking_terms(rows, LEAK_TERMS)


#: Buckets of curation in a complete set, with the status they get. Fixed values.
COMPLETE = {"USABLE_GOLD": "COMPLETE_GOLD", "USABLE_WITH_REVIEW": "COMPLETE_WITH_REVIEW", "REVIEW_REQUIRED": "COMPLETE_REVIEW_REQUIRED", "REPLENISHED_GOLD": "COMPLETE_GOLD", "REPLENISHED_WITH_REVIEW": "COMPLETE_WITH_REVIEW", "REPLENISHED_REVIEW_REQUIRED": "COMPLETE_REVIEW_REQUIRED"}
_COMPLETE = f"""WITH {_COVERAGE}, {_PREDICTED}, {_RULES}, co AS (SELECT c.test_question_id, c.stage, c.grade, u.curation_status, CASE u.curation_status WHEN 'USABLE_GOLD' THEN 'COMPLETE_GOLD' WHEN 'USABLE_WITH_REVIEW' THEN 'COMPLETE_WITH_REVIEW' WHEN 'REVIEW_REQUIRED' THEN 'COMPLETE_REVIEW_REQUIRED' END AS complete_status, 'curated' AS source_bucket FROM curated u JOIN c USING (test_question_id) WHERE u.curation_status <> 'RE_CROP_REQUIRED'
UNION ALL SELECT c.test_question_id, c.stage, c.grade, 'REPLENISHED_REVIEW_REQUIRED', 'COMPLETE_REVIEW_REQUIRED', 'replenished' FROM curated u JOIN c USING (test_question_id) WHERE u.curation_status = 'RE_CROP_REQUIRED')"""


def _complete(spark: SparkSession, d: str) -> DataFrame:
    curated = _curated(spark, d).select("test_question_id", "stage", "grade", "curation_status")
    kept = curated.filter("curation_status <> 'RE_CROP_REQUIRED'").withColumn("source_bucket", F.lit("curated"))
    again = curated.filter("curation_status = 'RE_CROP_REQUIRED'").withColumns({"curation_status": F.lit("REPLENISHED_REVIEW_REQUIRED"), "source_bucket": F.lit("replenished")})
    return kept.unionByName(again).withColumn("complete_status", R.mapped("curation_status", COMPLETE))


@query(_COMPLETE + " SELECT test_question_id, complete_status, source_bucket FROM co")
def complete_gold(spark: SparkSession, d: str) -> DataFrame:
    """The complete set: the curated buckets and what was taken anew, under one set of statuses."""
    return _complete(spark, d).select("test_question_id", "complete_status", "source_bucket")


@query(_COMPLETE + """, s(v) AS (VALUES ('COMPLETE_GOLD'), ('COMPLETE_WITH_REVIEW'), ('COMPLETE_REVIEW_REQUIRED')) SELECT 'all' AS group_name, 'all' AS group_value, v AS status, count(test_question_id) AS n FROM s LEFT JOIN co ON complete_status = v GROUP BY v
UNION ALL SELECT 'stage', coalesce(stage, 'None'), complete_status, count(*) FROM co GROUP BY ALL UNION ALL SELECT 'grade', coalesce(grade, 'None'), complete_status, count(*) FROM co GROUP BY ALL""")
def complete_summary(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the complete set by status, of all (also where there are none), by stage and by grade."""
    return G.grouped_summary(_complete(spark, d), "complete_status", ["stage", "grade"], ("COMPLETE_GOLD", "COMPLETE_WITH_REVIEW", "COMPLETE_REVIEW_REQUIRED"))


@query(f"""WITH {_COVERAGE}, {_PREDICTED}, {_RULES}, s AS (SELECT 'clean' AS set_name, test_question_id FROM curated WHERE curation_status = 'USABLE_GOLD' UNION ALL SELECT 'expanded', test_question_id FROM curated WHERE curation_status IN ('USABLE_GOLD', 'USABLE_WITH_REVIEW')) SELECT set_name, test_question_id FROM s""")
def evaluation_sets(spark: SparkSession, d: str) -> DataFrame:
    """The clean set and the expanded one that holds it."""
    return G.nested_sets(_curated(spark, d).select("test_question_id", "curation_status"), "curation_status", {"clean": ("USABLE_GOLD",), "expanded": ("USABLE_GOLD", "USABLE_WITH_REVIEW")}).select("set_name", "test_question_id")


@query(f"""WITH {_COVERAGE}, {_PREDICTED}, i AS (SELECT *, CASE WHEN NOT predicted THEN 'missing_prediction' WHEN NOT lesson_hit THEN 'lesson_miss' WHEN NOT module_hit THEN 'module_miss' WHEN NOT point_hit THEN 'point_miss' WHEN NOT knowledge_hit THEN 'id_mismatch' END AS t FROM scored)
SELECT test_question_id, t AS issue_type, CASE WHEN t = 'missing_prediction' THEN knowledge_id END AS gold_knowledge_id, CASE WHEN t <> 'missing_prediction' THEN lesson_hit END AS lesson_hit, CASE WHEN t <> 'missing_prediction' THEN module_hit END AS module_hit FROM i WHERE t IS NOT NULL""")
def issue_rows(spark: SparkSession, d: str) -> DataFrame:
    """Issues of both kinds below each other: missing predictions with their gold column, misses with their flags."""
    found = E.issues(_scored(spark, d))
    missing = found.filter("issue_type = 'missing_prediction'").select("test_question_id", "issue_type", F.col("knowledge_id").alias("gold_knowledge_id"))
    misses = found.filter("issue_type <> 'missing_prediction'").select("test_question_id", "issue_type", "lesson_hit", "module_hit")
    return missing.unionByName(misses, allowMissingColumns=True)


@query("""SELECT 'junior' AS system, knowledge_id, lesson_id, level_2_module AS module FROM knowledge_points WHERE stage = '初中' UNION ALL SELECT 'senior', knowledge_id, lesson_id, level_2_module FROM knowledge_points WHERE stage = '高中'""")
def joint_catalog(spark: SparkSession, d: str) -> DataFrame:
    """The catalogs of both stages as one."""
    rows = read(spark, d, "knowledge_points", "knowledge_id", "lesson_id", "stage", F.col("level_2_module").alias("module"))
    part = lambda name, stage: rows.filter(F.col("stage") == stage).select(F.lit(name).alias("system"), "knowledge_id", "lesson_id", "module")
    return part("junior", "初中").unionByName(part("senior", "高中"))


@query("""WITH pg AS (SELECT doc_id, max(page) AS n FROM ocr_lines GROUP BY 1), k AS (SELECT knowledge_id, greatest(coalesce(nullif(source_page, 0), 1), 1) AS src, n FROM (SELECT knowledge_id, source_page, 'scan_' || lpad((coalesce(lesson_no, 0) + 1)::VARCHAR, 8, '0') AS doc_id FROM knowledge_points) JOIN pg USING (doc_id)),
p AS (SELECT knowledge_id, n, CASE WHEN src <= least(n, src + 8) THEN range(src, least(n, src + 8) + 1) ELSE [] END AS preferred, range(1, n + 1) AS every_page FROM k)
SELECT knowledge_id, len(preferred)::INT AS n_preferred, array_to_string(list_concat(preferred, list_filter(every_page, lambda x: NOT list_contains(preferred, x))), ',') AS candidates FROM p""")
def candidate_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages to try for each point: those from its source on first, then the rest of the document."""
    last = read(spark, d, "ocr_lines", "doc_id", "page").groupBy("doc_id").agg(F.max("page").alias("n"))
    source = F.greatest(F.coalesce(F.nullif("source_page", F.lit(0)), F.lit(1)), F.lit(1))
    pages = _points(spark, d).join(last, "doc_id").withColumn("preferred", G.pages_from(source, F.col("n")))
    return pages.select("knowledge_id", F.size("preferred").alias("n_preferred"), F.array_join(F.concat("preferred", F.array_except(F.sequence(F.lit(1), "n"), "preferred")), ",").alias("candidates"))


@query("""SELECT row_number() OVER (ORDER BY grade NULLS FIRST, season NULLS FIRST, lesson_no NULLS FIRST, source_pdf_path NULLS FIRST, lesson_id) AS place, lesson_id FROM (SELECT DISTINCT lesson_id, grade, season, lesson_no, source_pdf_path FROM knowledge_points)""")
def manifest_order(spark: SparkSession, d: str) -> DataFrame:
    """The manifest of sources in the order of grade, season, number and name."""
    rows = read(spark, d, "knowledge_points", "lesson_id", "grade", "season", "lesson_no", "source_pdf_path").distinct()
    return numbered(rows, ["grade", "season", "lesson_no", "source_pdf_path", "lesson_id"], "place").select("place", "lesson_id")


@query("""WITH l AS (SELECT DISTINCT lesson_id, title FROM lesson) SELECT 'lesson' AS table_name, row_number() OVER (ORDER BY lesson_id) AS place, lesson_id AS key, json_object('lesson_id', lesson_id, 'title', title)::VARCHAR AS row_json FROM l""")
def mirror_rows(spark: SparkSession, d: str) -> DataFrame:
    """The lessons as a mirror stores them: one JSON text a row, in the order of the key."""
    rows = read(spark, d, "lesson", "lesson_id", "title").distinct()
    return numbered(rows, ["lesson_id"], "place").select(F.lit("lesson").alias("table_name"), "place", F.col("lesson_id").alias("key"), F.to_json(F.struct("lesson_id", "title"), {"ignoreNullFields": "false"}).alias("row_json"))


@query("""WITH p AS (SELECT DISTINCT prediction_id, review_status, final_top3 FROM predictions), e AS (SELECT prediction_id, review_status, i, x.knowledge_id AS k, x.confidence AS c FROM (SELECT prediction_id, review_status, unnest(final_top3[1:3]) AS x, generate_subscripts(final_top3[1:3], 1) AS i FROM p))
SELECT prediction_id, i::INT AS rank, e.k AS knowledge_id, coalesce(kp.lesson_title, '') AS lesson_title, coalesce(kp.level_2_module, '') AS module, CASE WHEN i = 1 THEN coalesce(nullif(e.c, ''), 'medium') ELSE 'medium' END AS confidence, CASE WHEN i = 1 THEN 'first' ELSE 'alternative' END AS reason, coalesce(nullif(e.review_status, ''), 'needs_teacher_review') AS review_status
FROM e LEFT JOIN knowledge_points kp ON kp.knowledge_id = e.k WHERE e.k IS NOT NULL""")
def placement_records(spark: SparkSession, d: str) -> DataFrame:
    """The first three candidates of each prediction with their catalog labels, defaults where something is missing."""
    rows = read(spark, d, "predictions", "prediction_id", "review_status", "final_top3").distinct()
    catalog = read(spark, d, "knowledge_points", "knowledge_id", "lesson_title", F.col("level_2_module").alias("module"))
    return E.placements(rows, catalog)


_PAGES = "pages AS (SELECT doc_id, page, string_agg(text, chr(10) ORDER BY pos) AS body FROM (SELECT DISTINCT doc_id, page, pos, text FROM ocr_lines) GROUP BY ALL)"
_POINTS = "kp AS (SELECT knowledge_id, level_2_module, level_3_min_knowledge_point AS point, lesson_title, source_page, 'scan_' || lpad((coalesce(lesson_no, 0) + 1)::VARCHAR, 8, '0') AS doc_id FROM knowledge_points)"


def _pages(spark: SparkSession, d: str) -> DataFrame:
    lines = page_lines(read(spark, d, "ocr_lines", "doc_id", "page", "pos", "text"))
    return lines.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n").alias("body"))


def _points(spark: SparkSession, d: str) -> DataFrame:
    """Knowledge points, each with the document of its lesson number."""
    rows = read(spark, d, "knowledge_points", "knowledge_id", "level_2_module", F.col("level_3_min_knowledge_point").alias("point"), "lesson_title", "lesson_no", "source_page")
    return rows.withColumn("doc_id", F.format_string("scan_%08d", F.coalesce("lesson_no", F.lit(0)) + 1)).drop("lesson_no")


_TERMS = rf"""list_distinct_keep(list_filter(string_split_regex(trim(regexp_replace(concat_ws(' ', {_N("level_2_module")}, {_N("point")}, {_N("lesson_title")}), '[A-Za-z0-9\s=+\-*/^（）()，,。．.、:：;；【】\[\]{{}}<>|]+', ' ', 'g')), ' +'), lambda t: len(t) >= 2 AND t NOT IN ('考点', '模块', '课次', '主题', '应用', '问题')))"""
_KEEP = "list_filter({0}, lambda t, i: list_position({0}, t) = i)"
_RAW = _TERMS[len("list_distinct_keep(") : -1]


@query(rf"""WITH {_PAGES}, {_POINTS}, terms AS (SELECT *, ({_KEEP.format(_RAW)})[1:8] AS t FROM kp),
scored AS (SELECT knowledge_id, page, source_page, 8 * len(list_filter(t, lambda y: contains(body, y))) + (body LIKE '%例题%')::INT * 5 + (body LIKE '%强化训练%')::INT * 4 + regexp_matches(body, '\d+\s*[．.、]')::INT * 4 - least(abs(page - coalesce(nullif(source_page, 0), 1)), 8) AS score, len(list_filter(t, lambda y: contains(body, y))) AS n_hits,
  CASE WHEN page BETWEEN coalesce(nullif(source_page, 0), 1) AND coalesce(nullif(source_page, 0), 1) + 8 THEN 0 ELSE 1 END AS away FROM terms JOIN pages USING (doc_id))
SELECT knowledge_id, page::INT AS page, score::BIGINT AS score, CASE WHEN n_hits >= 2 THEN 'strong_heading_match' WHEN score >= 5 THEN 'nearby_question_match' ELSE 'fallback_page_context' END AS selection_quality
FROM scored QUALIFY row_number() OVER (PARTITION BY knowledge_id ORDER BY score DESC, away, page) = 1""")
def best_page(spark: SparkSession, d: str) -> DataFrame:
    """The page that fits each knowledge point best; pages near its source win ties."""
    points = _points(spark, d).withColumn("terms", T.useful_terms("level_2_module", "point", "lesson_title"))
    pairs = points.join(_pages(spark, d), "doc_id")
    source = F.coalesce(F.nullif("source_page", F.lit(0)), F.lit(1))
    scored = pairs.select("knowledge_id", "page", G.page_score(F.col("terms"), F.col("body"), F.col("page"), F.col("source_page")).alias("score"), F.size(F.filter("terms", lambda t: F.col("body").contains(t))).alias("n_hits"), F.when(F.col("page").between(source, source + 8), 0).otherwise(1).alias("away"))
    best = G.best_of(scored, ["knowledge_id"], F.col("score"), [F.col("away"), F.col("page")])
    quality = F.when(F.col("n_hits") >= 2, "strong_heading_match").when(F.col("score") >= 5, "nearby_question_match").otherwise("fallback_page_context")
    return best.select("knowledge_id", "page", "score", quality.alias("selection_quality"))


_SQ = lambda c: rf"regexp_replace(coalesce({c}, ''), '[\s\x{{3000}}\x{{a0}}]+', '', 'g')"


@query(rf"""WITH {_PAGES}, {_POINTS},
s AS (SELECT knowledge_id, page, body, ({_SQ("point")} <> '' AND contains({_SQ("body")}, {_SQ("point")}))::INT * 100 + (coalesce(point, '') <> '' AND regexp_matches(body, '考点\s*\d+\s*' || coalesce(point, '')))::INT * 120 + ({_SQ("level_2_module")} <> '' AND contains({_SQ("body")}, {_SQ("level_2_module")}))::INT * 35
  + (body LIKE '%考点%')::INT * 20 + regexp_matches(body, '(【\s*)?例\s*\d+')::INT * 45 + regexp_matches(body, '【答案】|【解答】|【分析】')::INT * 10 - (regexp_matches(body, '课程目标|知识导航') OR substr(body, 1, 260) LIKE '%知识导入%')::INT * 80 AS score FROM kp JOIN pages USING (doc_id) WHERE page > 1),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY knowledge_id ORDER BY score DESC, page) = 1),
m AS (SELECT *, CASE WHEN score >= 100 THEN 'exact_min_point_page' WHEN score >= 55 THEN 'module_or_nearby_page' WHEN score >= 25 THEN 'weak_nearby_page' ELSE 'fallback_first_content_page' END AS method FROM b)
SELECT knowledge_id, page::INT AS page, score::BIGINT AS score, method, CASE WHEN NOT (regexp_matches(body, '(【\s*)?例\s*\d+') OR regexp_matches(body, '{_CUE(R.SIGNAL_MARKS)}')) THEN 'REPLENISHED_REVIEW_REQUIRED' WHEN method = 'exact_min_point_page' THEN 'REPLENISHED_GOLD' WHEN method = 'module_or_nearby_page' THEN 'REPLENISHED_WITH_REVIEW' ELSE 'REPLENISHED_REVIEW_REQUIRED' END AS status FROM m""")
def replenished_page(spark: SparkSession, d: str) -> DataFrame:
    """The page from which a missing question is taken, how it was found, and whether that may be trusted."""
    pairs = _points(spark, d).join(_pages(spark, d).filter("page > 1"), "doc_id")
    scored = pairs.select("knowledge_id", "page", (R.question_signal("body") & (F.col("body") != "")).alias("signal"), G.heading_score(F.col("body"), F.col("point"), F.col("level_2_module")).alias("score"))
    best = G.best_of(scored, ["knowledge_id"], F.col("score"), [F.col("page")])  # no text goes into the aggregation
    return best.withColumn("method", G.page_method(F.col("score"))).select("knowledge_id", "page", "score", "method", G.replenish_status(F.col("method"), F.col("signal")).alias("status"))


@query("""WITH m AS (SELECT lesson_id, level_2_module AS module, level_3_min_knowledge_point AS point, min(knowledge_id) AS k FROM knowledge_points GROUP BY ALL), s AS (SELECT lesson_id, module, min(k) AS k FROM m GROUP BY ALL)
SELECT m.lesson_id, m.module, m.point, dense_rank() OVER (PARTITION BY m.lesson_id ORDER BY s.k) AS module_no, row_number() OVER (PARTITION BY m.lesson_id, m.module ORDER BY m.k) AS point_no FROM m JOIN s ON s.lesson_id = m.lesson_id AND s.module IS NOT DISTINCT FROM m.module""")
def knowledge_tree(spark: SparkSession, d: str) -> DataFrame:
    """The tree of lessons, modules and points, each once, in the order of first mention, flattened."""
    points = read(spark, d, "knowledge_points", "lesson_id", F.col("level_2_module").alias("module"), F.col("level_3_min_knowledge_point").alias("point"), "knowledge_id").groupBy("lesson_id", "module", "point").agg(F.min("knowledge_id").alias("k"))
    modules = points.groupBy("lesson_id", "module").agg(F.min("k").alias("m"), F.array_sort(F.collect_list(F.struct("k", "point"))).alias("points"))
    placed = nth(modules, ["lesson_id"], ["m"], "module_no")
    return placed.select("lesson_id", "module", "module_no", F.posexplode("points").alias("p", "x")).select("lesson_id", "module", F.col("x.point").alias("point"), "module_no", (F.col("p") + 1).cast("long").alias("point_no"))


@query("""SELECT lesson_id, row_number() OVER (ORDER BY CASE grade WHEN '七年级' THEN 1 WHEN '八年级' THEN 2 WHEN '九年级' THEN 3 WHEN '高一' THEN 4 WHEN '高二' THEN 5 WHEN '高三' THEN 6 ELSE 99 END, CASE WHEN coalesce(lesson_no, 0) = 0 THEN 999 ELSE lesson_no END, lesson_id) AS place
FROM (SELECT lesson_id, min(grade) AS grade, min(lesson_no) AS lesson_no FROM knowledge_points GROUP BY 1)""")
def catalog_order(spark: SparkSession, d: str) -> DataFrame:
    """Lessons in the order of grade and number; an unknown grade and a missing or zero number come last."""
    lessons = read(spark, d, "knowledge_points", "lesson_id", "grade", "lesson_no").groupBy("lesson_id").agg(F.min("grade").alias("grade"), F.min("lesson_no").alias("lesson_no"))
    rank = F.lit(99)
    for k, g in enumerate(("七年级", "八年级", "九年级", "高一", "高二", "高三"), 1):
        rank = F.when(F.col("grade") == g, k).otherwise(rank)
    keyed = lessons.select("lesson_id", rank.alias("r"), F.when(F.coalesce("lesson_no", F.lit(0)) == 0, 999).otherwise(F.col("lesson_no")).alias("n"))
    return numbered(keyed, ["r", "n", "lesson_id"], "place").select("lesson_id", "place")


@query(f"WITH {_COVERAGE}, k AS (SELECT test_question_id, floor((row_number() OVER (ORDER BY test_question_id) - 1) / 40)::BIGINT + 1 AS chunk_no FROM c) SELECT chunk_no, count(*) AS n_rows, min(test_question_id) AS first_id, max(test_question_id) AS last_id FROM k GROUP BY 1")
def chunk_manifest(spark: SparkSession, d: str) -> DataFrame:
    from slatemill.sources.sinks import chunked

    return chunked(_coverage(spark, d).select("test_question_id"), ["test_question_id"], 40).groupBy("chunk_no").agg(F.count("*").alias("n_rows"), F.min("test_question_id").alias("first_id"), F.max("test_question_id").alias("last_id"))


@query("""WITH o AS (SELECT DISTINCT knowledge_id, review_status FROM knowledge_points), c AS (SELECT DISTINCT * FROM coverage_set_review), j AS (SELECT c.test_question_id, o.review_status FROM c LEFT JOIN o USING (knowledge_id))
SELECT test_question_id, coalesce(review_status, 'unreviewed') AS manual_status, CASE WHEN review_status IN ('deleted', 'needs_review') THEN 'excluded' ELSE 'filtered' END AS pool FROM j""")
def overlay_pools(spark: SparkSession, d: str) -> DataFrame:
    """Questions with the manual status of their point, split into the pool kept and the one excluded."""
    overlay = read(spark, d, "knowledge_points", "knowledge_id", "review_status").distinct()
    joined = _coverage(spark, d).select("test_question_id", "knowledge_id").join(overlay, "knowledge_id", "left")
    return joined.select("test_question_id", F.coalesce("review_status", F.lit("unreviewed")).alias("manual_status"), F.when(F.col("review_status").isin("deleted", "needs_review"), "excluded").otherwise("filtered").alias("pool"))


@query(f"""WITH {_COVERAGE}, p AS (SELECT q, arg_max(struct_pack(x := review_status), struct_pack(file := file, pos := pos)).x AS review_status FROM (SELECT coalesce(test_question_id, question_id) AS q, file, pos, review_status FROM predictions) WHERE q IS NOT NULL GROUP BY q)
SELECT coalesce(c.test_question_id, p.q) AS question_key, CASE WHEN c.test_question_id IS NULL THEN 'only_prediction' WHEN p.q IS NULL THEN 'only_question' ELSE 'aligned' END AS alignment, p.review_status FROM c FULL OUTER JOIN p ON p.q = c.test_question_id""")
def question_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Questions and predictions aligned by key, with what is on one side only; of several predictions the last counts."""
    found = read(spark, d, "predictions", "test_question_id", "question_id", "file", "pos", "review_status").withColumn("q", F.coalesce("test_question_id", "question_id")).filter("q is not null").select("q", "file", "pos", "review_status")
    last = E.last_wins(found, ["q"], [F.col("file"), F.col("pos")]).select("q", "review_status")
    both = _coverage(spark, d).select("test_question_id").join(last, F.col("test_question_id") == F.col("q"), "full_outer")
    side = F.when(F.col("test_question_id").isNull(), "only_prediction").when(F.col("q").isNull(), "only_question").otherwise("aligned")
    return both.select(F.coalesce("test_question_id", "q").alias("question_key"), side.alias("alignment"), "review_status")
