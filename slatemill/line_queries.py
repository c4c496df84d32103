"""Queries over lines, tasks and texts: sections, ranges, numbering, geometry, answer blocks, flags, signals."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.functions import previews as V
from slatemill.functions import rules as R
from slatemill.functions import text as T
from slatemill.operators import ordered as O
from slatemill.registry import query
from slatemill.sources.files import text_lines
from slatemill.sources.tables import read, spread

_SQL_NORM = r"trim(regexp_replace(coalesce({0}, ''), '[\s\x{{3000}}\x{{a0}}]+', ' ', 'g'), ' ')"
_WS = r"[\s\x{3000}\x{a0}]"
_SECTION = rf"regexp_matches(line, '{R.SECTION}') OR regexp_matches(line, '{R.NUMBERED_SECTION}')"
_LINES = rf"l AS (SELECT DISTINCT doc_id, page, pos, line_id, regexp_replace(regexp_replace(regexp_replace(text, '\x{{200b}}', '', 'g'), '^{_WS}+|{_WS}+$', '', 'g'), '[ \t]+', ' ', 'g') AS line FROM ocr_lines)"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    rows = O.page_lines(read(spark, d, "ocr_lines", "doc_id", "page", "pos", "line_id", "text"))
    return rows.select("doc_id", "page", "pos", "line_id", T.clean_line("text").alias("line"))


def _placed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines with page and position as one number, long from the start: from page 21,475 on it is beyond an int."""
    return _lines(spark, d).withColumn("place", F.col("page").cast("long") * 100000 + F.col("pos"))


@query(rf"WITH {_LINES} SELECT line_id, last_value(CASE WHEN {_SECTION} THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page, pos ROWS UNBOUNDED PRECEDING) AS section FROM l")
def section_of_line(spark: SparkSession, d: str) -> DataFrame:
    """The heading under which each line stands."""
    return O.forward_fill(_lines(spark, d), ["doc_id"], "page", ["pos"], F.when(R.is_section("line"), F.col("line")), "section").select("line_id", "section")


_PHASE = """CASE WHEN line LIKE '%课程目标%' THEN 'learning_objectives' WHEN line IN ('知识导入', '课程衔接') OR line LIKE '%差异性%' THEN 'intro_or_prerequisite' WHEN line LIKE '%思维导图%' THEN 'mind_map' WHEN line LIKE '%知识%' OR regexp_matches(line, '{0}') THEN 'knowledge_main' WHEN line LIKE '考点%' THEN 'exam_point' WHEN line LIKE '%小测%' THEN 'diagnostic_quiz' WHEN line LIKE '%例题%' THEN 'example_or_task'
WHEN regexp_matches(line, '强化|训练|练习') THEN 'student_practice' WHEN regexp_matches(line, '能力|进阶') THEN 'extension' WHEN regexp_matches(line, '回顾|总结|小结') THEN 'summary_or_transfer' ELSE 'knowledge_main' END""".format(R.NUMBERED_SECTION)


@query(rf"""WITH {_LINES}, s AS (SELECT *, page * 100000 + pos AS place FROM l WHERE {_SECTION}), e AS (SELECT doc_id, max(page * 100000 + pos) AS last FROM l GROUP BY 1)
SELECT s.line_id, s.doc_id, s.line AS title, {_PHASE} AS phase, s.place::BIGINT AS begin_place, coalesce(lead(s.place) OVER (PARTITION BY s.doc_id ORDER BY s.place) - 1, e.last)::BIGINT AS end_place FROM s JOIN e USING (doc_id)""")
def section_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Sections with their phase and the places (page and position as one number) where they begin and end."""
    lines = _placed_lines(spark, d)
    ends = lines.groupBy("doc_id").agg(F.max("place").alias("last"))
    starts = lines.filter(R.is_section("line")).join(ends, "doc_id")
    return O.next_start(starts, ["doc_id"], ["place"], F.col("place") - 1, F.col("last"), "end_place").select("line_id", "doc_id", F.col("line").alias("title"), R.phase("line").alias("phase"), F.col("place").alias("begin_place"), "end_place")


@query(rf"""WITH RECURSIVE {_LINES}, g AS (SELECT *, sum(({_SECTION})::INT) OVER (PARTITION BY doc_id ORDER BY page, pos ROWS UNBOUNDED PRECEDING) AS segment FROM l),
n AS (SELECT line_id, doc_id, segment, row_number() OVER (PARTITION BY doc_id, segment ORDER BY page, pos) AS i, regexp_extract(line, '{R.QUESTION_NUMBER}', 1)::INT AS no FROM g WHERE regexp_matches(line, '{R.QUESTION_NUMBER}')),
f AS (SELECT line_id, doc_id, segment, i, no, CASE WHEN no = 1 THEN 1 ELSE 0 END AS last, no = 1 AS kept FROM n WHERE i = 1
  UNION ALL SELECT n.line_id, n.doc_id, n.segment, n.i, n.no, CASE WHEN n.no = f.last + 1 THEN n.no ELSE f.last END, n.no = f.last + 1 FROM f JOIN n ON n.doc_id = f.doc_id AND n.segment = f.segment AND n.i = f.i + 1)
SELECT line_id, segment::BIGINT AS segment, no AS question_no FROM f WHERE kept""")
def question_starts(spark: SparkSession, d: str) -> DataFrame:
    """Numbered lines that begin a question: within a section, only numbers that go on from the last one accepted."""
    marked = O.segment_number(_lines(spark, d), ["doc_id"], "page", ["pos"], R.is_section("line"), "segment")
    numbers = marked.filter(F.col("line").rlike(R.QUESTION_NUMBER)).select("doc_id", "segment", "page", "pos", "line_id", F.regexp_extract("line", R.QUESTION_NUMBER, 1).cast("int").alias("question_no"))
    return O.counting(numbers, ["doc_id", "segment"], ["page", "pos"], "question_no").select("line_id", "segment", "question_no")


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
f AS (SELECT event_id, user_id, ts, i, ts AS last, true AS kept FROM e WHERE i = 1 UNION ALL SELECT e.event_id, e.user_id, e.ts, e.i, CASE WHEN e.ts - f.last >= INTERVAL 12 HOUR THEN e.ts ELSE f.last END, e.ts - f.last >= INTERVAL 12 HOUR FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
SELECT event_id, user_id FROM f WHERE kept""")
def gap_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Events of each user at least twelve hours after the last one kept."""
    import datetime

    gap = datetime.timedelta(hours=12)
    events = read(spark, d, "events", "event_id", "user_id", "ts")
    return O.fold(events, ["user_id"], ["ts", "event_id"], lambda: None, lambda last, r: (r["ts"], True) if last is None or r["ts"] - last >= gap else (last, False), ["ts"]).select("event_id", "user_id")


@query("""WITH r AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS k FROM orders GROUP BY ALL) SELECT event_id, r.k AS o_orderkey FROM (SELECT *, ts - INTERVAL 9500 DAY AS t FROM events) e ASOF LEFT JOIN r ON e.user_id = r.o_custkey AND e.t >= r.o_orderdate""")
def as_of_order(spark: SparkSession, d: str) -> DataFrame:
    """For each event the user's latest order at its time (event times are moved back to the years of the orders)."""
    events = read(spark, d, "events", "event_id", "user_id", "ts").select("event_id", F.col("user_id").alias("k"), (F.col("ts") - F.expr("INTERVAL 9500 DAY")).alias("t"))
    orders = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate").select(F.col("o_custkey").alias("k"), "o_orderdate", "o_orderkey")
    return O.as_of(events, orders, ["k"], "t", "o_orderdate", ["o_orderkey"]).select("event_id", "o_orderkey")


@query("""WITH l AS (SELECT DISTINCT * FROM ocr_lines) SELECT a.line_id AS line_id, b.line_id AS below_id FROM l a JOIN l b ON a.doc_id = b.doc_id AND a.page = b.page AND a.line_id <> b.line_id AND b.y0 > a.y0 AND b.y0 - a.y0 < 40 AND b.x0 <= a.x1 AND b.x1 >= a.x0""")
def lines_below(spark: SparkSession, d: str) -> DataFrame:
    """Lines that begin less than 40 below another of their page and overlap it sideways, by buckets of height."""
    rows = read(spark, d, "ocr_lines", "line_id", "doc_id", "page", "x0", "x1", "y0").distinct()
    spans = rows.select("doc_id", "page", F.col("line_id").alias("upper"), F.col("x0").alias("ux0"), F.col("x1").alias("ux1"), F.col("y0").alias("from_y"), (F.col("y0") + 40).alias("to_y"))
    pairs = O.containing(rows, spans, ["doc_id", "page"], "y0", "from_y", "to_y", 40.0, ["upper", "ux0", "ux1"])
    return pairs.filter("line_id <> upper and y0 > from_y and y0 < to_y and x0 <= ux1 and x1 >= ux0").select(F.col("upper").alias("line_id"), F.col("line_id").alias("below_id"))


@query("SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE score >= 0.45) AS n_sure, count(*) FILTER (WHERE score IS NULL) AS n_unscored, max(page) AS n_pages FROM (SELECT DISTINCT * FROM ocr_lines) GROUP BY 1")
def scan_quality(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "ocr_lines", "line_id", "doc_id", "page", "score").distinct()
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(F.col("score") >= 0.45).alias("n_sure"), F.count_if(F.col("score").isNull()).alias("n_unscored"), F.max("page").alias("n_pages"))


@query(rf"""WITH x AS (SELECT doc_id, unnest(string_split_regex(text, '\r?\n')) AS raw, generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS line_no FROM documents),
y AS (SELECT doc_id, line_no::INT AS line_no, regexp_replace(regexp_replace(regexp_replace(raw, '\x{{200b}}', '', 'g'), '^{_WS}+|{_WS}+$', '', 'g'), '[ \t]+', ' ', 'g') AS line FROM x) SELECT doc_id, line_no, line FROM y WHERE line <> '' AND NOT regexp_matches(line, '^\d{{1,3}}$')""")
def document_lines(spark: SparkSession, d: str) -> DataFrame:
    return text_lines(spread(read(spark, d, "documents", "doc_id", "text")), ["doc_id"], "text")


_MARKS = ", ".join(f"('{m}')" for m in T.ANSWER_MARKERS)


@query(rf"""WITH p AS (SELECT doc_id, text, list_sort(list_filter([{", ".join(f"struct_pack(at := instr(text, '{m}'), m := '{m}')" for m in T.ANSWER_MARKERS)}], lambda s: s.at > 0)) AS f FROM documents),
s AS (SELECT doc_id, regexp_replace(CASE WHEN len(f) > 0 THEN substr(text, 1, f[1].at - 1) ELSE text END, '^{_WS}+|{_WS}+$', '', 'g') AS stem, f, text FROM p),
b AS (SELECT doc_id, stem, list_transform(f, lambda y, i: struct_pack(m := y.m, body := regexp_replace(substr(text, y.at + len(y.m), (CASE WHEN i < len(f) THEN f[i + 1].at ELSE len(text) + 1 END - y.at - len(y.m))::BIGINT), '^{_WS}+|{_WS}+$', '', 'g'))) AS blocks FROM s)
SELECT doc_id, md5(stem) AS stem_md5, coalesce(list_filter(blocks, lambda y: y.m = '【答案】')[1].body, '') AS answer, coalesce(array_to_string(list_transform(list_filter(blocks, lambda y: y.m <> '【答案】' AND y.body <> ''), lambda y: y.body), chr(10)), '') AS explanation, len(blocks) AS n_markers FROM b""")
def answer_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Stem, answer and explanation of each document by the first occurrence of each answer marker."""
    rows = spread(read(spark, d, "documents", "doc_id", "text")).select("doc_id", T.answer_blocks("text").alias("b"))
    return rows.select("doc_id", F.md5("b.stem").alias("stem_md5"), F.col("b.answer").alias("answer"), F.col("b.explanation").alias("explanation"), F.size("b.markers").cast("long").alias("n_markers"))


@query("""WITH s AS (SELECT doc_id, unnest(regexp_extract_all(text, '【答案】|【解析】|【分析】|【详解】|【解答】|【解题思路】|【解答过程】|【点评】')) AS marker FROM documents) SELECT marker, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM s GROUP BY 1""")
def answer_layers(spark: SparkSession, d: str) -> DataFrame:
    """How often each marker of an answer layer occurs, over every occurrence."""
    layers = spread(read(spark, d, "documents", "doc_id", "text")).select("doc_id", F.explode(T.answer_layers("text")).alias("x"))
    return layers.groupBy(F.col("x.marker").alias("marker")).agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"))


_BODY = "concat_ws(chr(10), stem, answer, explanation)"


@query(rf"""WITH t AS (SELECT DISTINCT task_id, stem, answer, explanation FROM task), x AS (SELECT task_id, {_BODY} AS b, answer, explanation FROM t)
SELECT task_id, array_to_string(list_sort(list_filter([CASE WHEN regexp_matches(b, '[\x{{e000}}-\x{{f8ff}}]') THEN 'formula_text_layer' END, CASE WHEN regexp_matches(b, '如图|图中|下图|表格|曲线|坐标系|遗传图解') THEN 'visual_or_table_asset' END, CASE WHEN regexp_matches(b, '证明|求证|实验设计|推理|探究') THEN 'reasoning_or_proof' END, CASE WHEN regexp_matches(b, '{"|".join(T.ANSWER_MARKERS)}') THEN 'teacher_answer_layer' END], lambda y: y IS NOT NULL)), ',') AS flags,
array_to_string(list_sort(list_filter([CASE WHEN regexp_matches(b, '[\x{{e000}}-\x{{f8ff}}]|√|≤|≥|[a-zA-Z]\s*[²³]') THEN 'formula_normalization' END, CASE WHEN regexp_matches(b, '如图|图中|作图|几何|三角形|圆') THEN 'visual_asset_required' END, CASE WHEN regexp_matches(b, '求证|证明') THEN 'proof_item' END, CASE WHEN regexp_matches(b, '【答案】|【解析】|【详解】') THEN 'answer_layer' END], lambda y: y IS NOT NULL)), ',') AS pair_flags,
CASE WHEN {_SQL_NORM.format("answer")} <> '' THEN 'explicit_answer' WHEN {_SQL_NORM.format("explanation")} <> '' THEN 'solution_only' ELSE 'missing_or_unrecognized' END AS answer_status FROM x""")
def task_flags(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "task", "task_id", "stem", "answer", "explanation").dropDuplicates(["task_id"]).withColumn("b", F.concat_ws("\n", "stem", "answer", "explanation"))
    return rows.select("task_id", F.array_join(R.risk_flags("b"), ",").alias("flags"), F.array_join(R.pair_risk_flags("b"), ",").alias("pair_flags"), R.answer_status("answer", "explanation").alias("answer_status"))


_KEY = r"regexp_extract(task_id, ':s(\d+)_q(\d+)$', {0})::INT"


@query(rf"""WITH t AS (SELECT DISTINCT task_id, stem, answer FROM task), k AS (SELECT *, {_KEY.format(1)} AS s, {_KEY.format(2)} AS q, coalesce(stem, '') AS x FROM t),
r AS (SELECT task_id, s, q, CASE WHEN regexp_matches(x, '参数|恒成立|综合|求证|证明') THEN 'advanced' WHEN s >= 3 OR regexp_matches(x, '函数|最大值|最小值|配凑|消元|整体|若') THEN 'standard' WHEN s = 1 AND q <= 4 THEN 'basic' ELSE 'standard' END AS difficulty FROM k)
SELECT task_id, regexp_extract(task_id, '^(.*?):task:', 1) AS lesson_id, difficulty, row_number() OVER (PARTITION BY regexp_extract(task_id, '^(.*?):task:', 1) ORDER BY s, q, task_id) AS place FROM r""")
def task_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Difficulty by ordered rules, and each task's place in its lesson by section and question as numbers."""
    part = lambda k: F.regexp_extract("task_id", r":s(\d+)_q(\d+)$", k).cast("int")
    rows = read(spark, d, "task", "task_id", "stem").distinct().select("task_id", F.regexp_extract("task_id", "^(.*?):task:", 1).alias("lesson_id"), part(1).alias("s"), part(2).alias("q"), "stem")
    return O.nth(rows.withColumn("difficulty", R.tier("s", "q", "stem")["difficulty"]), ["lesson_id"], ["s", "q", "task_id"], "place").select("task_id", "lesson_id", "difficulty", "place")


_SQL_STATS = ", ".join(f"len(regexp_extract_all(x, '{p}'))::BIGINT AS {k}" for k, p in V.PATTERNS.items())


@query(rf"""WITH q AS (SELECT DISTINCT question_id, {_SQL_NORM.format("text_preview")} AS x, text_preview_source AS s FROM split_questions), c AS (SELECT *, len(x) AS length, {_SQL_STATS} FROM q)
SELECT question_id, cjk AS n_cjk, latin AS n_latin, digit AS n_digit, pua AS n_pua, math AS n_math, option AS n_option,
(least(length, 140) + 3 * cjk - 80 * noise - 120 * pua - 2 * greatest(math - 18, 0) + regexp_matches(x, '{V.LEAD}')::INT * 24 + regexp_matches(x, '{V.CUES}')::INT * 20 + CASE s WHEN 'pdf_text_layer' THEN 6 WHEN 'ocr_fallback' THEN 4 ELSE 0 END)::BIGINT AS preview_score,
length < 10 OR noise >= 1 OR pua >= 1 OR (cjk <= 8 AND length >= 24) OR (length >= 32 AND length - cjk - latin - digit > 0.24 * length AND cjk < 20) OR (length >= 48 AND math >= 7 AND cjk < 48) OR (option >= 3 AND math >= 6 AND cjk < 48) OR (option >= 2 AND math >= 4 AND cjk < 56) AS noisy,
noise = 0 AND pua = 0 AND ((length >= 20 AND cjk >= 8) OR (coalesce(s, '') = 'ocr_fallback' AND length >= 18 AND cjk >= 6)) AND (regexp_matches(x, '{V.LEAD}') OR regexp_matches(x, '{V.CUES}') OR regexp_matches(x, 'A[．.]|（\s*.*\s*）')) AS readable FROM c""")
def preview_signals(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "split_questions", "question_id", "text_preview", "text_preview_source").distinct()
    counts = [c.alias(f"n_{k}") for k, c in V.stats("text_preview").items() if k not in ("length", "noise")]
    source = F.coalesce("text_preview_source", F.lit(""))
    return rows.select("question_id", *counts, V.score("text_preview", "text_preview_source").alias("preview_score"), V.noisy("text_preview").alias("noisy"), V.readable("text_preview", source).alias("readable"))


@query("""WITH q AS (SELECT DISTINCT question_id, local_number AS n, fragments AS f, visual_pages AS p, checkpoint AS c, component_label AS l, component_kind AS k, coalesce(text_preview, '') AS t FROM split_questions),
h AS (SELECT *, list_max(list_transform(list_filter(f, lambda x: x IS NOT NULL), lambda x: x.bbox_image[4] - x.bbox_image[2])) AS height, list_transform(f, lambda x: x.page) AS o FROM q),
i AS (SELECT question_id, k, list_sort(list_filter([CASE WHEN coalesce(n, 0) <= 0 THEN 'no_clear_question_number' END, CASE WHEN coalesce(len(f), 0) = 0 THEN 'no_visual_fragment' END, CASE WHEN height < 120 THEN 'crop_too_short' END, CASE WHEN coalesce(len(p), 0) > 2 THEN 'spans_more_than_two_pages' END,
  CASE WHEN coalesce(len(f), 0) > 1 AND o <> list_sort(o) THEN 'fragment_pages_out_of_order' END, CASE WHEN coalesce(c, '') <> '' AND c = l THEN 'checkpoint_component_same_name_check_needed' END, CASE WHEN regexp_matches(substr(t, 1, 30), '知识|要点') THEN 'possible_non_question_block' END], lambda x: x IS NOT NULL)) AS s FROM h),
a AS (SELECT *, CASE WHEN len(s) = 0 THEN 'PASS_BY_VISUAL_GATE' WHEN s = ['too_much_whitespace'] THEN 'PASS_WITH_LAYOUT_CLEANUP' ELSE 'NEEDS_MODEL_OR_HUMAN_REVIEW' END AS audit_status FROM i)
SELECT question_id, array_to_string(s, ',') AS issues, audit_status, CASE WHEN audit_status = 'NEEDS_MODEL_OR_HUMAN_REVIEW' THEN '高' WHEN k = 'advanced' THEN '中' ELSE '低' END AS risk FROM a""")
def question_audit(spark: SparkSession, d: str) -> DataFrame:
    """The audit of cut-out questions by what the table holds; pixel statistics, which it lacks, trigger nothing."""
    return _audited(spark, d).select("question_id", "issues", "audit_status", "risk")


def _audited(spark: SparkSession, d: str) -> DataFrame:
    """Questions with their audit."""
    rows = read(spark, d, "split_questions", "question_id", "group_id", "local_number", "fragments", "visual_pages", "checkpoint", "component_label", "component_kind", "text_preview", "text_preview_source", "review_status").distinct()
    height = F.array_max(F.transform(F.filter("fragments", lambda f: f.isNotNull()), lambda f: F.try_element_at(f["bbox_image"], F.lit(4)) - F.try_element_at(f["bbox_image"], F.lit(2))))
    none = F.lit(None).cast("double")
    issues = R.crop_issues("local_number", "fragments", "visual_pages", height, none, none, none, "checkpoint", "component_label", "text_preview")
    rows = rows.withColumn("i", issues).withColumn("audit_status", R.crop_status("i"))
    return rows.withColumns({"issues": F.array_join("i", ","), "risk": R.review_risk("audit_status", "component_kind")}).drop("i")


def _tagged_questions(spark: SparkSession, d: str) -> DataFrame:
    """Audited questions with their version tags."""
    placed = O.first_or_later(_audited(spark, d), "checkpoint", "question_id", "nth")  # tags ask for the first place only
    return placed.withColumn("tags", R.version_tags("component_kind", "nth", F.coalesce(F.length("text_preview"), F.lit(0))))


@query("""WITH q AS (SELECT DISTINCT question_id, checkpoint, component_kind AS k, coalesce(len(text_preview), 0) AS n FROM split_questions), r AS (SELECT *, row_number() OVER (PARTITION BY checkpoint ORDER BY question_id) AS nth FROM q),
t AS (SELECT question_id, unnest(list_distinct(list_filter(['常用版', CASE WHEN k = 'example' OR (k = 'practice' AND nth <= 1) OR k = 'after_class' THEN '基础版' END, CASE WHEN (k = 'example' AND nth >= 2 AND n > 120) OR (k = 'practice' AND (nth >= 2 OR n > 150)) OR k = 'advanced' THEN '进阶版' END], lambda y: y IS NOT NULL))) AS tag FROM r)
SELECT v AS version_tag, count(tag) AS n FROM (VALUES ('常用版'), ('基础版'), ('进阶版')) AS d(v) LEFT JOIN t ON tag = v GROUP BY v""")
def version_counts(spark: SparkSession, d: str) -> DataFrame:
    """Questions of each version, 0 for a version without any."""
    rows = read(spark, d, "split_questions", "question_id", "checkpoint", "component_kind", "text_preview").distinct()
    placed = O.first_or_later(rows, "checkpoint", "question_id", "nth")  # tags ask for the first place only
    tags = placed.select(F.explode(R.version_tags("component_kind", "nth", F.coalesce(F.length("text_preview"), F.lit(0)))).alias("version_tag")).groupBy("version_tag").agg(F.count("*").alias("n"))
    dim = spark.createDataFrame([("常用版",), ("基础版",), ("进阶版",)], "version_tag string")
    return dim.join(tags, "version_tag", "left").fillna(0, ["n"])


@query("""WITH q AS (SELECT DISTINCT question_id, unnest(visual_pages) AS p FROM split_questions), f AS (SELECT DISTINCT question_id, u.x.page AS p FROM split_questions, unnest(fragments) AS u(x)) SELECT question_id, array_to_string(list_sort(list(DISTINCT p)), ',') AS pages, count(DISTINCT p) AS n_pages FROM (SELECT * FROM q UNION ALL SELECT * FROM f) WHERE p IS NOT NULL GROUP BY 1""")
def question_pages(spark: SparkSession, d: str) -> DataFrame:
    """All pages of each question, from its list and its fragments, each once and sorted."""
    rows = read(spark, d, "split_questions", "question_id", "visual_pages", "fragments")
    pages = rows.select("question_id", F.explode(F.array_union(F.coalesce("visual_pages", F.array().cast("array<int>")), F.coalesce(F.transform("fragments", lambda x: x["page"]), F.array().cast("array<int>")))).alias("p")).filter("p is not null")
    return pages.groupBy("question_id").agg(F.array_join(F.array_sort(F.collect_set("p")), ",").alias("pages"), F.count_distinct("p").alias("n_pages"))


_PARTS = "sg AS (SELECT DISTINCT question_id, group_id, CASE WHEN local_number % 7 = 0 THEN 'checkpoint' ELSE component_kind END AS kind, CASE WHEN local_number % 2 = 1 THEN component_label || '（续）' ELSE component_label END AS label FROM split_questions)"


@query(f"""WITH {_PARTS}, b AS (SELECT *, replace(label, '（续）', '') AS base, contains(label, '（续）') AS cont, row_number() OVER (PARTITION BY group_id ORDER BY question_id) AS i FROM sg),
n AS (SELECT b.*, CASE WHEN b.kind = 'checkpoint' THEN 0 WHEN b.cont AND p.kind <> 'checkpoint' AND p.kind = b.kind AND p.base = b.base THEN 0 ELSE 1 END AS new FROM b LEFT JOIN b p ON p.group_id = b.group_id AND p.i = b.i - 1), c AS (SELECT *, sum(new) OVER (PARTITION BY group_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run_no FROM n)
SELECT question_id, run_no::BIGINT AS run_no FROM c WHERE kind <> 'checkpoint'""")
def component_runs(spark: SparkSession, d: str) -> DataFrame:
    """Groups of parts: a part that continues the one before it of its kind and label joins it, all others begin a group, a checkpoint closes one."""
    number = F.col("local_number")
    rows = read(spark, d, "split_questions", "question_id", "group_id", "component_kind", "component_label", "local_number").distinct()
    parts = rows.select("question_id", "group_id", F.when(number % 7 == 0, "checkpoint").otherwise(F.col("component_kind")).alias("kind"), F.when(number % 2 == 1, F.concat("component_label", F.lit("（续）"))).otherwise(F.col("component_label")).alias("label"))
    return O.groups_of_parts(parts, ["group_id"], ["question_id"], "kind", "label", ("example", "practice", "advanced", "after_class"), "run_no").select("question_id", "run_no")


@query(rf"""WITH {_LINES}, p AS (SELECT *, page * 100000 + pos AS place FROM l), e AS (SELECT doc_id, max(place) AS last FROM p GROUP BY 1), s AS (SELECT p.line_id AS section_id, p.doc_id, place AS begin_place, coalesce(lead(place) OVER (PARTITION BY p.doc_id ORDER BY place) - 1, last) AS end_place FROM p JOIN e USING (doc_id) WHERE {_SECTION}),
q AS (SELECT line_id, doc_id, place, lead(place) OVER (PARTITION BY doc_id ORDER BY place) - 1 AS next FROM p WHERE regexp_matches(line, '^(\d{{1,3}})[．.、]\s*(.+)')), h AS (SELECT q.*, section_id, end_place FROM q JOIN s ON s.doc_id = q.doc_id AND place BETWEEN begin_place AND end_place QUALIFY row_number() OVER (PARTITION BY q.line_id ORDER BY begin_place) = 1)
SELECT line_id, section_id, least(coalesce(next, end_place), end_place)::BIGINT AS end_place FROM h""")
def question_ends(spark: SparkSession, d: str) -> DataFrame:
    """The first section that holds each numbered line, and where its question ends: before the next one, but not beyond the section."""
    lines = _placed_lines(spark, d)
    last = lines.groupBy("doc_id").agg(F.max("place").alias("last"))
    sections = O.next_start(lines.filter(R.is_section("line")).join(last, "doc_id"), ["doc_id"], ["place"], F.col("place") - 1, F.col("last"), "section_end").select("doc_id", F.col("place").alias("section_begin"), "section_end", F.col("line_id").alias("section_id"))
    starts = O.next_start(lines.filter(F.col("line").rlike(R.QUESTION_NUMBER)), ["doc_id"], ["place"], F.col("place") - 1, F.lit(None), "next")
    held = O.first_parent(starts, sections, ["doc_id"], "place", "section_begin", "section_end", "section_id", "line_id", 100000)
    joined = starts.join(held, "line_id").join(sections.select("section_id", "section_end"), "section_id")
    return joined.select("line_id", "section_id", O.clipped_end(F.col("next"), F.col("section_end")).alias("end_place"))
