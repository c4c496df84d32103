"""Queries that take questions, tables and aims out of lines and pages. The SQL spells its constants by itself."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.catalog_queries import _N, _PAGES, _POINTS, _RAW, _SQ, _points
from slatemill.functions import rules as R
from slatemill.functions import text as T
from slatemill.operators import extract as X
from slatemill.operators import gold as G
from slatemill.operators.ordered import page_lines
from slatemill.registry import query
from slatemill.sources.tables import read, spread

_DOC_LINES = "x AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)"
_START, _HEAD = r"^((例题|问题|变式|练习)\s*\d*|\d+\s*[．.、]|（\d+）|\(\d+\))", r"^【[^】]{2,20}】|^考点\s*\d+|^模块\s*\d+|^强化训练|^例题讲解|^知识梳理"


def _document_lines(spark: SparkSession, d: str) -> DataFrame:
    return spread(read(spark, d, "documents", "doc_id", "text")).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))


def _page_arrays(spark: SparkSession, d: str) -> DataFrame:
    """The lines of each page in order; a page is bounded, a document is not."""
    lines = page_lines(read(spark, d, "ocr_lines", "doc_id", "page", "pos", "text"))
    return lines.groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias("lines"))


@query(rf"""WITH pg AS (SELECT doc_id, page, list_filter(list_transform(list(text ORDER BY pos), lambda x: {_N("x")}), lambda x: x <> '') AS l FROM (SELECT DISTINCT doc_id, page, pos, text FROM ocr_lines) GROUP BY ALL), {_POINTS},
tm AS (SELECT doc_id, list_distinct(flatten(list(({_RAW})[1:8]))) AS t FROM kp GROUP BY 1), j AS (SELECT pg.*, coalesce(tm.t, []) AS t FROM pg LEFT JOIN tm USING (doc_id)),
i AS (SELECT *, list_filter(range(len(l)), lambda i: regexp_matches(l[i + 1], '{_START}')) AS q, list_filter(range(len(l)), lambda i: len(list_filter(t, lambda y: contains(l[i + 1], y))) > 0) AS h, list_filter(range(len(l)), lambda i: regexp_matches(l[i + 1], '{_START}') OR regexp_matches(l[i + 1], '{_HEAD}')) AS s FROM j),
b AS (SELECT *, coalesce(CASE WHEN len(h) > 0 THEN coalesce(list_min(list_filter(q, lambda i: i >= list_min(h))), list_sort(list_transform(q, lambda i: struct_pack(far := list_min(list_transform(h, lambda y: abs(i - y))), i := i)))[1].i) END, list_min(q), list_min(h), 0) AS b FROM i),
e AS (SELECT *, coalesce(list_min(list_filter(s, lambda i: i >= b + 2 AND i < least(len(l), b + 14))), least(len(l), b + 8)) AS e FROM b), o AS (SELECT *, array_to_string(l[b + 1:e], ' ') AS o FROM e)
SELECT doc_id, page, CASE WHEN len(l) = 0 THEN '' WHEN len(o) > 900 THEN rtrim(substr(o, 1, 900)) || '...' ELSE o END AS block, CASE WHEN len(l) = 0 THEN 'empty_page_text' WHEN len(q) > 0 THEN 'question_marker_near_heading' ELSE 'heading_context_fallback' END AS reason FROM o""")
def page_question_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The question of every scanned page that stands nearest to a term of its lesson's points."""
    points = _points(spark, d).select("doc_id", F.explode(T.useful_terms("level_2_module", "point", "lesson_title")).alias("t"))
    terms = points.groupBy("doc_id").agg(F.collect_set("t").alias("terms"))  # the catalog is a fixed table
    pages = _page_arrays(spark, d).join(terms, "doc_id", "left")
    return X.page_blocks(pages, ["doc_id", "page"], F.col("lines"), F.col("terms"))


@query(rf"""WITH {_DOC_LINES}, n AS (SELECT *, regexp_extract(text, '^\s*(\d{{1,3}})[．.]\s*', 1) AS no FROM x), h AS (SELECT *, no = '' AND regexp_matches(text, '^\s*[一二三四五六七八九十]+[．、].+') AS heading FROM n),
s AS (SELECT *, last_value(CASE WHEN heading THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS section FROM h), g AS (SELECT *, sum((no <> '')::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS q FROM s WHERE NOT heading),
m AS (SELECT *, CASE WHEN no <> '' THEN 'question' WHEN starts_with(text, '【分析】') THEN 'analysis' WHEN starts_with(text, '【解答】') THEN 'solution' WHEN starts_with(text, '【点评】') THEN 'comment' END AS mark FROM g WHERE q > 0), f AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id, q ORDER BY pos ROWS UNBOUNDED PRECEDING) AS part FROM m)
SELECT doc_id, min(CASE WHEN no <> '' THEN no::INT END) AS number, min(pos)::INT AS first_pos, {", ".join(f"coalesce(len(string_agg(CASE WHEN part = '{k}' THEN text END, chr(10) ORDER BY pos)), 0)::INT AS {k}_chars" for k in ("question", "analysis", "solution", "comment"))} FROM f GROUP BY doc_id, q""")
def answer_part_counts(spark: SparkSession, d: str) -> DataFrame:
    """Numbered questions of each document with the lengths of their parts."""
    return X.answer_parts(_document_lines(spark, d)).select("doc_id", "number", "first_pos", *[F.length(c).alias(f"{c}_chars") for c in ("question", "analysis", "solution", "comment")])


_BIND = rf"""{_DOC_LINES}, n AS (SELECT *, regexp_extract(text, '^\s*(\d{{1,3}})[．.]\s*', 1) AS no FROM x), q AS (SELECT doc_id, pos, no::INT AS number FROM n WHERE no <> '')"""


@query(rf"""WITH {_BIND}, d AS (SELECT doc_id, source FROM documents), s AS (SELECT q.doc_id, number, source FROM q JOIN d USING (doc_id)), a AS (SELECT source, number, max(doc_id) AS answer_doc FROM s WHERE doc_id % 2 = 1 GROUP BY ALL)
SELECT s.doc_id, s.number, count(*) AS n, a.answer_doc, CASE WHEN a.answer_doc IS NULL THEN 'MISSING_ANSWER' ELSE 'BOUND' END AS bind_status FROM s LEFT JOIN a ON a.source = s.source AND a.number = s.number WHERE s.doc_id % 2 = 0 GROUP BY ALL""")
def bound_answers(spark: SparkSession, d: str) -> DataFrame:
    """Questions of even documents bound to the answers of equal number in odd documents of one source; of several the last document counts."""
    lines = _document_lines(spark, d).withColumn("number", F.regexp_extract("text", r"^\s*(\d{1,3})[．.]\s*", 1)).filter("number <> ''").join(read(spark, d, "documents", "doc_id", "source"), "doc_id")
    lines = lines.select(F.col("source").alias("k"), "doc_id", F.col("number").cast("int").alias("number"))
    answers = lines.filter("doc_id % 2 = 1").select(F.col("k").alias("doc_id"), "number", F.col("doc_id").alias("analysis"), F.lit(None).alias("solution"), F.lit(None).alias("comment"), F.col("doc_id").alias("first_pos"))
    asked = lines.filter("doc_id % 2 = 0").select(F.col("k").alias("doc_id"), "number", F.lit(None).alias("section"), F.col("doc_id").alias("question"))
    return X.bind(asked, answers).groupBy(F.col("question").alias("doc_id"), "number", F.col("analysis").alias("answer_doc"), "bind_status").agg(F.count("*").alias("n"))


def _slice_sql(body: str, target: str, module: str) -> tuple[str, str, str]:
    """Window expressions of a question's slice: where it begins, what it is, and its stop."""
    found = lambda n: f"CASE WHEN coalesce({n}, '') = '' THEN NULL WHEN instr({body}, {n}) > 0 THEN instr({body}, {n}) WHEN instr(tight, {_SQ(n)}) > 0 THEN least(instr(tight, {_SQ(n)}), len({body})) END"
    at = "coalesce(" + ", ".join(found(n) for n in (target, module, "'【例'", "'例1'", "'例 1'", "'1．'", "'1.'")) + ", 1)"
    return f"substr({body}, greatest({at} - 80, 1)::BIGINT, 2600)", r"regexp_extract(substr(w, 221), '\n\s*考点\s*\d+')", "CASE WHEN mk <> '' THEN substr(w, 1, (instr(substr(w, 221), mk) + 219)::BIGINT) ELSE w END"


_W, _MK, _CUT = _slice_sql("body", "point", "level_2_module")
_SLICES = rf"""{_PAGES}, {_POINTS}, pr AS (SELECT *, {_SQ("body")} AS tight FROM kp JOIN pages USING (doc_id)), w AS (SELECT knowledge_id, page, {_W} AS w FROM pr), mk AS (SELECT *, {_MK} AS mk FROM w), sl AS (SELECT knowledge_id, page, {_N(_CUT)} AS slice FROM mk)"""


def _slices(spark: SparkSession, d: str) -> DataFrame:
    """The slice of every point on every page of its document."""
    pages = _page_arrays(spark, d).select("doc_id", "page", F.array_join("lines", "\n").alias("body"))
    return _points(spark, d).join(pages, "doc_id").select("knowledge_id", "page", "body", "point", "level_2_module", X.question_slice(F.col("body"), F.col("point"), F.col("level_2_module")).alias("slice"))


@query(rf"WITH {_SLICES} SELECT knowledge_id, page, md5(slice) AS slice_md5, len(slice)::INT AS n_chars FROM sl")
def question_slices(spark: SparkSession, d: str) -> DataFrame:
    """The text of the question for each point on each page of its document."""
    return _slices(spark, d).select("knowledge_id", "page", F.md5("slice").alias("slice_md5"), F.length("slice").alias("n_chars"))


_SIGNAL = r"(slice <> '' AND (regexp_matches(slice, '(【\s*)?例\s*\d+') OR regexp_matches(slice, '已知|求|下列|若|如图|选择|判断')))"


@query(rf"""WITH {_SLICES}, g AS (SELECT knowledge_id, page, {_SIGNAL} AS sig FROM sl),
s AS (SELECT knowledge_id, page, ({_SQ("point")} <> '' AND contains({_SQ("body")}, {_SQ("point")}))::INT * 100 + (coalesce(point, '') <> '' AND regexp_matches(body, '考点\s*\d+\s*' || coalesce(point, '')))::INT * 120 + ({_SQ("level_2_module")} <> '' AND contains({_SQ("body")}, {_SQ("level_2_module")}))::INT * 35
  + (body LIKE '%考点%')::INT * 20 + regexp_matches(body, '(【\s*)?例\s*\d+')::INT * 45 + regexp_matches(body, '【答案】|【解答】|【分析】')::INT * 10 - (regexp_matches(body, '课程目标|知识导航') OR substr(body, 1, 260) LIKE '%知识导入%')::INT * 80 AS score FROM pr WHERE page > 1),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY knowledge_id ORDER BY score DESC, page) = 1),
c AS (SELECT b.knowledge_id, b.page, CASE WHEN score >= 100 THEN 'exact_min_point_page' WHEN score >= 55 THEN 'module_or_nearby_page' WHEN score >= 25 THEN 'weak_nearby_page' ELSE 'fallback_first_content_page' END AS method, bool_or(sig AND g.page = b.page) AS here, min(CASE WHEN sig AND g.page IN (b.page + 1, b.page + 2) THEN g.page END) AS near, min(CASE WHEN sig AND g.page >= 2 THEN g.page END) AS any_page FROM b JOIN g USING (knowledge_id) GROUP BY ALL)
SELECT knowledge_id, (CASE WHEN here THEN page WHEN near IS NOT NULL THEN near WHEN method IN ('fallback_first_content_page', 'weak_nearby_page') THEN coalesce(any_page, page) ELSE page END)::INT AS page,
CASE WHEN here THEN method WHEN near IS NOT NULL THEN 'next_question_page_after_heading' WHEN method IN ('fallback_first_content_page', 'weak_nearby_page') AND any_page IS NOT NULL THEN 'first_question_page_fallback' ELSE method END AS method FROM c""")
def question_page_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Where a point's best page holds no question: the next page or the one after, else (for weak finds) the first page from the second on that does."""
    slices = _slices(spark, d)
    scored = slices.filter("page > 1").select("knowledge_id", "page", G.heading_score(F.col("body"), F.col("point"), F.col("level_2_module")).alias("score"))
    best = G.best_of(scored, ["knowledge_id"], F.col("score"), [F.col("page")])
    signals = slices.select("knowledge_id", F.col("page").alias("other"), (R.question_signal("slice") & (F.col("slice") != "")).alias("sig")).filter("sig")
    return G.fallback_page(best, signals).select("knowledge_id", "page", "method")


@query(rf"""WITH RECURSIVE {_DOC_LINES}, m AS (SELECT doc_id, coalesce(min(CASE WHEN text LIKE '%【变式%' THEN pos END), min(CASE WHEN text LIKE '%变式%' THEN pos END), min(CASE WHEN text LIKE '%【例%' THEN pos END), min(CASE WHEN text LIKE '%例%' THEN pos END), min(CASE WHEN regexp_matches(text, '^(例\s*)?\d+[．.]') AND text NOT LIKE '%课程目标%' AND text NOT LIKE '%理解%' AND len(text) > 5 THEN pos END)) AS s FROM x GROUP BY 1),
l AS (SELECT doc_id, s, list(text ORDER BY pos) AS l FROM x JOIN m USING (doc_id) WHERE pos BETWEEN s AND s + 29 GROUP BY ALL), b AS (SELECT doc_id, s, CASE WHEN regexp_matches(l[1], '例|变式') THEN l[2:] ELSE l END AS l FROM l),
f AS (SELECT doc_id, s, l, 0 AS i, false AS ended, '' AS kept FROM b UNION ALL SELECT doc_id, s, l, i + 1, e, CASE WHEN e OR regexp_matches(y, '课程目标|知识导航') THEN kept WHEN kept = '' THEN y ELSE kept || ' ' || y END FROM (SELECT *, l[i + 1] AS y, ended OR (kept <> '' AND regexp_matches(l[i + 1], '【例|【变式|^考点\s*\d+')) OR regexp_matches(l[i + 1], '【(答案|解析|分析|详解|解答)】') OR len(kept) > 420 AS e FROM f WHERE i < len(l))),
o AS (SELECT doc_id, s, substr({_N("kept")}, 1, 500) AS q FROM f WHERE i = len(l)) SELECT doc_id, s::INT AS pos, md5(q) AS question_md5 FROM o WHERE len(q) >= 10""")
def first_questions(spark: SparkSession, d: str) -> DataFrame:
    """The first question of each document: a variant, else an example, else a numbered one."""
    return X.first_questions(_document_lines(spark, d), ["doc_id"]).select("doc_id", "pos", F.md5("question").alias("question_md5"))


@query(rf"""WITH {_DOC_LINES}, a AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place FROM x WHERE regexp_matches(text, '^\d+[．.]')), b AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place FROM x WHERE regexp_matches(text, '^\d+[、．.]') AND len(text) > 8 AND doc_id NOT IN (SELECT doc_id FROM a))
SELECT doc_id, place::INT AS place, md5(text) AS text_md5 FROM a WHERE place <= 6 UNION ALL SELECT doc_id, place::INT, md5(text) FROM b WHERE place <= 5""")
def document_objectives(spark: SparkSession, d: str) -> DataFrame:
    """The first numbered aims of each document."""
    return X.objectives(_document_lines(spark, d)).select("doc_id", "place", F.md5("text").alias("text_md5"))


@query("""WITH k AS (SELECT lesson_id, knowledge_id, trim(level_2_module) AS module, trim(level_3_min_knowledge_point) AS point, trim(source_difficulty_star) AS star FROM knowledge_points), s AS (SELECT * FROM k WHERE regexp_matches(star, '^★+$') AND module <> '' AND point <> '')
SELECT lesson_id, row_number() OVER (PARTITION BY lesson_id ORDER BY knowledge_id) AS row_no, module, point, star AS difficulty FROM s""")
def navigation_tables(spark: SparkSession, d: str) -> DataFrame:
    """The catalog's tables as they are printed (a line for the module where it changes, one for the point, one of stars), read back into rows."""
    points = read(spark, d, "knowledge_points", "lesson_id", "knowledge_id", F.trim("level_2_module").alias("module"), F.trim("level_3_min_knowledge_point").alias("point"), F.trim("source_difficulty_star").alias("star")).filter(F.col("star").rlike("^★+$") & (F.col("module") != "") & (F.col("point") != ""))
    from pyspark.sql import Window

    w = Window.partitionBy("lesson_id").orderBy("knowledge_id")
    rows = points.withColumns({"n": F.row_number().over(w), "new": ~F.lag("module").over(w).eqNullSafe(F.col("module"))})
    parts = F.array_compact(F.array(F.when(F.col("new"), F.col("module")), F.col("point"), F.col("star")))
    lines = rows.select(F.col("lesson_id").alias("doc_id"), "n", F.posexplode(parts).alias("p", "text")).select("doc_id", (F.col("n") * 10 + F.col("p")).alias("pos"), "text")
    heads = points.select(F.col("lesson_id").alias("doc_id")).distinct().select("doc_id", F.explode(F.array(*[F.struct(F.lit(p).alias("pos"), F.lit(t).alias("text")) for p, t in ((0, "封面"), (1, "【知识导航】"), (2, "模块"), (3, "考点"), (4, "难度"))])).alias("x")).select("doc_id", "x.*")
    ends = heads.filter("pos = 0").select("doc_id", F.lit(10**6).alias("pos"), F.lit("1．已知").alias("text"))
    return X.navigation_rows(heads.unionByName(lines).unionByName(ends)).withColumnRenamed("doc_id", "lesson_id")


@query("""WITH g AS (SELECT split_id, lesson.learning_goals AS g FROM (SELECT DISTINCT split_id, lesson FROM lesson_split)), e AS (SELECT split_id, unnest(g[1:5]) AS goal, generate_subscripts(g[1:5], 1) AS place FROM g) SELECT split_id, place, place || '、能够' || coalesce(goal, '') || '接着' AS text FROM e""")
def learning_goals(spark: SparkSession, d: str) -> DataFrame:
    """Aims printed with a line that goes on with them and a numbered line after them, read back: at most five for each lesson."""
    goals = read(spark, d, "lesson_split", "split_id", "lesson").distinct().select(F.col("split_id").alias("doc_id"), F.posexplode("lesson.learning_goals").alias("p", "goal"))
    lines = goals.select("doc_id", F.explode(F.array(F.struct((F.col("p") * 2).alias("pos"), F.concat((F.col("p") + 1).cast("string"), F.lit("、能够"), F.coalesce("goal", F.lit(""))).alias("text")), F.struct((F.col("p") * 2 + 1).alias("pos"), F.lit("接着").alias("text")))).alias("x")).select("doc_id", "x.*")
    after = goals.select("doc_id", F.lit(10**6).alias("pos"), F.lit("9、其他").alias("text")).distinct()
    return X.goals(lines.unionByName(after)).select(F.col("doc_id").alias("split_id"), "place", "text")
