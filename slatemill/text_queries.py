"""Queries over scalar text functions, JSON in texts and hashes of rows. The SQL spells its patterns by itself."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.catalog_queries import _N
from slatemill.functions import jsontext as J
from slatemill.functions import previews as V
from slatemill.functions import rules as R
from slatemill.functions import text as T
from slatemill.line_queries import _SQL_STATS
from slatemill.operators import ordered as O
from slatemill.registry import SQL, query
from slatemill.sources.tables import read, spread

_TRIM = lambda c: rf"regexp_replace({c}, '^[\s\x{{3000}}\x{{a0}}]+|[\s\x{{3000}}\x{{a0}}]+$', '', 'g')"
_GLYPHS = "＋－＝"
_SIGNS = "()+-<=>∵∴≤≥≤∞±≥≠∈·[((([{])))]}+-="
_SYMBOLS = lambda c: rf"trim(regexp_replace(regexp_replace(regexp_replace(translate({c}, '{_GLYPHS}', '{_SIGNS}'), '[\x{{f000}}-\x{{f8ff}}]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ')"


@query(rf"""WITH t AS (SELECT DISTINCT task_id, stem, answer FROM task WHERE stem IS NOT NULL)
SELECT task_id, md5({_SYMBOLS("stem")}) AS symbols_md5, md5(regexp_replace({_SYMBOLS("stem")}, '^[0-9]{{1,2}}[．.、]\s*', '')) AS numberless_md5, CASE WHEN len(stem) > 40 THEN rtrim(substr(stem, 1, 40)) || '...' ELSE stem END AS clipped,
CASE WHEN (regexp_matches(stem, '（ +）') OR regexp_matches(stem, '(^|[^A-Za-z0-9_])A[．.]')) AND regexp_extract({_N("answer")}, '^([A-D])([^A-Za-z0-9_]|$)', 1) <> '' THEN regexp_extract({_N("answer")}, '^([A-D])([^A-Za-z0-9_]|$)', 1) ELSE trim(answer, ' ') END AS normal_answer,
replace(replace(replace(replace(stem, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS escaped, 'data:text/plain;base64,' || to_base64(encode(stem)) AS url, split_part(regexp_extract(task_id, '[^:]*$'), '_', 1)[2:] AS section FROM t""")
def task_texts(spark: SparkSession, d: str) -> DataFrame:
    """Stems with plain signs, without their number, clipped, escaped, as data URL; answers normalized; the section of the key."""
    rows = read(spark, d, "task", "task_id", "stem", "answer").filter("stem is not null").distinct()
    return rows.select(
        "task_id", F.md5(T.symbols("stem")).alias("symbols_md5"), F.md5(T.without_number("stem")).alias("numberless_md5"), T.clip("stem", 40).alias("clipped"), T.normalize_answer("answer", "stem").alias("normal_answer"),
        T.escape_markup("stem").alias("escaped"), T.data_url(F.encode("stem", "UTF-8"), "text/plain").alias("url"), T.section_of_key(F.regexp_extract("task_id", "[^:]*$", 0)).alias("section"),
    )


@query(rf"""WITH q AS (SELECT DISTINCT question_id, checkpoint, component_label || CASE WHEN local_number % 2 = 0 THEN '（续）' ELSE '' END AS label, local_number AS n FROM split_questions)
SELECT question_id, regexp_replace(trim(checkpoint, ' '), '^考点\s*\d+\s*[:：]?\s*', '') AS name, trim(replace(label, '（续）', ''), ' ') AS base, format('{{:.1f}}%', 100 * n / 32.0) AS share,
coalesce(nullif(substr(regexp_replace(regexp_replace(lower(trim(coalesce(checkpoint, ''), ' ')), '[^\p{{L}}\p{{N}}]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 8), ''), 'node') AS short_slug, coalesce(nullif(substr(regexp_replace(regexp_replace(coalesce(checkpoint, ''), '[<>:"/\\|?*\s]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 80), ''), 'item') AS file_name FROM q""")
def question_labels(spark: SparkSession, d: str) -> DataFrame:
    """Names of checkpoints and labels, shares, slugs and file names."""
    rows = read(spark, d, "split_questions", "question_id", "checkpoint", "component_label", "local_number").distinct()
    label = F.concat("component_label", F.when(F.col("local_number") % 2 == 0, "（续）").otherwise(""))
    return rows.select("question_id", T.checkpoint_name("checkpoint").alias("name"), T.base_label(label).alias("base"), T.percent(F.col("local_number") / 32.0).alias("share"), T.slug("checkpoint", 8, "node").alias("short_slug"), T.safe_name("checkpoint").alias("file_name"))


@query(rf"""WITH f AS (SELECT DISTINCT lesson_id, CASE WHEN lesson_no IS NULL THEN '1.2 ' || lesson_title || ' - 教师版.pdf' ELSE '第 ' || lesson_no::INT || ' 讲 ' || lesson_title || '（教师版）.pdf' END AS name FROM knowledge_points), b AS (SELECT *, regexp_replace(name, '(（教师版）|\(教师版\)| - 教师版|教师版)?\.pdf$', '') AS bare FROM f), s AS (SELECT *, regexp_extract(bare, '第\s*(\d+)\s*讲\s*(.+)', 1) AS no FROM b)
SELECT lesson_id, name, CASE WHEN no <> '' THEN no::INT WHEN regexp_matches(bare, '^[0-9]+(\.[0-9]+)*\s*.+') THEN 0 END AS number, CASE WHEN no <> '' THEN regexp_extract(bare, '第\s*(\d+)\s*讲\s*(.+)', 2) ELSE bare END AS title FROM s""")
def file_titles(spark: SparkSession, d: str) -> DataFrame:
    """Lesson numbers and titles read out of file names."""
    rows = read(spark, d, "knowledge_points", "lesson_id", "lesson_title", "lesson_no").distinct()
    name = F.when(F.col("lesson_no").isNull(), F.concat(F.lit("1.2 "), "lesson_title", F.lit(" - 教师版.pdf"))).otherwise(F.concat(F.lit("第 "), F.col("lesson_no").cast("int").cast("string"), F.lit(" 讲 "), "lesson_title", F.lit("（教师版）.pdf")))
    return rows.select("lesson_id", name.alias("name")).distinct().withColumn("x", T.file_title("name")).select("lesson_id", "name", "x.number", "x.title")


_STOPS = ("【答案", "答案", "【分析", "分析", "【解答", "解答", "点评")
_CUT = lambda c, stops: f"substr({c}, 1, least({', '.join(f'coalesce(nullif(CASE WHEN instr({c}, {chr(39)}{m}{chr(39)}) > 1 THEN instr({c}, {chr(39)}{m}{chr(39)}) - 1 END, 0), len({c}))' for m in stops)})::BIGINT)"


@query(rf"""WITH t AS (SELECT doc_id, {_N("text")} AS x, string_split(text, chr(10)) AS l FROM documents), k AS (SELECT *, regexp_replace({_CUT("x", _STOPS)}, '[\s,.;:，。；：、]+$', '') AS kept FROM t), m AS (SELECT *, regexp_extract(kept, '[0-9]+\s*[．.]') AS mk FROM k), c AS (SELECT *, CASE WHEN mk <> '' AND instr(kept, mk) <= 81 THEN substr(kept, instr(kept, mk)) ELSE kept END AS cut FROM m)
SELECT doc_id, md5(trim(regexp_replace(cut, '(^|[^\p{{L}}\p{{N}}_])[0-9]{{1,3}}\s*$', '\1'), ' ')) AS summary_md5, md5(coalesce(list_filter(l, lambda y: y <> '' AND NOT starts_with(y, '领世'))[1], 'untitled')) AS title_md5, md5(trim(regexp_replace(regexp_replace('见 `' || substr(x, 1, 5) || '` 与 [附录](https://a.b/' || doc_id || ')', '`([^`]+)`', '\1', 'g'), '\[([^\]]+)\]\(([^)]+)\)', '\1: \2', 'g'), ' ')) AS inline_md5 FROM c""")
def document_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Trimmed summaries, inferred titles and inline markup of documents."""
    rows = spread(read(spark, d, "documents", "doc_id", "text"))
    inline = F.concat(F.lit("见 `"), F.substring(T.norm("text"), 1, 5), F.lit("` 与 [附录](https://a.b/"), F.col("doc_id").cast("string"), F.lit(")"))
    return rows.select("doc_id", F.md5(T.summary("text")).alias("summary_md5"), F.md5(T.inferred_title(F.split("text", "\n"), F.lit("untitled"))).alias("title_md5"), F.md5(T.plain_inline(inline)).alias("inline_md5"))


@query(r"""WITH l AS (SELECT DISTINCT line_id, doc_id, page, pos, coalesce(text, '') AS x, y0 FROM ocr_lines), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY pos) - 1 AS before FROM l) SELECT line_id, x <> '' AND before > 0 AND (regexp_matches(x, '答案|分析|解答|点评') OR y0 / 1500 > 0.72) AS ends FROM n""")
def summary_ends(spark: SparkSession, d: str) -> DataFrame:
    """Whether each OCR line would end the summary of its page."""
    rows = read(spark, d, "ocr_lines", "line_id", "doc_id", "page", "pos", F.coalesce("text", F.lit("")).alias("x"), "y0").distinct()
    placed = O.nth(rows, ["doc_id", "page"], ["pos"], "n")
    return placed.select("line_id", T.ends_summary("x", F.col("n") - 1, F.col("y0") / 1500).alias("ends"))


_MARKS = "【答案】|【解析】|【分析】|【详解】|【解答】|【解题思路】|【解答过程】|【点评】"


@query(rf"""WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '({_MARKS})', chr(1) || '\1', 'g'), chr(1))[2:] AS p FROM documents), u AS (SELECT doc_id, unnest(p) AS p, generate_subscripts(p, 1) AS i FROM s), b AS (SELECT doc_id, i, regexp_extract(p, '^({_MARKS})') AS marker, {_TRIM(f"regexp_replace(p, '^({_MARKS})', '')")} AS body FROM u)
SELECT doc_id, marker, md5(string_agg(body, chr(10) ORDER BY i)) AS body_md5, count(*) AS n FROM b GROUP BY ALL""")
def layer_texts(spark: SparkSession, d: str) -> DataFrame:
    """All texts of each answer layer of a document, those of one marker joined in order."""
    layers = spread(read(spark, d, "documents", "doc_id", "text")).select("doc_id", T.answer_layers("text").alias("l"))
    return layers.select("doc_id", F.explode(T.joined_layers("l")).alias("x")).select("doc_id", "x.marker", F.md5("x.body").alias("body_md5"), "x.n")


@query(rf"""WITH t AS (SELECT DISTINCT task_id, coalesce(stem, '') AS s, regexp_extract(task_id, ':s(\d+)_q(\d+)$', 1)::INT AS sec, regexp_extract(task_id, ':s(\d+)_q(\d+)$', 2)::INT AS q FROM task),
r AS (SELECT *, CASE WHEN regexp_matches(s, '参数|恒成立|综合|求证|证明') THEN 1 WHEN sec >= 3 OR regexp_matches(s, '函数|最大值|最小值|配凑|消元|整体|若') THEN 2 WHEN sec = 1 AND q <= 4 THEN 3 ELSE 2 END AS k FROM t)
SELECT task_id, CASE k WHEN 1 THEN 'weak' WHEN 2 THEN 'medium' ELSE 'strong' END AS support, CASE k WHEN 1 THEN 'far' WHEN 2 THEN 'near' ELSE 'prototype' END AS transfer, regexp_matches(trim(s, ' '), '^((例题|问题|变式|练习)\s*\d*|\d+\s*[．.、]|（\d+）|\(\d+\))') AS question_like,
array_to_string(list_sort(list_filter([CASE WHEN regexp_matches(s, '[\x{{e000}}-\x{{f8ff}}]|√|≤|≥|[a-zA-Z]\s*[²³]') THEN 'formula_normalization' END, CASE WHEN regexp_matches(s, '如图|图中|作图|几何|三角形|圆') THEN 'visual_asset_required' END, CASE WHEN regexp_matches(s, '求证|证明') THEN 'proof_item' END, CASE WHEN regexp_matches(s, '【答案】|【解析】|【详解】') THEN 'answer_layer' END, CASE WHEN regexp_matches(s, '{_MARKS}') THEN 'possible_answer_leakage' END], lambda y: y IS NOT NULL)), ',') AS flags FROM r""")
def student_flags(spark: SparkSession, d: str) -> DataFrame:
    """What a student's stem shows: flags with a leaking answer layer, support and transfer of its tier, whether it begins as a question."""
    part = lambda k: F.regexp_extract("task_id", r":s(\d+)_q(\d+)$", k).cast("int")
    rows = read(spark, d, "task", "task_id", "stem").distinct().withColumn("x", R.tier(part(1), part(2), "stem"))
    return rows.select("task_id", "x.support", "x.transfer", R.question_like(F.coalesce("stem", F.lit(""))).alias("question_like"), F.array_join(R.pair_risk_flags("stem", is_student=True), ",").alias("flags"))


_TIERS = "k AS (SELECT task_id, lesson_id, difficulty, place, regexp_extract(task_id, ':s(\\d+)_q(\\d+)$', 1)::INT AS section FROM (" + SQL["task_tiers"] + "))"


def _tiers(spark: SparkSession, d: str) -> DataFrame:
    from slatemill.line_queries import task_tiers

    return task_tiers(spark, d).withColumn("section", F.regexp_extract("task_id", r":s(\d+)_q(\d+)$", 1).cast("int"))


@query(f"WITH {_TIERS} SELECT section, difficulty, count(*) AS n FROM k GROUP BY ALL")
def tier_counts(spark: SparkSession, d: str) -> DataFrame:
    """Tasks by section and tier."""
    return _tiers(spark, d).groupBy("section", "difficulty").agg(F.count("*").alias("n"))


@query(f"""WITH {_TIERS}, n AS (SELECT *, row_number() OVER (PARTITION BY lesson_id, section ORDER BY place) AS i FROM k), b AS (SELECT *, CASE WHEN difficulty = 'advanced' THEN 'ability_advance' WHEN i <= 1 THEN 'example_explain' ELSE 'intensive_training' END AS bucket FROM n), c AS (SELECT *, lag(bucket) OVER (PARTITION BY lesson_id, section ORDER BY place) AS before FROM b)
SELECT task_id, bucket FROM c WHERE before IS NULL OR before <> bucket""")
def banner_changes(spark: SparkSession, d: str) -> DataFrame:
    """The banners that a printed lesson shows: one where the bucket of its questions changes."""
    placed = O.nth(_tiers(spark, d), ["lesson_id", "section"], ["place"], "i").withColumn("bucket", R.banner_bucket("difficulty", "i"))
    return O.changes(placed, ["lesson_id", "section"], ["place"], F.col("bucket")).select("task_id", "bucket")


@query(rf"""WITH q AS (SELECT DISTINCT question_id, {_N("text_preview")} AS x FROM split_questions), c AS (SELECT *, len(x) AS length, {_SQL_STATS}, len(regexp_extract_all(x, '[=+\-*/^<>]')) AS ops FROM q)
SELECT question_id, length = 0 OR contains(x, chr(65533)) OR pua >= 1 OR (cjk <= 8 AND length >= 24) OR (length >= 32 AND length - cjk - latin - digit > 0.24 * length AND cjk < 20) OR (length >= 48 AND math >= 7 AND cjk < 48) AS noisy_summary,
length = 0 OR pua >= 1 OR regexp_matches(x, '([=+\-*/^(){{}}\[\]<>_.,:;|\\]+(\s+|$)){{6,}}') OR (cjk <= 8 AND latin + digit + (length - cjk - latin - digit) > 40) OR (length >= 48 AND length - cjk - latin - digit > 0.42 * length AND cjk < 16) OR (length >= 72 AND ops >= 10 AND cjk <= 36) AS noisy_export FROM c""")
def preview_noise(spark: SparkSession, d: str) -> DataFrame:
    """Whether previews are noisy by the rules for summaries and for exports."""
    rows = read(spark, d, "split_questions", "question_id", "text_preview").distinct()
    return rows.select("question_id", V.noisy_summary("text_preview").alias("noisy_summary"), V.noisy_export("text_preview").alias("noisy_export"))


_STOP7 = ("【答案】", "【分析】", "【解答】", "【点评】", "答案：", "分析：", "解：")
_EXCERPT = lambda c: rf"trim(regexp_replace({_CUT(c, _STOP7)}, '[，,；;：:。.\s]+$', ''), ' ')"


@query(rf"""WITH q AS (SELECT DISTINCT question_id, checkpoint, component_label, local_number, visual_pages, text_preview_source AS s, regexp_replace({_N("text_preview")}, '[\x{{e000}}-\x{{f8ff}}•◆◇■□]', ' ', 'g') AS x FROM split_questions), e AS (SELECT *, {_EXCERPT("x")} AS t FROM q), m AS (SELECT *, regexp_extract(t, '[0-9]+\s*[．.]') AS mk FROM e), l AS (SELECT *, CASE WHEN mk <> '' AND instr(t, mk) <= 81 THEN substr(t, instr(t, mk)) ELSE t END AS u FROM m),
w AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(u, '\s+([，。；：！？）】》])', '\1', 'g'), '([（【《])\s+', '\1', 'g'), '\s+([A-D])\s*[．.]', ' \1．', 'g'), '(^|[^0-9A-Za-z_])[0-9]{{1,3}}\s*$', '\1', 'g'), '\s+', ' ', 'g'), ' ') AS clean FROM l),
n AS (SELECT *, {_N("clean")} AS v FROM w), c AS (SELECT * REPLACE (v AS x), len(v) AS length, {_SQL_STATS.replace("(x,", "(v,")} FROM n),
r AS (SELECT *, (least(length, 140) + 3 * cjk - 80 * noise - 120 * pua - 2 * greatest(math - 18, 0) + regexp_matches(v, '^[0-9]+\s*[．.]')::INT * 24 + regexp_matches(v, '已知|如图|下列|则|求|设|若|满足|函数|方程|不等式|向量|中点|共面')::INT * 20)::BIGINT AS base, clean <> '' AND noise = 0 AND pua = 0 AND (regexp_matches(v, '^[0-9]+\s*[．.]') OR regexp_matches(v, '已知|如图|下列|则|求|设|若|满足|函数|方程|不等式|向量|中点|共面') OR regexp_matches(v, 'A[．.]|（\s*.*\s*）')) AS good, length >= 20 AND cjk >= 8 AS dense, length >= 18 AND cjk >= 6 AS fair FROM c),
p AS (SELECT *, CASE WHEN good AND s = 'pdf_text_layer' AND dense THEN base + 6 WHEN good AND s = 'ocr_fallback' AND (dense OR fair) THEN base + 4 WHEN good AND dense THEN base END AS best FROM r)
SELECT question_id, coalesce(CASE WHEN best IS NOT NULL THEN clean END, coalesce(checkpoint, '') || '｜' || coalesce(component_label, '') || CASE WHEN coalesce(local_number, 0) > 0 THEN ' ' || local_number ELSE '' END || '｜' || CASE WHEN visual_pages[1] IS NOT NULL THEN 'P' || lpad(visual_pages[1]::VARCHAR, greatest(2, len(visual_pages[1]::VARCHAR))::INT, '0') ELSE '页码待复核' END) AS preview, coalesce(best, 0) AS score, CASE WHEN best IS NOT NULL THEN 'trusted_excerpt' ELSE 'ocr_reference_only' END AS storage_mode FROM p""")
def preview_choice(spark: SparkSession, d: str) -> DataFrame:
    """The best readable excerpt of each question's preview, else a note on where the picture is."""
    rows = read(spark, d, "split_questions", "question_id", "checkpoint", "component_label", "local_number", "text_preview", "text_preview_source", "visual_pages").distinct()
    pick = V.best([("raw_text", F.col("text_preview")), ("pdf_text_layer", F.when(F.col("text_preview_source") == "pdf_text_layer", F.col("text_preview"))), ("ocr_fallback", F.when(F.col("text_preview_source") == "ocr_fallback", F.col("text_preview")))])
    rows = rows.withColumn("b", pick)
    page = F.try_element_at("visual_pages", F.lit(1))
    note = F.concat(F.coalesce("checkpoint", F.lit("")), F.lit("｜"), F.coalesce("component_label", F.lit("")), F.when(F.coalesce("local_number", F.lit(0)) > 0, F.concat(F.lit(" "), F.col("local_number").cast("string"))).otherwise(""), F.lit("｜"), F.when(page.isNotNull(), F.format_string("P%02d", page)).otherwise("页码待复核"))
    mode = F.when(F.col("b").isNotNull(), "trusted_excerpt").otherwise("ocr_reference_only")
    return rows.select("question_id", F.coalesce("b.clean", note).alias("preview"), F.coalesce("b.score", F.lit(0).cast("long")).alias("score"), mode.alias("storage_mode"))


@query(r"""WITH e AS (SELECT event_id, event_id % 6 AS k, props FROM events) SELECT event_id, CASE WHEN k < 4 THEN props END AS object, CASE WHEN k < 4 THEN 'ok' WHEN k = 4 THEN 'not_closed' ELSE 'not_found' END AS object_status FROM e""")
def model_objects(spark: SparkSession, d: str) -> DataFrame:
    """JSON objects taken out of what a model might say around them: alone, fenced, after words, with more after it, broken off, not at all."""
    k, props = F.col("event_id") % 6, F.col("props")
    text = F.when(k == 0, props).when(k == 1, F.concat(F.lit("```json\n"), props, F.lit("\n```"))).when(k == 2, F.concat(F.lit('说明 "}" 如下：'), props)).when(k == 3, F.concat(F.lit("a "), props, F.lit(" b } {}"))).when(k == 4, F.concat(F.lit("见 "), F.substring(props, F.lit(1), F.length(props) - 1))).otherwise("没有")
    return J.extract_objects(read(spark, d, "events", "event_id", "props").select("event_id", text.alias("t")), "t").select("event_id", "object", "object_status")


@query("""SELECT DISTINCT test_question_id, sha256(json_object('grade', grade, 'knowledge_id', knowledge_id, 'source_page', source_page, 'status', status)::VARCHAR) AS content_hash FROM coverage_set_review""")
def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Hashes of rows by their canonical JSON, nulls kept."""
    rows = read(spark, d, "coverage_set_review", "test_question_id", "status", "source_page", "knowledge_id", "grade").distinct()
    return rows.select("test_question_id", J.content_hash("status", "source_page", "knowledge_id", "grade").alias("content_hash"))
