from pyspark.sql import functions as F

from slatemill.functions import previews as V
from slatemill.functions import rules as R
from slatemill.functions import text as T
from slatemill.functions.jsontext import balanced, extract_objects
from slatemill.operators import extract as X
from slatemill.operators import gold as G


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


def test_text(spark):
    assert one(spark, T.norm("a"), a=" 一　 二\n三 ") == "一 二 三" and one(spark, T.norm("a"), a=None) == ""
    assert one(spark, T.clean_line("a"), a="​ x \t y　") == "x y" and one(spark, T.clip("a", 3), a="abcd") == "abc..."
    assert one(spark, T.useful_terms("a", "b"), a="方程 考点 12 应用", b="方程，求根 公式") == ["方程", "求根", "公式"]
    assert one(spark, T.slug("a"), a=" 高一 A-b ") == "高一_a_b" and one(spark, T.slug("a"), a="--") == "unknown" and one(spark, T.safe_name("a"), a='a/b:"c') == "a_b_c"
    b = one(spark, T.answer_blocks("a"), a="题干【解析】x【答案】B【解析】y")
    assert (b["stem"], b["answer"], b["explanation"], b["markers"]) == ("题干", "B【解析】y", "x", ["【解析】", "【答案】"])
    b = one(spark, T.answer_blocks("a"), a="无标记")
    assert (b["stem"], b["answer"], b["explanation"], b["markers"]) == ("无标记", "", "", [])
    assert [tuple(x) for x in one(spark, T.answer_layers("a"), a="题【答案】A【解析】p【答案】B")] == [("【答案】", "A"), ("【解析】", "p"), ("【答案】", "B")]
    assert one(spark, T.normalize_answer("a", "s"), a="B．因为", s="（  ）A．1 B．2") == "B" and one(spark, T.normalize_answer("a", "s"), a="Bc", s="求值") == "Bc"
    assert one(spark, T.symbols("a"), a="x1") == "x=1" and one(spark, T.checkpoint_name("a"), a="考点 3：方程") == "方程" and one(spark, T.escape_markup("a"), a='<a href="&">') == "&lt;a href=&quot;&amp;&quot;&gt;"


def test_rules(spark):
    for line, want in (("例题讲解", True), ("考点 2：方程", True), ("一、有理数的运算", True), ("一、有理数，运算", False), ("解：x", False)):
        assert one(spark, R.is_section("a"), a=line) is want
    assert one(spark, R.phase("a"), a="知识导入") == "intro_or_prerequisite" and one(spark, R.phase("a"), a="强化训练") == "student_practice" and one(spark, R.phase("a"), a="别的") == "knowledge_main"
    assert one(spark, R.risk_flags("a"), a="如图，求证【答案】") == ["formula_text_layer", "reasoning_or_proof", "teacher_answer_layer", "visual_or_table_asset"] and one(spark, R.risk_flags("a"), a=None) == []
    assert one(spark, R.learning_objectives("a"), a="1．掌握方程；2．理解函数；") is True and one(spark, R.question_marker("a"), a="已知x＝1，求y") is True
    assert one(spark, R.navigation("a"), a="知识导航 一") is True and one(spark, R.navigation("a"), a="1．掌握方程的解法") is True and one(spark, R.navigation("a"), a="已知x") is False
    assert tuple(one(spark, R.tier("s", "q", "x"), s=1, q=4, x="计算")) == ("basic", "strong", "prototype") and one(spark, R.tier("s", "q", "x"), s=1, q=1, x="求证")["difficulty"] == "advanced"
    crop = lambda canvas, red, number: R.crop_issues(F.lit(number), F.array(F.struct(F.lit(1).alias("page"))), F.array(F.lit(1)), F.lit(200), F.lit(0.1), F.lit(canvas), F.lit(red), F.lit("a"), F.lit("b"), F.lit("x"))
    assert [one(spark, R.crop_status(crop(*v)), a="") for v in ((0.18, 80, 1), (0.17, 80, 1), (0.17, 79, 1))] == ["PASS_BY_VISUAL_GATE", "PASS_WITH_LAYOUT_CLEANUP", "NEEDS_MODEL_OR_HUMAN_REVIEW"]
    assert one(spark, crop(0.1, 79, 0), a="") == ["answer_or_analysis_red_mark_not_obvious", "no_clear_question_number", "too_much_whitespace"]
    assert one(spark, R.review_risk("a", "k"), a=None, k="advanced") == "中"
    assert one(spark, R.version_tags("k", "n", "z"), k="example", n=2, z=121) == ["常用版", "基础版", "进阶版"]
    assert one(spark, G.heading_score(F.col("a"), F.col("t"), F.col("m")), a="考点 1 方程(组)【答案】例 2", t="方程(组)", m="x") == 295


def test_curation_rules(spark):
    data = [("1", "ok", "", "strong", 1), ("2", "bad", "已知", "strong", 1), ("3", "ok", "知识导航", "strong", 1), ("4", "ok", "已知a", "strong", 3), ("5", "ok", "平凡的文字", "strong", 1), ("6", "ok", "已知b", "fallback_page_context", 1), ("7", "ok", "已知c", "strong", 1), ("8", "ok", "已知d", "strong", 1), ("9", "ok", "已知e", "nearby_question_match", 1), ("10", "ok", "已知f", None, 1), ("11", None, None, None, 0)]
    df = spark.createDataFrame(data, "test_question_id string, status string, question_text_ocr string, selection_quality string, duplicate_count long")
    seen = spark.createDataFrame([("7", False, True), ("8", False, False)], "test_question_id string, point_hit boolean, lesson_hit boolean")
    got = {r["test_question_id"]: r["reason_code"] for r in G.curate(df, seen).collect()}
    assert got == {"1": "no_text", "2": "no_text", "3": "navigation", "4": "shared_snippet", "5": "no_question_marker", "6": "fallback_page", "7": "point_miss", "8": "lesson_miss", "9": "nearby_match", "10": "gold", "11": "no_text"}


def test_previews(spark):
    assert one(spark, V.excerpt("a"), a="题干，说明：【答案】B") == "题干，说明" and one(spark, V.excerpt("a"), a="【答案】B") == "【答案】B"
    assert one(spark, V.cleaned("a"), a="页眉 3．已知 x ，求 （ 1） 的值 A ．1 12") == "3．已知 x，求 （1） 的值 A．1" and one(spark, V.cleaned("a"), a="页眉 3．已知x。 ") == "3．已知x"
    assert one(spark, V.noisy("a"), a="x") is True and one(spark, V.noisy("a"), a="已知函数的图象经过点，求取值范围和最小值") is False
    got = one(spark, V.best([("raw_text", F.col("a")), ("ocr_fallback", F.col("b"))]), a="短", b="已知函数的图象经过一个点，求它的取值范围和最小值")
    assert got["source"] == "ocr_fallback" and one(spark, V.best([("raw_text", F.col("a"))]), a="短") is None
    assert tuple(one(spark, T.file_title("a"), a="第 3 讲 一元二次方程（教师版）.pdf")) == (3, "一元二次方程") and tuple(one(spark, T.file_title("a"), a="2.1 集合.pdf")) == (0, "2.1 集合") and tuple(one(spark, T.file_title("a"), a="附录.pdf")) == (None, "附录")


def lines(spark, texts, doc="d"):
    return spark.createDataFrame([(doc, i, t) for i, t in enumerate(texts)], "doc_id string, pos int, text string")


def test_tables_and_aims(spark, rows, monkeypatch):
    monkeypatch.setattr(X, "RUN", 3)
    nav = ["封面", "知识导航", "模块", "数与式", "有理", "数", "★★", "整式", "★", "12", "★★★", "方程", "解", "★", "1．目标", "函数", "图象", "★"]
    got = rows(X.navigation_rows(lines(spark, nav)), "row_no", "module", "point", "difficulty")
    assert got == {(1, "数与式", "有理数", "★★"), (2, "数与式", "整式", "★"), (4, "方程", "解", "★")}
    assert X.navigation_rows(lines(spark, ["无"])).count() == 0 and X.navigation_rows(lines(spark, nav).limit(0)).count() == 0
    got = rows(X.goals(lines(spark, ["前言", "1、能够解方程", "并检验", "2、理解函数", "3、其他", "4、会"])), "place", "text")
    assert got == {(1, "1、能够解方程并检验"), (2, "2、理解函数")}
    assert rows(X.objectives(lines(spark, ["课程目标", "1．掌握方程", *[f"{i}．理解函数" for i in range(2, 9)]])), "place") == {(i,) for i in range(1, 7)}
    assert rows(X.objectives(lines(spark, ["1、足够长的一行文字在这里", "2、短"])), "place", "text") == {(1, "1、足够长的一行文字在这里")}


def test_questions_of_pages(spark):
    pages = [("a", ["考点 1：方程", "说明", "1．已知x，求y", "（A）一", "2．下一题", "余下"], ["方程"]), ("b", None, None), ("c", ["说明"], ["无"]), ("e", ["1．甲", "乙", "丙", "丁", "方程"], ["方程"]), ("f", ["x" * 500, "y" * 500], [])]
    df = spark.createDataFrame(pages, "k string, l array<string>, t array<string>").selectExpr("*", "'z' block")
    got = {r["k"]: (r["block"], r["reason"]) for r in X.page_blocks(df, ["k"], F.col("l"), F.col("t")).collect()}
    assert got["a"] == ("1．已知x，求y （A）一", "question_marker_near_heading") and got["b"] == ("", "empty_page_text") and got["c"] == ("说明", "heading_context_fallback")
    assert got["e"] == ("1．甲 乙 丙 丁 方程", "question_marker_near_heading") and got["f"][0].endswith("...") and len(got["f"][0]) == 903
    assert one(spark, X.question_slice(F.col("p"), F.col("t"), F.col("m")), p="x" * 100 + "方程" + "y" * 300 + "\n 考点 2", t="方程", m=None) == "x" * 80 + "方程" + "y" * 300
    assert one(spark, X.question_slice(F.col("p"), F.col("t"), F.col("m")), p=None, t="方程", m="") == ""
    got = X.first_questions(lines(spark, ["说明", "【例1】", "已知函数的图象经过点，求值", "【答案】B", "余下"]), ["doc_id"]).first()
    assert (got["pos"], got["question"]) == (1, "已知函数的图象经过点，求值") and X.first_questions(lines(spark, ["无"]), ["doc_id"]).count() == 0
    got = X.first_questions(lines(spark, ["1．" + "长" * 700, *["后面的话"] * 40]), ["doc_id"]).first()
    assert got["question"] == "1．" + "长" * 498
    assert X.first_questions(lines(spark, ["变式一", "太短"]), ["doc_id"]).count() == 0


def test_answer_parts_and_bind(spark, monkeypatch):
    monkeypatch.setattr(X, "RUN", 3)
    texts = ["一、选择题", "1．题干", "续行", "【分析】甲", "乙", "【解答】丙", "二、解答题", "2．别题"]
    got = {r["number"]: r for r in X.answer_parts(lines(spark, texts)).collect()}
    assert (got[1]["section"], got[1]["question"], got[1]["analysis"], got[1]["solution"], got[2]["section"]) == ("一、选择题", "1．题干\n续行", "【分析】甲\n乙", "【解答】丙", "二、解答题")
    answers = spark.createDataFrame([("d", 1, "s", "q", "old", "", "", 0), ("d", 1, "s", "q", "new", "", "", 9)], "doc_id string, number int, section string, question string, analysis string, solution string, comment string, first_pos int")
    bound = {r["number"]: r for r in X.bind(spark.createDataFrame([("d", 1, "s", "q"), ("d", 2, "s", "q")], "doc_id string, number int, section string, question string"), answers).collect()}
    assert bound[1]["analysis"] == "new" and bound[2]["bind_status"] == "MISSING_ANSWER"


def test_titles_summaries_and_marks(spark):
    assert one(spark, T.symbols("a"), a="x＋1＝\uf0b1y") == "x+1=±y" and one(spark, T.without_number("a"), a="12． x＝1") == "x=1"
    assert one(spark, T.plain_inline("a"), a="`x` 见 [附录](http://a)") == "x 见 附录: http://a" and one(spark, T.section_of_key("a"), a="s3_q2") == "3"
    assert one(spark, T.summary("a"), a="页眉 3．已知x，求y：答案：B") == "3．已知x，求y" and one(spark, T.summary("a"), a="答案在前，已知 12") == "答案在前，已知" and one(spark, T.summary("a"), a=None) == ""
    assert one(spark, T.inferred_title(F.split("a", "\n"), "b"), a="领世教育\n\n一元二次", b="x") == "一元二次" and one(spark, T.inferred_title(F.split("a", "\n"), "b"), a="", b="x") == "x"
    assert one(spark, T.ends_summary("a", F.lit(1), F.lit(0.1)), a="【答案】") is True and one(spark, T.ends_summary("a", F.lit(0), F.lit(0.9)), a="x") is False and one(spark, T.ends_summary("a", F.lit(2), F.lit(0.9)), a="x") is True
    assert one(spark, T.data_url(F.encode("a", "UTF-8"), "text/plain"), a="字" * 60).count("\n") == 0
    assert one(spark, V.noisy_summary("a"), a="x = 1 \ufffd") is True and one(spark, V.noisy_export("a"), a="= = = + + + 已知函数图象") is True and one(spark, V.noisy_export("a"), a="已知函数的图象") is False


def test_json_in_text(spark):
    assert balanced('说明 {"a": "}\\"{", "b": {"c": 1}} 完') == ('{"a": "}\\"{", "b": {"c": 1}}', "ok")
    assert [balanced(x)[1] for x in (None, " ", "abc", '{"a": 1', "{oops}", '{"a": "}')] == ["empty", "empty", "not_found", "not_closed", "broken", "not_closed"]
    assert balanced('```json\n{"a": 1}\n```') == ('{"a": 1}', "ok") and balanced("[1, 2]") == ("[1, 2]", "ok") and balanced('{"a": 1} {"b": 2}') == ('{"a": 1}', "ok")
    assert len(balanced('{"a":' * 3000 + "1" + "}" * 3000)[1]) > 0
    df = spark.createDataFrame([("1", "x {} y"), ("2", None)], "id string, t string")
    assert {r["id"]: r["object_status"] for r in extract_objects(df, "t").collect()} == {"1": "ok", "2": "empty"}
