"""Predicates and ordered classifiers over text, as Column expressions. Word lists are fixed values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from slatemill.functions import text as T

SECTION = r"^(知识导入|课程衔接|与.+差异性|【?思维导图】?|知识梳理|要点小测|例题讲解|强化训练|能力进阶|要点回顾|课堂小结|课程总结|课后练习|考点\s*\d+\s*[:：].+)$"
NUMBERED_SECTION = r"^[一二三四五六七八九十]+[、.．]\s*[^，。；：:]{2,28}$"
QUESTION_START = r"^((例题|问题|变式|练习)\s*\d*|\d+\s*[．.、]|（\d+）|\(\d+\))"
QUESTION_NUMBER = r"^(\d{1,3})[．.、]\s*(.+)"
QUESTION_MARKS = ("例题", "问题", "练习", "变式", "已知", "求", "证明", "计算", "解答", "下列", "若", "如图", "选择")
OBJECTIVE_VERBS = ("掌握", "理解", "认识", "了解", "熟练", "体会", "感受", "区分", "养成", "会运用", "能够", "能正确", "能根据", "会用", "建立")
SINGLE_VERBS = ("掌握", "理解", "熟练", "体会", "感受", "认识", "了解", "能够", "能根据", "会运用", "建立")
PROBLEM_VERBS = ("求", "证明", "解答", "若", "已知", "如图", "选择", "填空", "判断")
NAVIGATION_MARKS = ("课程目标", "知识导航", "知识梳理", "知识主干", "模块 考点 难度", "理解", "掌握", "能够", "会运用", "本讲", "学习目标")
SIGNAL_MARKS = ("已知", "求", "下列", "若", "如图", "选择", "判断")


def _any(x: Column, words) -> Column:
    return x.rlike("|".join(words))


def _hits(x: Column, words) -> Column:
    return sum((x.contains(w).cast("int") for w in words), F.lit(0))


def is_section(line) -> Column:
    """Whether a line is a section's heading."""
    line = T._c(line)
    return line.rlike(SECTION) | line.rlike(NUMBERED_SECTION)


def phase(title) -> Column:
    """Teaching phase of a section title; the first rule that holds."""
    t = T._c(title)
    return (
        F.when(t.contains("课程目标"), "learning_objectives")
        .when(t.isin("知识导入", "课程衔接") | t.contains("差异性"), "intro_or_prerequisite")
        .when(t.contains("思维导图"), "mind_map")
        .when(t.contains("知识") | t.rlike(NUMBERED_SECTION), "knowledge_main")
        .when(t.startswith("考点"), "exam_point")
        .when(t.contains("小测"), "diagnostic_quiz")
        .when(t.contains("例题"), "example_or_task")
        .when(_any(t, ("强化", "训练", "练习")), "student_practice")
        .when(_any(t, ("能力", "进阶")), "extension")
        .when(_any(t, ("回顾", "总结", "小结")), "summary_or_transfer")
        .otherwise("knowledge_main")
    )


def risk_flags(x) -> Column:
    """Sorted flags of what makes a text risky to reuse: private glyphs, pictures, proofs, answers inside."""
    t = F.coalesce(T._c(x), F.lit(""))
    rules = {"formula_text_layer": r"[\x{e000}-\x{f8ff}]", "visual_or_table_asset": "如图|图中|下图|表格|曲线|坐标系|遗传图解", "reasoning_or_proof": "证明|求证|实验设计|推理|探究", "teacher_answer_layer": "|".join(T.ANSWER_MARKERS)}
    return F.array_sort(F.array_compact(F.array(*[F.when(t.rlike(p), name) for name, p in rules.items()])))


def pair_risk_flags(x, is_student: bool = False) -> Column:
    """Flags of the paired variant; a student's text with an answer marker may leak it."""
    t = F.coalesce(T._c(x), F.lit(""))
    rules = {"formula_normalization": r"[\x{e000}-\x{f8ff}]|√|≤|≥|[a-zA-Z]\s*[²³]", "visual_asset_required": "如图|图中|作图|几何|三角形|圆", "proof_item": "求证|证明", "answer_layer": "【答案】|【解析】|【详解】"}
    if is_student:
        rules["possible_answer_leakage"] = "|".join(T.ANSWER_MARKERS_PAIRED)
    return F.array_sort(F.array_compact(F.array(*[F.when(t.rlike(p), name) for name, p in rules.items()])))


def tier(section, question, x) -> Column:
    """struct(difficulty, support, transfer) of a question; the first rule that holds."""
    t, s, q = F.coalesce(T._c(x), F.lit("")), T._c(section), T._c(question)
    make = lambda a, b, c: F.struct(F.lit(a).alias("difficulty"), F.lit(b).alias("support"), F.lit(c).alias("transfer"))
    return F.when(t.rlike("参数|恒成立|综合|求证|证明"), make("advanced", "weak", "far")).when((s >= 3) | t.rlike("函数|最大值|最小值|配凑|消元|整体|若"), make("standard", "medium", "near")).when((s == 1) & (q <= 4), make("basic", "strong", "prototype")).otherwise(make("standard", "medium", "near"))


def answer_status(answer, explanation) -> Column:
    filled = lambda c: T.norm(c) != ""
    return F.when(filled(answer), "explicit_answer").when(filled(explanation), "solution_only").otherwise("missing_or_unrecognized")


def question_like(line) -> Column:
    return F.trim(T._c(line)).rlike(QUESTION_START)


def learning_objectives(x) -> Column:
    """Whether the beginning lists two objectives or more and hardly a problem."""
    head = T.prefix(x, 380)
    clauses = F.regexp_extract_all(head, F.lit(r"(^|[。；;．])\s*\d+\s*[.．、]\s*([^。；;．]{0,45})"), 2)
    return (F.size(F.filter(clauses, lambda c: c.rlike("|".join(OBJECTIVE_VERBS)))) >= 2) & (_hits(head, PROBLEM_VERBS) <= 1)


def question_marker(x) -> Column:
    head = T.prefix(x, 320)
    return ~learning_objectives(head) & (_any(head, QUESTION_MARKS) | head.rlike(r"(^|[。；;])\s*\d+\s*[.．、)]"))


def single_objective(x) -> Column:
    clause = F.regexp_extract(T.prefix(x, 180), r"^\s*\d+\s*[.．、]\s*([^。；;．]{0,80})", 1)
    return _any(F.substring(clause, 1, 24), SINGLE_VERBS) | (_any(clause, SINGLE_VERBS) & ~_any(clause, PROBLEM_VERBS))


def navigation(x) -> Column:
    """Whether a text is a list of aims or a table of contents rather than a question."""
    head = T.prefix(x, 520)
    early = F.substring(head, 1, 80).rlike("重要性|学生版删除") | F.substring(head, 1, 140).contains("课程衔接")
    return learning_objectives(head) | single_objective(head) | head.contains("知识导航") | early | ((_hits(head, NAVIGATION_MARKS) >= 2) & ~question_marker(head))


def question_signal(x) -> Column:
    t = F.coalesce(T._c(x), F.lit(""))
    return t.rlike(r"(【\s*)?例\s*\d+") | _any(t, SIGNAL_MARKS)


def choose(rules: list[tuple[Column, str]], default: str) -> Column:
    """An ordered rule table as one CASE expression: the label of the first condition that holds."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for condition, label in rules:
        out = out.when(F.coalesce(condition, F.lit(False)), label)
    return out.otherwise(default)


def mapped(x, of: dict[str, str]) -> Column:
    """The value that a fixed map gives; null for one it does not list."""
    return F.try_element_at(F.create_map(*[F.lit(v) for pair in of.items() for v in pair]), T._c(x))


def banner_bucket(tier, place) -> Column:
    """Component banner of a question by its tier and its place in the section."""
    return F.when(T._c(tier) == "advanced", "ability_advance").when(T._c(place) <= 1, "example_explain").otherwise("intensive_training")


def version_tags(kind, nth, length) -> Column:
    """Version tags of a question by its component, its place in the checkpoint and its length, in the order they were given."""
    k, n, size = T._c(kind), T._c(nth), T._c(length)
    basic, more = "基础版", "进阶版"
    return F.array_distinct(F.array_compact(F.array(
        F.lit("常用版"),
        F.when((k == "example") | ((k == "practice") & (n <= 1)) | (k == "after_class"), basic),
        F.when(((k == "example") & (n >= 2) & (size > 120)) | ((k == "practice") & ((n >= 2) | (size > 150))) | (k == "advanced"), more),
    )))


def crop_issues(number, fragments, pages, height, nonwhite, canvas, red, checkpoint, label, preview) -> Column:
    """Sorted issues of a cut-out question. Each rule stands for itself; a statistic that is null triggers none.

    number: local number; fragments: array of structs with ``page``; pages: array; the rest are statistics of the picture and texts.
    """
    no, fr, pg, h, nw, cv, rd, cp, lb, pv = map(T._c, (number, fragments, pages, height, nonwhite, canvas, red, checkpoint, label, preview))
    order = F.transform(fr, lambda f: f["page"])
    count = lambda a: F.coalesce(F.size(a), F.lit(0))
    same = (F.coalesce(cp, F.lit("")) != "") & (cp == lb)
    rules = {
        "no_clear_question_number": F.coalesce(no, F.lit(0)) <= 0, "no_visual_fragment": F.greatest(count(fr), F.lit(0)) == 0, "crop_too_short": h < 120, "mostly_blank_crop": nw < 0.025, "too_much_whitespace": cv < 0.18,
        "answer_or_analysis_red_mark_not_obvious": rd < 80, "spans_more_than_two_pages": count(pg) > 2, "fragment_pages_out_of_order": (count(fr) > 1) & (order != F.array_sort(order)),
        "checkpoint_component_same_name_check_needed": same, "possible_non_question_block": F.substring(F.coalesce(pv, F.lit("")), 1, 30).rlike("知识|要点"),
    }
    return F.array_sort(F.array_compact(F.array(*[F.when(c, name) for name, c in rules.items()])))


def crop_status(issues) -> Column:
    """Verdict on a cut-out question; null issues stand for a missing picture."""
    i = T._c(issues)
    return F.when(i.isNull(), "FAIL").when(F.size(i) == 0, "PASS_BY_VISUAL_GATE").when(i == F.array(F.lit("too_much_whitespace")), "PASS_WITH_LAYOUT_CLEANUP").otherwise("NEEDS_MODEL_OR_HUMAN_REVIEW")


def review_risk(status, kind) -> Column:
    """高, 中 or 低; a missing audit counts as passed."""
    return F.when(F.coalesce(T._c(status), F.lit("")) == "NEEDS_MODEL_OR_HUMAN_REVIEW", "高").when(T._c(kind) == "advanced", "中").otherwise("低")
