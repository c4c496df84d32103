import random

import numpy as np

from slatemill.llm import noise as N

CLEAN = ["已知函数的图象经过点，测得平均速度为5 m/s，数据的方差为3，求取值范围．", "向盛有氯化钠溶液的容器里逐滴加入3 mL的水，温度由1℃升高到3℃，求质量分数．", "电阻两端的电压不超过9 V，忽略自身的质量与摩擦，求证垂直于线段．"]
ENGLISH = ["On the following morning students should compare the careful orchard with the well-worn village because the water was described.", "The answer should mention the careful valley and the other garden, which was described before the students."]


def learned(spark):
    random.seed(1)
    texts = [random.choice(CLEAN) for _ in range(900)] + [random.choice(ENGLISH) for _ in range(600)]
    texts += [CLEAN[0].replace("数据", "教据"), CLEAN[0].replace("速度", "谏度"), CLEAN[1].replace("温度", "温庋"), CLEAN[0].replace("速度", "谏度"), CLEAN[0].replace("速度", "谏度"), ENGLISH[0].replace("should", "shou1d"), ENGLISH[0].replace("compare", "cornpare"), ENGLISH[1].replace("described", "dcscribed")]
    return N.learn(spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "text string"))


def test_kinds_and_repair(spark):
    repairs = learned(spark)
    assert len(repairs) == 1
    look = lambda t: set(N.examine([t], repairs[0], False)[0])
    assert [look(t) for t in CLEAN + ENGLISH + ["", None, "教师版在第83页补充了证明思路。", "区间[4，61]上", "R40＝5 Ω"]] == [set()] * 10
    for text, want in (
        ("碧波教研组内部资料", {"header"}), ("直线方程（教师版）  12", {"header", "page_number"}), ("— 12 —", {"page_number"}), ("l9", {"page_number"}), ("第 1 页 共 30 页", {"page_number"}), ("Unit 2  Vesper Reader", {"header"}),
        ("students should com-", {"hyphen"}), ("the garden was well-", set()), ("the stu-\ndents should", {"hyphen"}), ("the fes- tival every day", {"hyphen"}),
        (CLEAN[0].replace("数据", "教据"), {"misread"}), ("测得平均谏度为5 m/s", {"misread"}), ("运行6Z分钟", {"misread"}), ("=3，求", {"misread"}), (ENGLISH[0].replace("should", "shou1d"), {"misread"}), ("－7Zm＋39＝0", {"misread"}),
        ("已知函数的图象\n碧波教研组内部资料\n经过点", {"header"}), ("已知函数的图象经过点，测得平均速度为5 m/s，某 雁滩教研组内部资料 校同学", {"header"}),
    ):
        assert look(text) == want, (text, look(text))
    fix = lambda t: N.repaired(t, repairs[0])
    assert fix("已知函数的图\n碧波教研组内部资料\n象经过点，教据的方差为\n— 3 —\nZ5．") == "已知函数的图象经过点，数据的方差为25．"
    assert fix("the stu-\ndents shou1d compare\nthe well-\nworn village") == "the students should compare the well-worn village"
    assert fix(None) is None and fix("") == ""
    assert all(fix(t) == t for t in CLEAN + ENGLISH)


def test_words_and_numbers_wherever_they_stand(spark):
    """No prefix, length or line decides what is looked at."""
    repairs = learned(spark)[0]
    look = lambda t, placed=False: set(N.examine([t], repairs, [placed])[0])
    bad = ENGLISH[0].replace("should", "shou1d")
    assert look(CLEAN[0] * 12 + "\n" + bad) == look(CLEAN[0] * 12 + bad) == {"misread"} and look("shou1d.") == set() and look("the shou1d.") == {"misread"}
    assert N.repaired(CLEAN[0] * 12 + "\n" + bad, repairs).endswith(ENGLISH[0])
    assert look("取值 — 3 — 范围") == look("取值 — 3 — 范围" + CLEAN[0]) == {"page_number"} and look("取值 — 3 — 范围", True) == set()
    assert look("19") == {"page_number"} and look("19", True) == set() and look("— 19 —", True) == {"page_number"} and look("l9", True) == {"misread"}


def test_furniture_by_repetition_and_place(spark, rows):
    """A title of no known kind is told by its pages; a number by counting with them; numbers and headings in the text are content."""
    lines, at = [], 0
    for page in range(1, 9):
        number = {5: "l1", 6: None}.get(page, str(page + 6))
        for pos, text in enumerate(["山海文丛 卷3" if page % 2 else None, "始行甲" + "天地玄黄宇宙洪荒"[page - 1], "强化训练", "42", f"正文{page}乙", f"正文{page}丙", "42" if page == 6 else "尾行乙" + "天地玄黄宇宙洪荒"[page - 1], number], 1):
            if text:
                at += 1
                lines.append((f"k{at}", "d", page, pos, text))
    want = {(i, "header") for i, _, _, _, t in lines if t.startswith("山海")} | {(i, "page_number") for i, _, page, pos, t in lines if pos == 8}
    df = spark.createDataFrame([*lines, lines[0], ("n1", None, 1, 1, "山海文丛 卷3"), ("n2", "d", None, 1, "7"), (None, "d", 1, 1, "山海文丛 卷3"), ("n3", "e", 1, 1, None), ("n4", "e", 3, 1, "3"), ("n5", "e", 4, 2, "77")], "id string, doc_id string, page int, pos int, text string").selectExpr("*", "'x' kind", "1 form", "'y' src")
    assert rows(N.page_furniture(df), "id", "kind") == want | {("n4", "page_number")}
    assert N.page_furniture(df.limit(0)).count() == 0


def test_frames(spark, rows):
    repairs = learned(spark)
    df = spark.createDataFrame([("a", "1", "l9"), ("a", "1", "l9"), ("a", "2", None), ("a", "3", ""), ("a", None, "P4"), ("b", "4", CLEAN[0] * 3000)], "src string, id string, text string").selectExpr("*", "'x' kind")
    assert rows(N.find_noise(df, repairs)) == {("a", "1", "page_number")}
    assert {r["id"]: r["repaired"] for r in N.repair(df, repairs).collect()}["1"] == ""
    assert N.find_noise(df.limit(0), repairs).count() == 0
    empty = N.learn(df.limit(0).select("text"))
    assert rows(N.find_noise(df, empty)) == {("a", "1", "page_number")}


def test_parts_find_the_same(spark, monkeypatch):
    """Forms that one pass cannot hold are looked for in several passes, with the same result."""
    whole = learned(spark)
    texts = [CLEAN[0].replace("速度", "谏度"), CLEAN[1].replace("温度", "温庋"), ENGLISH[0].replace("should", "shou1d"), ENGLISH[1].replace("described", "dcscribed"), "l9", CLEAN[2]]
    df = spark.createDataFrame([("a", str(i), t) for i, t in enumerate(texts)], "src string, id string, text string")
    want = sorted(map(tuple, N.find_noise(df, whole).collect()))
    monkeypatch.setattr(N, "MAX_FORMS", 2)
    parts = learned(spark)
    assert len(parts) > 2 and sorted(map(tuple, N.find_noise(df, parts).collect())) == want and len(want) == 5


def test_repairs_all_it_finds(spark):
    """No misread character or word that is found is left by the repair."""
    repairs = learned(spark)[0]
    look, fix = (lambda t: set(N.examine([t], repairs, False)[0])), (lambda t: N.repaired(t, repairs))
    assert repairs.words["dcscribed"][0] == "described" and fix(ENGLISH[1].replace("described", "dcscribed")) == ENGLISH[1]
    repairs.words |= {"shquld": ("should", False), "mentiqn": ("mention", False)}
    repairs.follows.update({("should", "mention"), ("mention", "the")})
    assert fix(ENGLISH[1].replace("should mention", "shquld mentiqn")) == ENGLISH[1] and fix("Careful answer Shquld mention the valley") == "Careful answer Should mention the valley"
    assert fix("\uf03d71.4") == "=71.4" and fix("32\uf0b0") == "32" and fix("已知\uf0a3\n函数") == "已知≤函数"
    noisy = [CLEAN[0].replace("数据", "教据").replace("平均速度", "平均\n谏度"), "\uf03d71.4，求", "32\uf0b0", ENGLISH[0].replace("should", "shou1d").replace("compare", "cornpare"), ENGLISH[1].replace("described", "dcscribed").replace("should", "shou1d"), ENGLISH[1].replace("which was dcscribed", "which was\ndcscribed"), "运行6Z分钟"]
    assert all("misread" in look(t) for t in noisy[:5]) and not any("misread" in look(fix(t)) for t in noisy)


def split(whole, n):
    """The repairs in n parts, neighbouring contexts and words in different ones."""
    words = sorted(whole.words)
    parts = []
    for k in range(n):
        own = {w: whole.words[w] for w in words if sum(map(ord, whole.words[w][0])) % n == k}
        parts.append(N.Repairs(whole.keys[k::n], whole.meant[k::n], own, {f for f in whole.follows if sum(map(ord, f[0])) % n == k}, whole.heads))
    return parts


def test_parts_as_one(spark):
    """Furniture that needs the repairs of several parts is found and dropped as with all in one."""
    key = lambda l, c, r: (N._plain()[ord(l)] << 42) | (N._plain()[ord(c)] << 21) | N._plain()[ord(r)]
    text = "已知函数的图\n碧波数研纽内部资料 l0\n象经过点，求取值范围．"
    forms = sorted([(int(key("波", "数", "研")), ord("教")), (int(key("研", "纽", "内")), ord("组"))])
    whole = N.Repairs(*map(np.array, zip(*forms)), {"shquld": ("should", False), "mentiqn": ("mention", False)}, {("should", "mention"), ("mention", "the")}, set())
    df = spark.createDataFrame([("a", "1", text), ("a", "2", "The answer shquld mentiqn the careful valley."), ("a", "3", None), ("a", "1", text)], "src string, id string, text string")
    for parts in (split(whole, 2), split(whole, 3), [*split(whole, 2)[::-1]]):
        found = sorted(map(tuple, N.find_noise(df, parts).collect()))
        assert found == sorted(map(tuple, N.find_noise(df, [whole]).collect())) and [f[2] for f in found] == ["header", "page_number", "misread"]
        fixed = sorted(map(tuple, N.repair(df, parts).collect()), key=str)
        assert fixed == sorted(map(tuple, N.repair(df, [whole]).collect()), key=str)
        assert {r[1]: r[2] for r in fixed} == {"1": "已知函数的图象经过点，求取值范围．", "2": "The answer should mention the careful valley.", "3": None}
