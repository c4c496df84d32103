import pytest

from slatemill.llm import pairs as P

STEM = "某校29名同学到红枫渔场参加实践，分组搬运蓝色量筒，电阻两端的电压不超过14.2 V，求函数的最小值．"
ENGLISH = "The library, which was small and quiet, should be painted before the students leave the valley."


@pytest.mark.parametrize(
    "question,answer,want",
    [
        (STEM, None, "empty"), (STEM, "", "empty"), (STEM, "​", "empty"), (STEM, "（略）", "empty"), (STEM, "……", "empty"), (STEM, "【答案】", "empty"), (STEM, "N/A", "empty"), (STEM, "答案：待补", "empty"),
        (STEM, "抱歉，我无法回答这道题。", "refusal"), (STEM, "作为语言模型，我不能直接给出答案。", "refusal"), (STEM, "I'm sorry, but I can't help with this question.", "refusal"), (ENGLISH, "Lo siento, no puedo responder a esta pregunta.", "refusal"), (STEM, "请原谅，关于浮力的内容我不能提供解答。", "refusal"),
        (STEM, STEM, "copies_question"), (STEM, "题目：" + STEM.replace("，", ","), "copies_question"), (STEM, STEM[:40], "copies_question"), (ENGLISH, ENGLISH.replace(" ", ""), "copies_question"),
        (STEM, "The area equals 17.7, because both sides are parallel.", "other_language"), (STEM, "この方程式を解くと、答えは17.5となる。", "other_language"), (ENGLISH, "Como los lados son paralelos, el ángulo mide 63 grados.", "other_language"), (ENGLISH, "当p大于68时单调递增，当t小于11时单调递减。", "other_language"), (STEM, "Площадь равна 5.6, поэтому ответ 20.", "other_language"),
        (STEM, "因为BC平行于OP，所以∠F＝", "truncated"), (STEM, "设轻便玻璃板的数量为t，则总量为8", "truncated"), (STEM, "由题意得(", "truncated"), (ENGLISH, "Neither the solemn valley nor", "truncated"), (STEM, "应用勾股定理得OA＝4…", "truncated"),
        (STEM, "C", None), (STEM, "无解", None), (STEM, "D．无法确定", None), (STEM, "条件不足，不能判断其形状。", None), (STEM, "78.4 m", None), (STEM, "√(36x＋93)", None), (STEM, "DNA", None), (STEM, "因为EO平行于DK，所以∠K＝∠KHP。故选：B", None), (STEM, "取EG的中点，则DM等于FN的一半。证毕", None), (ENGLISH, "quite narrow", None), (ENGLISH, "After 63 minutes the students were gathered by Zabel.", None), (None, "因此结论成立。", None),
    ],
)
def test_rules(question, answer, want):
    found = P.defects(question, answer)
    assert (found[0] if found else None) == want, found


def test_every_defect_is_given():
    assert P.defects(STEM, "As a language model, I am unable to answer question 29.") == ["refusal", "other_language"]
    assert P.defects("x" * 100_000, "y" * 100_000 + "，") == ["truncated"]


def test_short_texts_and_cues():
    assert P.defects("求x", "求 x") == ["copies_question"] and P.defects("求x", "x") == [] and P.defects("", "C") == []
    phrases = ["I'm not able to answer.", "I can ' t help", "请咨询老师", "为难", "暂不支持回答", "Como modelo de lenguaje no", "Je suis désolé, je ne peux", "Ich kann dabei nicht helfen", "답변할 수 없", "Als KI kann ich", "超出我的能力范围"]
    for text in phrases:
        assert bool(P.REFUSALS.search(text)) == bool(P.REFUSALS.search(text) and any(c in text.lower() for c in P._DECLINES)), text


def test_frame(spark, rows):
    data = [("1", "q", None), ("2", None, "略"), ("3", "q", "C"), ("4", None, None), ("1", "q", None)]
    df = spark.createDataFrame(data, "id string, q string, a string").selectExpr("*", "'x' defects", "1 other", "a b", "7 field_name")
    got = P.defective_pairs(df, "q", {"a": True})
    assert sorted((r["id"], r["field_name"], tuple(r["defects"])) for r in got.collect()) == [("1", "a", ("empty",)), ("1", "a", ("empty",)), ("2", "a", ("empty",)), ("4", "a", ("empty",))] and "other" in got.columns
    assert {(r["id"], r["field_name"]) for r in P.defective_pairs(df, "q", {"a": False, "b": True}).collect()} == {("2", "a"), ("1", "b"), ("2", "b"), ("4", "b")}
    assert P.defective_pairs(df.limit(0), "q", {"a": True}).count() == 0
