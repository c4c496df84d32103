"""Broken prompt and response pairs: ordered rules over the response and its prompt, each defect found being given."""

import re
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame

from slatemill.llm.textnorm import skeleton

#: In the order of precedence.
DEFECTS = ("empty", "refusal", "copies_question", "other_language", "truncated")

#: What stands in a field that was not filled. Fixed values, compared without blanks and outer signs, in lower case.
PLACEHOLDERS = frozenset("略 从略 无 暂无 待定 待补 待补充 待填 待更新 未填 未知 空 暂缺 缺 答案略 解析略 过程略 答案待补 解析待补 答案暂缺 暂无答案 暂无解析 无答案 无解析 见下 null none nil nan na n/a tbd todo undefined empty blank placeholder pending".split())

#: Phrases that decline to answer, by language. Hedged results of mathematics (cannot be determined) are no refusals.
REFUSALS = re.compile(
    r"(抱歉|对不起|不好意思|请原谅|请谅解|很?遗憾).{0,40}?(无法|不能|不便|没法|没有办法|帮不|不会|难以|拒绝)"
    r"|作为(一个|一名|一款|一位)?.{0,6}(助手|模型|人工智能|AI|机器人).{0,20}(无法|不能|不会|不便|没有)"
    r"|(我|本助手|本模型)(们)?(暂时|目前|现在|恐怕|也)?(无法|不能|没有办法|没法|不便|不会|拒绝).{0,16}?(回答|解答|作答|提供|给出|协助|帮助|处理|完成|生成|告诉)"
    r"|拒绝(回答|解答|作答|提供|给出)|无可奉告|帮不(上|了)忙|帮不了(你|您)|(暂|尚)?不(支持|予)(回答|解答|作答)|(超出|不在).{0,8}(能力|服务|知识|允许).{0,4}范围|(不便|无法)(作答|回答|解答)(?!$)|请(咨询|询问|联系|另请).{0,8}(老师|教师|专业人士|客服)"
    r"|\b(i\s?'?\s?a?m\s+)?(very\s+)?sorry\b.{0,60}\b(can\s?'?t|cannot|can not|unable|not able|beyond|won'?t|could not|couldn't|not allowed)"
    r"|\bi\s+(cannot|can\s?'?t|can not|could not|couldn't|won'?t|will not|am (unable|not able|not allowed)( to)?|'?m (unable|not able|not allowed)( to)?|must decline|have to decline|decline)\s*(to\s+)?(\w+\s+){0,3}(provide|answer|help|assist|give|solve|comply|fulfil\w*|respond|share|complete|discuss|do|support|work)\b"
    r"|\bas an?\b.{0,20}\b(ai|language model|assistant|chatbot)\b|\bbeyond (what i|my) (am allowed|capabilit|abilit|scope)|\bunable to (answer|assist|help|provide|comply)\b|\bnot able to (answer|assist|help|provide)\b"
    r"|lo siento.{0,40}no puedo|no puedo (responder|ayudar|proporcionar|contestar)|como modelo de lenguaje|(je suis )?d[ée]sol[ée].{0,40}(je ne|ne peux)|je ne peux pas (r[ée]pondre|aider|fournir)|en tant que mod[èe]le"
    r"|(es tut mir leid|entschuldigung|leider).{0,40}(kann|nicht)|ich kann (diese|dabei|ihnen|dir|das)?.{0,20}nicht (beantworten|helfen)|als (ki|sprachmodell)|(извините|простите|к сожалению).{0,40}(не могу|не можем)|я не могу (ответить|помочь|предоставить)|как языковая модель"
    r"|申し訳(ありません|ございません)|お答え(できません|することができません)|回答できません|お手伝いできません|죄송(합니다|하지만)|답변(할 수 없|드릴 수 없)|도와드릴 수 없",
    re.I,
)

#: Every refusal phrase holds one of these (in lower case), so most texts are passed over at once.
_DECLINES = ("抱歉", "对不起", "不好意思", "原谅", "谅解", "遗憾", "作为", "无法", "不能", "没有办法", "没法", "不便", "不会", "拒绝", "无可奉告", "帮不", "不支持", "不予", "超出", "不在", "请", "sorry", "cannot", "can't", "can 't", "can ' t", "can' t", "can not", "could", "won", "will not", "unable", "not able", "not allowed", "decline", "as a", "beyond", "lo siento", "puedo", "como modelo", "sol", "peux", "en tant", "leid", "entschuldigung", "leider", "kann", "als ", "извините", "простите", "сожалению", "не могу", "языковая", "申し訳", "できません", "죄송", "수 없")

_LEAD = re.compile(r"^\s*(?:【?\s*(?:参考)?(?:答案|解析|分析|详解|点评|解答|答|解|题目|题干|问题|原题)\s*】|(?:参考)?(?:答案|解析|分析|详解|解答|答|解|题目|题干|问题|原题)\s*[:：]|(?:answer|explanation|solution|question|stem)\s*[:：])\s*", re.I)
_HAN, _KANA, _HANGUL, _CYR = re.compile(r"[㐀-鿿\uf900-\ufaff]"), re.compile(r"[぀-ヿ]"), re.compile(r"[가-힣ᄀ-ᇿ]"), re.compile(r"[Ѐ-ӿ]{2,}")
_OTHERS = re.compile(r"[֐-׿؀-ۿऀ-ॿ฀-๿Ͱ-Ͽ]{3,}")
_WORD = re.compile(r"[^\W\d_一-鿿぀-ヿ가-힣]{2,}")
_SENTENCE = re.compile(r"(?<=[。！？!?;；\n])|(?<=[^\d][.．])(?=\s|$)|(?<=[.．])(?=\s)")
_EDGE = " \t\r\n​-—–_.。．,，、;；:：!！?？…·*#()（）[]【】<>《》\"'“”‘’/\\|~"

#: Frequent words of languages in Latin script that English lacks. Fixed values.
LATIN_WORDS = {
    "es": "el la los las un una unos del es son por lo que se de en y al con para como igual respuesta ángulo lados ecuación valor área grados entonces luego tanto mide obtenemos sustituimos está son paralelos".split(),
    "fr": "le la les un une des du est sont dans et on donc que qui au aux pour avec comme réponse angle côtés équation valeur surface aire degrés trouve vaut mesure parallèles obtient égale".split(),
    "de": "der die das ein eine ist sind und im den dem des mit für wir also daher nicht von zu winkel seiten gleichung wert fläche antwort grad beträgt parallel setzen erhalten ergibt".split(),
    "it": "il lo la gli le un una è sono di del della per che con quindi allora risposta angolo lati equazione valore area gradi misura paralleli otteniamo".split(),
    "pt": "o os a as um uma é são do da dos das no na por que com para então logo resposta ângulo lados equação valor área graus mede obtemos paralelos".split(),
}
_ENGLISH = frozenset("the a an of to in is was were and that it had been with for from by on at this be are as which should more than not how what where when why who did does".split())


def bare(text: str) -> str:
    """Lower-case letters and digits only, for comparing wording."""
    return "".join(c for c in text.casefold() if c.isalnum() or c in "²³")


def language(text: str) -> str:
    """zh, ja, ko, ru, en, another code, or '' where the text is letters, numbers, formulas and terms only."""
    han, kana = len(_HAN.findall(text)), len(_KANA.findall(text))
    if kana >= 2 and kana * 4 >= han:
        return "ja"
    if len(_HANGUL.findall(text)) >= 4:
        return "ko"
    if len(_CYR.findall(text)) >= 3:
        return "ru"
    if len(_OTHERS.findall(text)) >= 3:
        return "xx"
    words = [w.casefold() for w in _WORD.findall(text)]
    if han >= 4 and han >= 0.5 * len(words):
        return "zh"
    if len(words) >= 4:
        best = max(((sum(w in own for w in words), code) for code, own in LATIN_WORDS.items()), default=(0, ""))
        english = sum(w in _ENGLISH for w in words)
        accented = sum(any("à" <= c <= "ÿ" or c in "œ" for c in w) for w in words)
        return best[1] if best[0] >= 2 and best[0] + accented > english else "en"
    return ""


def unclosed(text: str) -> bool:
    """Whether a delimiter opened in the text is not closed in it."""
    return any(text.count(a) > text.count(b) for a, b in ("()", "（）", "[]", "【】", "{}", "《》", "“”"))


def broken_off(text: str) -> bool:
    """Whether the text ends inside a sentence. Bare results (a letter, number, formula, term) are whole without a full stop."""
    text = text.rstrip(" \t\r\n")
    if not text:
        return False
    if re.search(r"(\.\.\.|…|⋯)$", text) or text[-1] in ",，、;；:：=＝+＋-－<≤×÷/∠√(（[【“《":
        return True
    if re.search(r"[。！？!?．）)”\"'】]$", text):
        return False
    if unclosed(re.split(r"[。！？!?．]", text)[-1]):
        return True
    han, words = len(_HAN.findall(text)), len(_WORD.findall(text))
    if text[-1] == ".":
        return han >= 4 and text[-2:-1].isdigit()
    if re.search(r"(证毕|得证|证完|完毕|Q\.?E\.?D)$", text) or re.search(r"(故选|应选|选择?|答案[为是]?|正确[的]?[为是]?)\s*[:：]?\s*[A-H]+$", text):
        return False
    if han >= 4:
        last = re.split(r"[。！？!?．]", text)[-1]
        clause = re.search(r"[,，]", last) or re.search(r"[。！？]", text)
        # a short nominal result such as a choice with its wording, 无法确定 or 45.3 分钟, has no clause
        return bool(clause) or len(_HAN.findall(last)) >= 7
    if han == 0:
        return words >= 4 or bool(re.search(r",", text)) and words >= 3 or bool(re.search(r"[.!?]\s+\S", text)) and words >= 3
    return bool(re.search(r"[,，。]", text))


def _grams(text: str) -> set[str]:
    return {text[i : i + 5] for i in range(len(text) - 4)}


class Question:
    """A prompt with what the rules compare of it, worked out once for all its responses."""

    def __init__(self, text: str | None):
        self.text = skeleton(text or "")
        self.language = language(self.text)

    @cached_property
    def bare(self) -> str:
        return bare(self.text)

    @cached_property
    def grams(self) -> set[str]:
        return _grams(self.bare)

    def copied_by(self, answer: str) -> bool:
        """Whether the answer says nothing but the question, or most of it; one of fewer than eight letters must be all of it."""
        q = self.bare
        if 2 * len(answer) < len(q):
            return False
        a = bare(answer)
        if not a or 2 * len(a) < len(q) or min(len(a), len(q)) < 8:
            return bool(a) and a == q
        if a in q:
            return True
        own = _grams(a)
        both = len(own & self.grams)
        return both >= 0.85 * len(own) and both >= 0.5 * len(self.grams)


def defects(question: "Question | str | None", answer: str | None) -> list[str]:
    """All defects of a pair, in the order of DEFECTS; an empty response has no other."""
    if answer is None:
        return ["empty"]
    text = skeleton(answer)
    while (cut := _LEAD.sub("", text, count=1)) != text:
        text = cut
    core = text.strip(_EDGE)
    if not core or (len(core) < 40 and re.sub(r"\s+", "", core).casefold() in PLACEHOLDERS):
        return ["empty"]
    question = question if isinstance(question, Question) else Question(question)
    found, low = [], text.lower()
    if any(cue in low for cue in _DECLINES) and REFUSALS.search(text):
        found.append("refusal")
    if question.copied_by(text):
        found.append("copies_question")
    if question.language:
        spoken = language(text)
        parts = [s for s in _SENTENCE.split(text) if s] if not text.isascii() or question.language != "en" else []
        if ({spoken} | {language(s) for s in parts if s != text}) - {"", question.language}:
            found.append("other_language")
    if broken_off(text):
        found.append("truncated")
    return found


def defective_pairs(df: DataFrame, question: str, answers: dict[str, bool]) -> DataFrame:
    """df's other columns with ``field_name`` and ``defects`` (array, in order of precedence) of each defective pair of the question and an answer column.

    answers: the answer columns, and of each whether a null is a defect (``empty``) or no case. All columns are judged in one
    pass in Arrow batches. A null or blank question allows the rules on the answer alone. Very long texts are read whole.
    Repeated rows repeat their result; an empty table gives none. Columns of df called ``field_name`` or ``defects`` are replaced.
    """
    rest = [c for c in df.columns if c not in (question, *answers, "field_name", "defects")]

    def judge(batches):
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            columns = [(name, counts, get(name).to_pylist()) for name, counts in answers.items()]
            at, fields, found = [], [], []
            for k, text in enumerate(get(question).to_pylist()):
                asked = Question(text)
                for name, counts, values in columns:
                    if (values[k] is not None or counts) and (own := defects(asked, values[k])):
                        at.append(k), fields.append(name), found.append(own)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(get(c).take(at) for c in rest), pa.array(fields, pa.string()), pa.array(found, pa.list_(pa.string()))], names=[*rest, "field_name", "defects"])

    return df.mapInArrow(judge, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in rest), "field_name string, defects array<string>"]))
