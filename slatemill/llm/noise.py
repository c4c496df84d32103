"""Noise in text from scanned pages: cut words, misread characters, running headers and page numbers, and their repair.

The corpus itself is the lexicon. A first pass counts ideographs with their neighbours and alphabetic words with theirs. Rare
forms are then matched to frequent ones: words through a symmetric-delete index (two words within one edit share a word
with one letter deleted), ideographs through known confusion pairs and through places where deleting the character leaves
neighbours that nearly always hold another. Weighted edits and the neighbours' counts decide on each repair. A second pass
finds the forms to repair in every text, and the furniture of pages by its shape.
"""

import re
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatemill.functions.text import GLYPHS
from slatemill.llm import textnorm
from slatemill.plans.cut import cut

#: Ideographs that scanners take for each other, each group closed. Fixed values.
CONFUSIONS = (
    "数教 温溫 据椐 度庋席 积枳 图囹 验脸 液夜 量晕 实买 正止 方万 溶洛 函涵 如加 线钱 压庄 于干千 例列 质盾 分芬 别刖 确硝 列刎 下卜 时肘 间问 行衍 平乎 长氏 天夭 面而 体休 速谏 直宜 径泾 未末 概慨 等筹 范氾 果杲 学孚字 师帅 结绍 已巳己 角甬 同冋 计汁 "
    "算箅 足促兄 围圃 土士 日曰 人入八 大太犬 木本术 王玉主 田由甲申 治冶 拔拨 折拆析 侯候 徒徙 免兔 鸟乌 侧测 洒酒 辩辨 梁粱 刺剌 戊戌戍 今令 今合 几儿 力刀 云去 元无 开井 见贝 爪瓜 午牛 失矢 白自 目且 石右 占古 史吏 代伐 仑仓 白臼 处外 "
    "亨享 住往佳 材村 均圴 没设 抵低 析柝 析拆 狠狼 建健 弧孤 钓钩 倍陪 氧氡 清情 请清 晴睛 喝渴 概溉 稍梢 慢漫 墙嫱 燥操 躁澡 蓝篮 籍藉 驱躯 温湿 混棍 溶熔 贷货 货贸 末朱 东车 兀元 孑子 子了 比北 此比 水永 水木 每母 气乞 求裘 沙抄 汽汔 位拉 侍待 "
    "观现 规现 证征 记纪 设投 认队 让上 议义 导异 变恋 点占 热熟 然燃 照昭 烧浇 灯打 炉护 率卒 牲性 物勿 特持 状壮 环坏 球救 电申 画面 界畀 疑凝 登澄 益盖 监盐 盘盆 省眉 看着 真直 眼银 短知 研砚 破坡 碱减 示禾 祝视 禁楚 种钟 科料 秒抄 移栘 程桯 稀希 究穷"
)
#: Signs that scanners take for digits, with the digit. Fixed values.
DIGITS = {"l": "1", "I": "1", "O": "0", "o": "0", "Z": "2", "S": "5", "B": "8", "G": "6"}
#: Letter groups that scanners take for each other. Fixed values.
LETTERS = (("rn", "m"), ("cl", "d"), ("vv", "w"), ("li", "h"), ("ii", "u"), ("1", "l"), ("0", "o"), ("5", "s"), ("8", "b"), ("6", "b"), ("9", "g"), ("1", "i"), ("3", "e"), ("2", "z"), ("c", "e"), ("l", "t"), ("l", "i"), ("f", "t"), ("h", "b"), ("u", "v"), ("n", "h"), ("n", "u"), ("a", "o"), ("i", "j"), ("rri", "m"), ("ln", "m"), ("tl", "d"), ("nn", "m"), ("o", "c"), ("o", "e"), ("g", "q"), ("y", "v"))
#: Parts that a running header or footer has, apart from names. Fixed values, extended by a caller's own.
CUES = (
    r"\S{1,6}教研[组室](?:\S{0,8})?", r"\S{1,6}讲义\s?[·・]\s?\S{1,10}", r"\S{1,12}[（(](?:教师|学生|家长|解析)[版卷用][）)]", r"\S{1,6}[·・]\s?第\s?[\dlIOoSZBG]+\s?讲\s*\S{0,10}", r"[一二三四五六七八九初高]年?[级一二三]?[春夏秋冬上下][季册]?\s*第\s?[\dlIOoSZBG]+\s?讲", r"[春夏秋冬]季同步课程\s?\S{0,6}",
    r"内部(?:资料|使用)\S{0,6}", r"版权所有\S{0,8}", r"(?:[A-Z]\S+\s?)?English\s?Handout", r"(?:Teacher|Student)\s?Copy(?:\s?-\s?[A-Z]\S+)?", r"(?:[A-Z]\S+\s?)?Reading\s?Workbook(?:\s?/\s?Grade\s?[\dlIOoSZBG]+)?", r"Unit\s?[\dlIOoSZBG]+\s+[A-Z]\S+\s?Reader",
)
_D = r"[\dlIOoSZBG]{1,4}"
PAGES = rf"(?:—\s?{_D}\s?—|-\s{_D}\s-|–\s?{_D}\s?–|第\s?{_D}\s?页(?:\s?[,，/]?\s?共\s?{_D}\s?页)?|\[{_D}\]|·\s?{_D}\s?·|[Pp]age\s?{_D}(?:\s?of\s?{_D})?|[Pp]\.?{_D}|{_D}\s/\s{_D}|{_D})"
_HEADER = re.compile("|".join(CUES))
_HEADER_LINE = re.compile(rf"^\s*(?:{PAGES}\s*)?(?:{'|'.join(CUES)})\s*(?:{PAGES})?\s*$")
_CUE = re.compile(r"教.[组室]|.研[组室]|内部资|讲义|讲.·|[师生]版|同步课|第\s?\S{1,3}\s?讲|Handout|Copy|Workbook|Reader|版权")
_PAGE_LINE, _BARE_LINE = re.compile(rf"^\s*{PAGES}\s*$"), re.compile(rf"^\s*{_D}\s*$")
_PAGE_NEXT = re.compile(rf"^\s*{PAGES}(?=\s|$)"), re.compile(rf"(?:^|(?<=\s)){PAGES}\s*$")
#: Page numbers inside run-together text stand between blanks; a bare number needs ideographs around and no unit after it.
_PAGE_RUN = re.compile(rf"(?:^|(?<=\s))(?:—\s?{_D}\s?—|-\s{_D}\s-|第\s?{_D}\s?页(?:\s?共\s?{_D}\s?页)?|\[{_D}\]|·{_D}·|Page\s{_D}(?:\sof\s{_D})?|P\d{_D[:-5]}{{1,3}}|[\dl]{{1,3}}\s/\s[\dl]{{1,3}})(?=\s|$)")
_BARE_RUN = re.compile(r"(?<=[^\x00-\x7f])\s[\dl]{1,3}\s(?=[^\x00-\x7f])(?!\s?[℃°∶≤＋－＝（）])")
_HYPHEN = re.compile(r"([^\W\d_]{2,})-[ \t]*(?=\n|$| (?=[^\W\d_A-Z一-鿿]))", re.M)
_TOKEN = re.compile(r"[A-Za-z0-9|À-ɏ]+(?:[-'][A-Za-z0-9À-ɏ]+)*")
_NUMBER = re.compile(r"(?<![A-Za-z0-9.])(?:[0-9lIOoZSBG]*\d[0-9lIOoZSBG]*(?:\.[0-9lIOoZSBG]+)*|[lIOoZSBG]+\.\d+|\.[0-9lIOoZSBG]*\d[0-9lIOoZSBG]*|\.[lIOoZSBG])(?![A-Za-z]{2}|[A-Z])")
_PRIVATE = re.compile(r"[-]")
#: Ratio from which a form counts as rare beside another.
RATIO = 12.0
#: Forms to repair that one pass over the texts looks for, at most; larger sets take several passes.
MAX_FORMS = 3_000_000
_EDGE, _DIGIT, _LATIN = 1, 0x30, 0x61


@cache
def _plain() -> np.ndarray:
    """Code point to the one counted: look-alikes in one form, digits and letters each as one class, blanks and ignorables 0."""
    out = np.arange(0x110000, dtype=np.int64)
    for code, new in textnorm.table().items():
        out[code] = ord(new[0]) if new and not new[0].isspace() else 0
    out[[*range(9, 14), 32, 0x85, 0xA0, 0x3000, 0x2028, 0x2029]] = 0
    out[48:58] = _DIGIT
    out[65:91] = out[97:123] = _LATIN
    return out


def _contexts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (left, ideograph, right) of every ideograph, the text each is from and its place there. Blanks and line breaks are skipped."""
    codes = np.frombuffer("\x01".join(["", *(t.replace("\x01", " ") for t in texts), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    form = _plain()[codes]
    form[codes == 1] = _EDGE
    edges = np.flatnonzero(codes == 1)
    place = np.flatnonzero(form)
    form = form[place]
    at = np.flatnonzero((form >= 0x3400) & (form < 0xA000))
    text = np.searchsorted(edges, place[at]) - 1
    return (form[at - 1] << 42) | (form[at] << 21) | form[at + 1], text, place[at] - edges[text] - 1


#: Stretches without ideographs and full-width signs, and what a stretch of running words has: a word of four letters or a dozen letters.
_STRETCH = re.compile(r"[^\u2e80-\u9fff\uac00-\ud7a3\uf900-\ufaff\uff00-\uffef]+")
_WORDY, _LETTERS = re.compile(r"[A-Za-z][a-z]{3}"), re.compile(r"[A-Za-z]")


def _wordy(text: str) -> list[tuple[int, str]]:
    """(place, stretch) of the parts of a text that are alphabetic writing, wherever they stand in it."""
    if not _LETTERS.search(text):
        return []
    return [(m.start(), m[0]) for m in _STRETCH.finditer(text) if _WORDY.search(m[0]) or len(_LETTERS.findall(m[0])) > 12]


def count_forms(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ideographs with neighbours (key, n), words with the next one (word, following, n)) over all rows of texts (text)."""

    def count(batches):
        keys, sums, words = np.empty(0, np.int64), np.empty(0, np.int64), Counter()
        for batch in batches:
            rows = [t for t in batch.column(0).to_pylist() if t]
            for a in range(0, len(rows), 4000):
                key, n = np.unique(_contexts(rows[a : a + 4000])[0], return_counts=True)
                keys, place = np.unique(np.r_[keys, key], return_inverse=True)
                sums = np.bincount(place, np.r_[sums, n]).astype(np.int64)
            for t in rows:
                for _, stretch in _wordy(t):
                    found = [w.lower() for w in _TOKEN.findall(stretch)]
                    words.update(zip(found, [*found[1:], ""]))
            if len(words) > 500_000 or len(keys) > 2_000_000:
                yield from emit(keys, sums, words)
                keys, sums, words = np.empty(0, np.int64), np.empty(0, np.int64), Counter()
        yield from emit(keys, sums, words)

    def emit(keys, sums, words):
        none = pa.nulls(len(keys), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(keys), none, none, pa.array(sums)], names=["key", "word", "following", "n"])
        pairs = list(words)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(pairs), pa.int64()), pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string()), pa.array(list(words.values()), pa.int64())], names=["key", "word", "following", "n"])

    forms = cut(texts.select("text").mapInArrow(count, "key long, word string, following string, n long").groupBy("key", "word", "following").agg(F.sum("n").alias("n")))
    return forms.filter("key is not null").select("key", "n"), forms.filter("word is not null").select("word", "following", "n")


def misread_contexts(contexts: DataFrame) -> DataFrame:
    """Keys of ideographs to repair with the ideograph meant (key, meant), from counted contexts (key, n)."""
    spark = contexts.sparkSession
    part = lambda shift: F.shiftright("key", shift).bitwiseAND(F.lit((1 << 21) - 1))
    seen = contexts.select("key", part(42).alias("l"), part(21).alias("c"), part(0).alias("r"), "n")
    # symmetric delete: contexts without their middle, and what nearly always stands there
    holes = seen.groupBy("l", "r").agg(F.max_by("c", "n").alias("best"), F.max("n").alias("most"))
    judged = seen.filter(f"l <> {_EDGE} and r <> {_EDGE}").join(holes, ["l", "r"]).withColumn("odd", (F.col("best") != F.col("c")) & (F.col("most") >= RATIO * F.col("n")))
    known = sorted({(ord(a), ord(b)) for group in CONFUSIONS.split() for a in group for b in group if a != b})
    pairs = F.broadcast(spark.createDataFrame(known, "c long, meant long"))
    # ideographs that hardly ever stand where they belong
    whole = seen.groupBy("c").agg(F.sum("n").alias("total"))
    strays = judged.filter("odd").groupBy("c").agg(F.sum("n").alias("bad"), F.max_by("best", "n").alias("meant"))
    never = strays.join(whole, "c").filter("bad >= 3 and bad >= 0.6 * total").select("c", "meant")
    left, right = seen.groupBy("l", "c").agg(F.sum("n").alias("n_l")), seen.groupBy("c", "r").agg(F.sum("n").alias("n_r"))
    meant = lambda df, n: df.withColumnRenamed("c", "meant").withColumnRenamed(n, f"{n}_meant")
    tried = seen.join(pairs, "c").join(left, ["l", "c"]).join(right, ["c", "r"]).join(meant(left, "n_l"), ["l", "meant"], "left").join(meant(right, "n_r"), ["meant", "r"], "left").fillna(0, ["n_l_meant", "n_r_meant"])
    on_left, on_right = (F.col("n_l_meant") + 0.5) / (F.col("n_l") + 0.5), (F.col("n_r_meant") + 0.5) / (F.col("n_r") + 0.5)
    sure = F.when((F.col("l") == _EDGE) & (F.col("r") == _EDGE), False).when(F.col("l") == _EDGE, on_right >= RATIO).when(F.col("r") == _EDGE, on_left >= RATIO).otherwise((on_left * on_right >= 4 * RATIO) & (F.least(on_left, on_right) >= 0.5))
    by_pair = tried.filter(sure).select("key", "meant", (on_left * on_right).alias("weight"))
    by_stray = seen.join(never, "c").select("key", "meant", F.lit(0.1).alias("weight"))
    return by_pair.unionByName(by_stray).groupBy("key").agg(F.max_by("meant", "weight").alias("meant"))


def _respelled(word: str) -> set[str]:
    """The word with one group of letters that are taken for each other replaced."""
    out = set()
    for a, b in LETTERS:
        for x, y in ((a, b), (b, a)):
            k = word.find(x)
            while k >= 0:
                out.add(word[:k] + y + word[k + len(x) :])
                k = word.find(x, k + 1)
    plain = "".join(DIGITS_BACK.get(c, c) for c in word)
    return out | ({plain} if plain != word else set()) | {re.sub("1", x, word) for x in "li"} - {word}


DIGITS_BACK = {"1": "l", "0": "o", "5": "s", "8": "b", "6": "b", "9": "g", "3": "e", "2": "z"}


def misread_words(words: DataFrame) -> DataFrame:
    """Words to repair (word, meant, n_meant, exact): rare ones beside a frequent one at a weighted distance of one edit.

    Both words and their one-letter deletions go into one index; words that meet there are one edit apart. A respelling by
    letters that are taken for each other (exact) counts as such an edit, also where it changes two letters.
    """
    total = words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.length("word").between(3, 40))

    def index(batches):
        for batch in batches:
            out = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                near = {word} | {word[:k] + word[k + 1 :] for k in range(len(word))}
                out += [(x, word, n, False) for x in near] + [(x, word, n, True) for x in _respelled(word) - near]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["entry", "word", "n", "respelled"])

    entries = total.mapInArrow(index, "entry string, word string, n long, respelled boolean")
    frequent = entries.filter((F.col("n") >= RATIO) & ~F.col("respelled")).select("entry", F.col("word").alias("meant"), F.col("n").alias("n_meant"))
    met = entries.join(frequent, "entry").filter((F.col("word") != F.col("meant")) & (F.col("n_meant") >= RATIO * F.col("n")))
    exact = F.col("respelled") & (F.col("entry") == F.col("meant"))
    near = ~F.col("respelled") & (F.levenshtein("word", "meant") <= 1) & (F.length("word") >= 4)
    cost = F.when(exact, 0.4).otherwise(1.0)
    return met.filter(exact | near).groupBy("word").agg(F.max_by(F.struct("meant", "n_meant", exact.alias("exact")), F.struct(-cost, "n_meant")).alias("x")).select("word", "x.meant", "x.n_meant", "x.exact")


class Repairs:
    """What to look for in the texts: contexts, words and the neighbours that confirm a word, and compounds' first parts."""

    def __init__(self, keys: np.ndarray, meant: np.ndarray, words: dict[str, tuple[str, bool]], follows: set[tuple[str, str]], heads: set[str]):
        order = np.argsort(keys)
        self.keys, self.meant, self.words, self.follows, self.heads = keys[order], meant[order], words, follows, heads

    def only(self, keys: np.ndarray, words: set[str]) -> "Repairs":
        """Those that these contexts (sorted) and words may need; a word and what may follow it are in one part."""
        kept = np.isin(self.keys, keys)
        meant = {w: self.words[w] for w in words if w in self.words}
        after = {m for m, _ in meant.values()}
        return Repairs(self.keys[kept], self.meant[kept], meant, {f for f in self.follows if f[0] in after and (not f[1] or f[1] in words)}, self.heads)

    def in_contexts(self, texts: list[str]) -> dict[int, list[tuple[int, int]]]:
        """For each text with misread ideographs their (place in it, meant), by the text's place."""
        out: dict[int, list[tuple[int, int]]] = {}
        if not len(self.keys):
            return out
        key, text, at = _contexts(texts)
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        for k in np.flatnonzero(self.keys[place] == key):
            out.setdefault(int(text[k]), []).append((int(at[k]), int(self.meant[place[k]])))
        return out

    def word(self, found: list[str], k: int, first: bool) -> str | None:
        """The word meant by the k-th of a line's words, if it is misread. Where it may be the rest of a cut word (first in its line) or differs by other letters than those taken for each other, its neighbour must confirm it."""
        meant, exact = self.words.get(found[k].lower(), (None, False))
        if meant and not exact and first:
            return None
        if meant and (first or not exact) and (meant, found[k + 1].lower() if k + 1 < len(found) else "") not in self.follows:
            return None
        return meant


class Together(Repairs):
    """The repairs of all parts, as far as they were asked for: what is asked is noted and looked up in the parts between two runs."""

    def __init__(self, heads: set[str]):
        super().__init__(np.empty(0, np.int64), np.empty(0, np.int64), {}, set(), heads)
        self.asked_texts, self.asked_words = set(), set()

    def in_contexts(self, texts: list[str]) -> dict[int, list[tuple[int, int]]]:
        self.asked_texts.update(texts)
        return super().in_contexts(texts)

    def word(self, found: list[str], k: int, first: bool) -> str | None:
        self.asked_words.update(w.lower() for w in found)
        return super().word(found, k, first)

    def add(self, part: Repairs) -> None:
        new = ~np.isin(part.keys, self.keys)
        keys, meant = np.r_[self.keys, part.keys[new]], np.r_[self.meant, part.meant[new]]
        order = np.argsort(keys)
        self.keys, self.meant = keys[order], meant[order]
        self.words |= part.words
        self.follows |= part.follows


def _held(shared):
    """The value of a broadcast part, which is not kept where it can be loaded again."""
    part = shared.value
    if getattr(shared, "_path", None):
        shared.__dict__.pop("_value", None)
    return part


def with_all(shared: list, run):
    """run(repairs) with the repairs of all parts (broadcast), of which one is held at a time."""
    if len(shared) == 1:
        return run(shared[0].value)
    together = Together(_held(shared[0]).heads)
    texts, words = set(), set()
    while True:
        result = run(together)
        if together.asked_texts <= texts and together.asked_words <= words:
            return result
        texts |= together.asked_texts
        words |= together.asked_words
        keys = np.unique(_contexts(sorted(texts))[0])
        for part in shared:
            together.add(_held(part).only(keys, words))


def furniture(text: str, placed: bool = False) -> tuple[list[tuple[int, int, str]], bool, bool]:
    """(spans, header?, page number?) of the page furniture in a text, by lines and, in run-together text, between blanks. placed: the text is a page's own lines, told from furniture by their place: it is not run together, and bare numbers are content."""
    spans, header, page = [], False, False
    lined, start = "\n" in text, 0
    for line in text.split("\n"):
        end = start + len(line)
        if _PAGE_LINE.match(line) and not (placed and _BARE_LINE.match(line)):
            spans.append((start, end, "page_number"))
            page = True
        elif _CUE.search(line):
            if m := _HEADER_LINE.match(line):
                core = _HEADER.search(line)
                spans.append((start, end, "header"))
                header = True
                rest = (line[: core.start()] + " " + line[core.end() :]).strip()
                page |= bool(rest) and bool(_PAGE_LINE.match(rest))
            elif not lined:
                for m in _HEADER.finditer(line):
                    a, b = m.span()
                    if (a == 0 or line[a - 1].isspace()) and (b == len(line) or line[b].isspace()):
                        spans.append((start + a, start + b, "header"))
                        header = True
                        for side, part, at in ((0, line[b:], start + b), (1, line[:a], start)):
                            if (m2 := _PAGE_NEXT[side].search(part)) and not re.match(r"\s*[\dl]+\s?(?:mL|kg|km|cm|m/s|[mgLVAWJ℃]|个|件)", part[m2.start() :]):
                                spans.append((at + m2.start(), at + m2.end(), "page_number"))
                                page = True
        if not lined and not placed:
            for m in [*_PAGE_RUN.finditer(line), *_BARE_RUN.finditer(line)]:
                spans.append((start + m.start(), start + m.end(), "page_number"))
                page = True
        start = end + 1
    return spans, header, page


def _bad_number(text: str) -> bool:
    if not _DIGIT_LIKE.search(text):
        return False
    for m in _NUMBER.finditer(text):
        token = m[0]
        if any(c in DIGITS for c in token) and re.fullmatch(r"[\d.lIOoZSBG]+", token):
            if any(c.isdigit() for c in token):
                return True
    return False


def examine(texts: list[str | None], repairs: Repairs, placed: list[bool] | None = None) -> list[list[str]]:
    """The kinds of noise in each text: header, page_number, hyphen, misread. placed: of each text, as for ``furniture``; none, if not given."""
    given = [t or "" for t in texts]
    by_context = repairs.in_contexts(given)
    out = []
    for k, text in enumerate(given):
        kinds = []
        if not text:
            out.append(kinds)
            continue
        odd = by_context.get(k, ())
        fixed = text
        for at, meant in odd:
            fixed = fixed[:at] + chr(meant) + fixed[at + 1 :]
        spans, header, page = furniture(fixed, bool(placed and placed[k]))
        if header:
            kinds.append("header")
        if page:
            kinds.append("page_number")
        body = text
        for a, b, _ in sorted(spans, reverse=True):
            body = body[:a] + body[b:]
        if "-" in text and any(m[1].lower() not in repairs.heads and m[1].lower() not in ("", "page") for m in _HYPHEN.finditer(text if not spans else body + "")):
            kinds.append("hyphen")
        if body.strip():
            misread = bool(_PRIVATE.search(body))
            if not misread and odd:
                misread = not spans or bool(repairs.in_contexts([body]))
            misread = misread or _bad_number(body)
            if not misread and _LETTERS.search(body):
                for line in (re.sub(r"-[ \t]*\n|(?<=[a-z])- (?=[a-z])", "\x02", body) if "-" in body else body).split("\n"):
                    for at, stretch in _wordy(line):
                        found = [*_TOKEN.finditer(stretch)]
                        words = [m[0] for m in found]
                        for j, m in enumerate(found):
                            if not repairs.word(words, j, j == 0 and not line[:at].strip()):
                                continue
                            if "\x02" not in stretch[max(0, m.start() - 1) : m.end() + 1] and not (j == len(found) - 1 and stretch.rstrip().endswith("-")):
                                misread = True
                                break
            if misread:
                kinds.append("misread")
        out.append(kinds)
    return out


def learn(texts: DataFrame) -> list[Repairs]:
    """The repairs that the corpus (text) supports, in as many parts as it takes for none to hold more than MAX_FORMS forms.

    A word and the neighbours that confirm it are in one part, by the word meant. The first parts of compounds are needed in all;
    more than MAX_FORMS of them are refused.
    """
    contexts, words = count_forms(texts)
    bad, spelled = cut(misread_contexts(contexts)), cut(misread_words(words))
    follows = cut(words.select(F.col("word").alias("meant"), "following", "n").filter("n >= 2").join(spelled.select("meant").distinct(), "meant", "left_semi").select("meant", "following"))
    compounds = words.filter("word rlike '^[a-z]{2,}-[a-z]{2,}$'").groupBy("word").agg(F.sum("n").alias("n")).filter("n >= 3")
    heads = {r[0] for r in compounds.select(F.substring_index("word", "-", 1)).distinct().limit(MAX_FORMS + 1).collect()}
    if len(heads) > MAX_FORMS:
        raise ValueError(f"more than {MAX_FORMS} first parts of compounds")
    parts = max(1, *(-(-table.count() // MAX_FORMS) for table in (bad, spelled, follows)))
    out = []
    for k in range(parts):
        own = lambda table, key, k=k: table.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == k).toArrow()
        rows, table, after = own(bad, "key"), own(spelled, "meant"), own(follows, "meant")
        meant = dict(zip(table.column("word").to_pylist(), zip(table.column("meant").to_pylist(), table.column("exact").to_pylist())))
        out.append(Repairs(rows.column(0).to_numpy(), rows.column(1).to_numpy(), meant, set(zip(after.column(0).to_pylist(), after.column(1).to_pylist())), heads))
    return out


def _chunks(batches, parts: int):
    """Columns of 2,000 rows at a time; of whole batches if several parts are to be loaded for each."""
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        size = 2000 if parts == 1 else max(1, batch.num_rows)
        for a in range(0, batch.num_rows, size):
            yield [c[a : a + size] for c in columns]


#: Blanks that a line's form leaves out.
_BLANKS = " \t\u3000\xa0\u2002\u2003\u2009\u202f\u200b"
#: Page numbers as forms, where "of" shows what its letter is read for.
_PAGE_FORM = r"^(—#—|-#-|–#–|第#页([,，/]?共#页)?|\[#\]|·#·|[Pp]age#(f#)?|[Pp]\.?#|#/#|#)$"


def line_form(text: Column) -> Column:
    """A line without blanks, its numbers (and what scanners read for digits) as one sign: equal for the headers of all pages of a running title. Plain replacements, so it costs little a line."""
    digits = "0123456789" + "".join(DIGITS)
    form = F.translate(text, digits + _BLANKS, "#" * len(digits))
    for _ in range(4):  # runs of up to sixteen
        form = F.replace(form, F.lit("##"), F.lit("#"))
    return form


def page_furniture(lines: DataFrame, least: int = 4, share: float = 0.9) -> DataFrame:
    """(id, kind) of the lines (id, doc_id, page, pos, text) that repetition and place tell to be furniture of pages.

    header: a form that stands on at least so many pages, and by this share of its occurrences among the first or last two
    lines of a page, belongs to no content; forms of fewer than three letters are not meant. page_number: a bare number among
    those lines that counts with the pages, at the distance from the page's own number that is usual in the document; any other
    bare number is content. Lines without a page or place are none. One window a page, then partial aggregations.
    """
    placed = lines.filter("id is not null and doc_id is not null and page is not null and pos is not null").select("id", "doc_id", "page", "pos", line_form(F.col("text")).alias("form"), F.when(F.length("text") <= 12, F.col("text")).alias("short"))
    page = Window.partitionBy("doc_id", "page")
    placed = placed.withColumn("a", F.dense_rank().over(page.orderBy("pos"))).withColumn("edge", (F.col("a") <= 2) | (F.col("a") >= F.max("a").over(page) - 1))
    placed = cut(placed.dropDuplicates(["doc_id", "page", "pos", "id"]).filter("form is not null").select("id", "doc_id", "page", "form", "short", "edge"))
    # which forms are titles is asked of each form once
    forms = placed.groupBy("form").agg(F.count("*").alias("n"), F.count_if("edge").alias("at_edge")).filter((F.col("n") >= least) & (F.col("at_edge") >= share * F.col("n")))
    forms = forms.filter(~F.col("form").rlike(_PAGE_FORM) & (F.length(F.regexp_replace("form", r"[^\p{L}]", "")) >= 3)).select("form")
    headers = placed.filter("edge").select("id", "form").join(forms, "form", "left_semi").select("id", F.lit("header").alias("kind"))
    number = F.translate(F.trim("short"), "".join(DIGITS), "".join(DIGITS.values())).try_cast("int")
    numbers = placed.filter("edge and form = '#'").filter(F.col("short").rlike(_BARE_LINE.pattern)).select("id", "doc_id", (number - F.col("page")).alias("off")).filter("off is not null")
    usual = numbers.groupBy("doc_id", "off").agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.max_by(F.when(F.col("n") > 1, F.col("off")), F.struct("n", -F.abs("off"))).alias("usual"))
    counted = numbers.join(usual, "doc_id").filter(F.col("off") == F.coalesce("usual", F.lit(0))).select("id", F.lit("page_number").alias("kind"))
    return cut(headers.unionByName(counted).distinct())


def _with_place(texts: DataFrame) -> DataFrame:
    placed = F.coalesce("placed", F.lit(False)) if "placed" in texts.columns else F.lit(False)
    return texts.select("src", "id", "text", placed.alias("placed"))


def find_noise(texts: DataFrame, repairs: list[Repairs], furniture_lines: DataFrame | None = None) -> DataFrame:
    """Rows (src, id, kind), each once, of the noise in texts (src, id, text, placed). Null and empty texts have none.

    placed: whether the text is a line whose place on its page is known (false where the column is missing): a bare number
    there is a page number only if furniture_lines says so. furniture_lines: (src, id, kind) of lines known to be furniture as
    a whole; such a line holds no body text, so it is not hyphenated or misread.
    """
    shared = [texts.sparkSession.sparkContext.broadcast(part) for part in repairs]

    def look(batches):
        for src, ids, values, placed in _chunks(batches, len(shared)):
            kinds = with_all(shared, lambda known: examine(values, known, placed))
            out = [(s, i, kind) for s, i, ks in zip(src, ids, kinds) for kind in ks]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["src", "id", "kind"])

    found = _with_place(texts).filter("text <> '' and id is not null").mapInArrow(look, "src string, id string, kind string")
    if furniture_lines is not None:
        told = furniture_lines.select("src", "id", "kind")
        known = told.select("src", "id", F.lit(True).alias("known")).distinct()
        found = found.join(known, ["src", "id"], "left").filter("known is null or kind in ('header', 'page_number')").drop("known").unionByName(told)
    return found.distinct()


def _in_place(texts: list[str], repairs: Repairs) -> list[str]:
    """The texts with misread ideographs, digits, symbols and words replaced, until none is left to repair; a mended neighbour may confirm the next. Only texts that change are looked at again."""
    texts, seen = [*texts], [set() for _ in texts]
    active = [*range(len(texts))]
    while active:
        found = repairs.in_contexts([texts[k] for k in active])
        changed = []
        for i, k in enumerate(active):
            before = text = texts[k]
            for at, meant in found.get(i, ()):
                text = text[:at] + chr(meant) + text[at + 1 :]
            if not text.isascii():
                text = _PRIVATE.sub(lambda m: GLYPHS.get(m[0], ""), text)
            if _DIGIT_LIKE.search(text):
                text = _NUMBER.sub(lambda m: "".join(DIGITS.get(c, c) for c in m[0]) if any(c in DIGITS for c in m[0]) and re.fullmatch(r"[\d.lIOoSZBG]+", m[0]) else m[0], text)
            if _LETTERS.search(text):
                text = "\n".join(_in_words(line, repairs) for line in text.split("\n"))
            if text != before:
                seen[k].add(before)
                texts[k] = text
                if text not in seen[k]:
                    changed.append(k)
        active = changed
    return texts


#: What a misread number holds at least.
_DIGIT_LIKE = re.compile(r"[lIOoSZBG][\d.]|[\d.][lIOoSZBG]")


def _in_words(line: str, repairs: Repairs) -> str:
    """The line with its misread words replaced, last to first; a word cut by a hyphen stays."""
    for at, stretch in reversed(_wordy(line)):
        found = [*_TOKEN.finditer(stretch)]
        words = [m[0] for m in found]
        for k in range(len(found) - 1, -1, -1):
            m = found[k]
            meant = repairs.word(words, k, k == 0 and not line[:at].strip())
            if not meant:
                continue
            begin, end = at + m.start(), at + m.end()
            if not (re.match(r"-\s*$|-[ \t]*(?=\n)|- (?=[a-z])", line[end:]) or re.search(r"[a-z]- $", line[:begin])):
                words[k] = meant.upper() if m[0].isupper() and len(m[0]) > 1 else meant.capitalize() if m[0][0].isupper() else meant
                line = line[:begin] + words[k] + line[end:]
    return line


def repaired(text: str | None, repairs: Repairs, placed: bool = False) -> str | None:
    """``repaired_all`` of one text."""
    return repaired_all([text], repairs, [placed])[0]


def repaired_all(texts: list[str | None], repairs: Repairs, placed: list[bool] | None = None) -> list[str | None]:
    """The texts as continuous paragraphs: furniture dropped, cut words joined, lines joined, misread characters and words repaired wherever ``examine`` finds them; private-use symbols become the signs they show or are dropped.

    A line that ends a sentence before a shorter or blank line ends a paragraph; null stays null. placed: as for ``examine``.
    """
    given = [t or "" for t in texts]
    found = repairs.in_contexts(given)
    bodies = []
    for k, text in enumerate(given):
        for at, meant in found.get(k, ()):
            text = text[:at] + chr(meant) + text[at + 1 :]
        for a, b, _ in sorted(furniture(text, bool(placed and placed[k]))[0], reverse=True):
            whole = (a == 0 or text[a - 1] == "\n") and text[b : b + 1] == "\n"
            text = text[:a] + text[b + whole :]
        if "-" in text:
            text = re.sub(r"(?<=[^\W\d_])-[ \t]*\n(?=[a-z])|(?<=[a-z])- (?=[a-z])", lambda m: "-" if text[: m.start()].rpartition(" ")[2].rpartition("\n")[2].lower() in repairs.heads else "", text)  # noqa: B023
        bodies.append(text)
    # lines joined show words and neighbours whole
    joined = [re.sub(r"(?<=[^\x00-\x7f]) (?=[^\x00-\x7f])", "", _paragraphs(text)).strip() for text in _in_place(bodies, repairs)]
    return [None if t is None else new.strip() for t, new in zip(texts, _in_place(joined, repairs))]


def _paragraphs(text: str) -> str:
    """Lines joined into paragraphs."""
    lines = [x.strip() for x in text.split("\n")]
    width = max(map(len, lines), default=0)
    out: list[str] = []
    last = ""
    for k, line in enumerate(lines):
        if not line:
            if out and last != "\n":
                out.append("\n")
                last = "\n"
            continue
        if last and last != "\n" and last.isascii() and line[0].isascii() and (last.isalpha() or last in ",.;:?!"):
            out.append(" ")
        out.append(line)
        last = line[-1]
        if k + 1 < len(lines) and re.search(r"[。！？!?.．]$", line) and len(line) < 0.7 * width:
            out.append("\n")
            last = "\n"
    return "".join(out)


def repair(texts: DataFrame, repairs: list[Repairs]) -> DataFrame:
    """texts (src, id, text, placed) as (src, id, repaired), by the repairs of all parts together."""
    shared = [texts.sparkSession.sparkContext.broadcast(part) for part in repairs]

    def mend(batches):
        for src, ids, values, placed in _chunks(batches, len(shared)):
            out = with_all(shared, lambda known: repaired_all(values, known, placed))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (src, ids, out)], names=["src", "id", "repaired"])

    return _with_place(texts).mapInArrow(mend, "src string, id string, repaired string")
