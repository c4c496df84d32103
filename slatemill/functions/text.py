"""Scalar text functions: Column to Column, inside whole-stage codegen. Blanks are Unicode blanks; positions count from 1."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks as a class that Java's and RE2's dialects read alike.
WS = r"[\s\x{3000}\x{a0}]"
#: Words that name no topic. Fixed values.
STOP_TERMS = ("考点", "模块", "课次", "主题", "应用", "问题")
#: Markers of answer layers, in order of precedence. Fixed values.
ANSWER_MARKERS = ("【答案】", "【解析】", "【分析】", "【解答】", "【详解】", "【点评】", "【点拨】")
ANSWER_MARKERS_PAIRED = ("【答案】", "【解析】", "【分析】", "【详解】", "【解答】", "【解题思路】", "【解答过程】", "【点评】")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def norm(x) -> Column:
    """Runs of blanks as one blank, none at the ends; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(_c(x), F.lit("")), f"{WS}+", " "))


def clean_line(x) -> Column:
    """Without zero-width blanks and outer blanks; inner blanks and tabs as one blank."""
    bare = F.regexp_replace(F.regexp_replace(_c(x), r"\x{200b}", ""), f"^{WS}+|{WS}+$", "")
    return F.regexp_replace(bare, r"[ \t]+", " ")


def squeeze(x) -> Column:
    """Without any blank."""
    return F.regexp_replace(F.coalesce(_c(x), F.lit("")), f"{WS}+", "")


def prefix(x, n: int) -> Column:
    """The first n characters of the normalized text."""
    return F.substring(norm(x), 1, n)


def clip(x, n: int, mark: str = "...") -> Column:
    """At most n characters, followed by a mark where something was cut."""
    return F.when(F.length(_c(x)) > n, F.concat(F.rtrim(F.substring(_c(x), 1, n)), F.lit(mark))).otherwise(_c(x))


def useful_terms(*parts) -> Column:
    """The first eight different topic terms of the parts: runs without letters, digits and signs, two characters or more."""
    text = F.concat_ws(" ", *[norm(p) for p in parts])
    bare = F.regexp_replace(text, r"[A-Za-z0-9\s=+\-*/^（）()，,。．.、:：;；【】\[\]{}<>|]+", " ")
    terms = F.filter(F.split(F.trim(bare), " +"), lambda t: (F.length(t) >= 2) & ~t.isin(*STOP_TERMS))
    return F.slice(F.array_distinct(terms), 1, 8)


def slug(x, limit: int | None = None, default: str = "unknown") -> Column:
    """Lower case, runs of other signs than letters and digits as one underscore, none at the ends."""
    out = F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(_c(x), F.lit("")))), r"[^\p{L}\p{N}]+", "_"), "^_+|_+$", "")
    out = F.substring(out, 1, limit) if limit else out
    return F.when(out == "", default).otherwise(out)


def safe_name(x, limit: int = 80, default: str = "item") -> Column:
    """A file name: signs that file systems refuse and blanks as underscores."""
    out = F.substring(F.regexp_replace(F.regexp_replace(F.coalesce(_c(x), F.lit("")), r'[<>:"/\\|?*\s]+', "_"), "^_+|_+$", ""), 1, limit)
    return F.when(out == "", default).otherwise(out)


def checkpoint_name(x) -> Column:
    """A checkpoint's title without its number."""
    return F.regexp_replace(F.trim(_c(x)), r"^考点\s*\d+\s*[:：]?\s*", "")


def base_label(x) -> Column:
    """A label without the mark of a continuation."""
    return F.trim(F.regexp_replace(_c(x), "（续）|\\(续\\)", ""))


def answer_blocks(x) -> Column:
    """struct(stem, answer, explanation, markers) by the first occurrence of each marker.

    The stem ends at the first marker; a block runs to the next marker's first occurrence. explanation joins the other
    blocks that are not empty by line breaks, in order of position.
    """
    text = _c(x)
    found = F.array_sort(F.filter(F.array(*[F.struct(F.instr(text, m).alias("at"), F.lit(m).alias("marker")) for m in ANSWER_MARKERS]), lambda s: s["at"] > 0))
    ends = F.concat(F.transform(F.slice(found, 2, len(ANSWER_MARKERS)), lambda s: s["at"]), F.array(F.length(text) + 1))
    strip = lambda c: F.regexp_replace(c, f"^{WS}+|{WS}+$", "")
    blocks = F.zip_with(found, F.slice(ends, 1, len(ANSWER_MARKERS)), lambda s, e: F.when(s["at"].isNotNull(), F.struct(s["marker"].alias("marker"), strip(F.substring(text, s["at"] + F.length(s["marker"]), e - s["at"] - F.length(s["marker"]))).alias("body"))))
    blocks = F.filter(blocks, lambda b: b.isNotNull())
    answer = F.coalesce(F.element_at(F.transform(F.filter(blocks, lambda b: b["marker"] == "【答案】"), lambda b: b["body"]), 1), F.lit(""))
    rest = F.array_join(F.transform(F.filter(blocks, lambda b: (b["marker"] != "【答案】") & (b["body"] != "")), lambda b: b["body"]), "\n")
    stem = strip(F.when(F.size(found) > 0, F.substring(text, F.lit(1), F.element_at(found, 1)["at"] - 1)).otherwise(text))
    return F.struct(stem.alias("stem"), F.when(F.size(found) > 0, answer).otherwise("").alias("answer"), rest.alias("explanation"), F.transform(found, lambda s: s["marker"]).alias("markers"))


def answer_layers(x) -> Column:
    """array<struct<marker, body>> of every occurrence of every paired marker, in order; a body runs to the next marker."""
    marks = "|".join(ANSWER_MARKERS_PAIRED)
    parts = F.filter(F.split(_c(x), f"(?=(?:{marks}))"), lambda p: p.rlike(f"^(?:{marks})"))
    return F.transform(parts, lambda p: F.struct(F.regexp_extract(p, f"^(?:{marks})", 0).alias("marker"), F.regexp_replace(F.regexp_replace(p, f"^(?:{marks})", ""), f"^{WS}+|{WS}+$", "").alias("body")))


def joined_layers(layers: Column | str) -> Column:
    """array<struct<marker, body, n>>: the bodies of each marker of answer_layers joined by line breaks, the markers in their fixed order."""

    def bodies(marker: str) -> Column:
        return F.transform(F.filter(_c(layers), lambda x: x["marker"] == marker), lambda x: x["body"])

    own = [bodies(m) for m in ANSWER_MARKERS_PAIRED]
    return F.filter(F.array(*[F.struct(F.lit(m).alias("marker"), F.array_join(o, "\n").alias("body"), F.size(o).cast("long").alias("n")) for m, o in zip(ANSWER_MARKERS_PAIRED, own)]), lambda x: x["n"] > 0)


def normalize_answer(answer, stem) -> Column:
    """For a question with options the letter that the answer begins with, else the answer."""
    text = norm(answer)
    choice = _c(stem).rlike(r"（ +）") | _c(stem).rlike(r"(^|[^A-Za-z0-9_])A[．.]")
    letter = F.regexp_extract(text, r"^([A-D])([^A-Za-z0-9_]|$)", 1)
    return F.when(choice & (letter != ""), letter).otherwise(F.trim(_c(answer)))


#: Private-use glyphs of symbol fonts and the signs they show. Fixed values.
GLYPHS = {
    "\uf028": "(", "\uf029": ")", "\uf02b": "+", "\uf02d": "-", "\uf03c": "<", "\uf03d": "=", "\uf03e": ">", "\uf051": "∵", "\uf05c": "∴", "\uf084": "≤",
    "\uf085": "≥", "\uf0a3": "≤", "\uf0a5": "∞", "\uf0b1": "±", "\uf0b3": "≥", "\uf0b9": "≠", "\uf0ce": "∈", "\uf0d7": "·", "\uf0e6": "[", "\uf0e7": "(",
    "\uf0e8": "(", "\uf0e9": "(", "\uf0ea": "[", "\uf0eb": "{", "\uf0f6": "]", "\uf0f7": ")", "\uf0f8": ")", "\uf0f9": ")", "\uf0fa": "]", "\uf0fb": "}",
}


#: Full-width signs of formulas and the plain ones. Fixed values.
WIDE_SIGNS = {"＋": "+", "－": "-", "＝": "="}


def symbols(x) -> Column:
    """Private-use glyphs and full-width signs as the signs they show, other private-use glyphs dropped, runs of blanks and empty lines shortened."""
    signs = GLYPHS | WIDE_SIGNS
    out = F.regexp_replace(F.translate(_c(x), "".join(signs), "".join(signs.values())), r"[\x{f000}-\x{f8ff}]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def file_title(name) -> Column:
    """struct(number, title) of a lesson by its file's name: ``第 n 讲 title``, a leading outline number (0), or none."""
    bare = F.regexp_replace(_c(name), r"(（教师版）|\(教师版\)| - 教师版|教师版)?\.pdf$", "")
    spoken = F.regexp_extract(bare, r"第\s*(\d+)\s*讲\s*(.+)", 1)
    number = F.when(spoken != "", spoken.cast("int")).when(bare.rlike(r"^[0-9]+(\.[0-9]+)*\s*.+"), 0)
    return F.struct(number.alias("number"), norm(F.when(spoken != "", F.regexp_extract(bare, r"第\s*(\d+)\s*讲\s*(.+)", 2)).otherwise(bare)).alias("title"))


def percent(x) -> Column:
    """A share as a percentage with one decimal, half-way cases to the even digit."""
    return F.format_string("%.1f%%", F.bround(100 * _c(x), 1))


def escape_markup(x) -> Column:
    out = _c(x)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def without_number(x) -> Column:
    """A question without the number it was printed with, its signs made plain."""
    return F.regexp_replace(symbols(x), r"^[0-9]{1,2}[．.、]\s*", "")


def plain_inline(x) -> Column:
    """Inline markup as text: code without its marks, a link as its words and target."""
    return F.trim(F.regexp_replace(F.regexp_replace(_c(x), "`([^`]+)`", "$1"), r"\[([^\]]+)\]\(([^)]+)\)", "$1: $2"))


def inferred_title(lines: Column, fallback, brand: str = "领世") -> Column:
    """The first of the lines that is neither empty nor begins with a brand's name, else the fallback."""
    return F.coalesce(F.try_element_at(F.filter(lines, lambda x: (x != "") & ~x.startswith(brand)), F.lit(1)), _c(fallback))


def data_url(content, kind: str) -> Column:
    """Binary content as a data URL."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.regexp_replace(F.base64(_c(content)), r"[\r\n]", ""))  # base64 breaks lines


def section_of_key(x) -> Column:
    """The section that a key such as s3_q2 names, as text."""
    return F.regexp_replace(F.split_part(_c(x), F.lit("_"), F.lit(1)), "s", "")


#: Where a summary ends. Fixed values.
SUMMARY_STOPS = ("【答案", "答案", "【分析", "分析", "【解答", "解答", "点评")


def summary(x) -> Column:
    """The text up to the first stop that is not at its beginning, without signs at the end, from its question number on if that is near, without a last bare number."""
    clean = norm(x)
    end = F.least(*[F.when(F.instr(clean, m) > 1, F.instr(clean, m) - 1) for m in SUMMARY_STOPS], F.length(clean))
    kept = F.regexp_replace(F.substring(clean, F.lit(1), end), r"[\s,.;:，。；：、]+$", "")
    mark = F.regexp_extract(kept, r"[0-9]+\s*[．.]", 0)
    at = F.instr(kept, mark)
    cut = F.when((mark != "") & (at <= 81), F.substring(kept, at, F.length(kept))).otherwise(kept)
    return F.trim(F.regexp_replace(cut, r"(^|[^\p{L}\p{N}_])[0-9]{1,3}\s*$", "$1"))


def ends_summary(line, n_before, y_share) -> Column:
    """Whether an OCR line ends a summary: one with a stop, or one low on the picture, if there is text before it."""
    stop = F.lit(False)
    for m in SUMMARY_STOPS:
        stop = stop | _c(line).contains(m)
    return (_c(line) != "") & (_c(n_before) > 0) & (stop | (_c(y_share) > 0.72))
