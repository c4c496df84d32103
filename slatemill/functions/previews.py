"""Previews of questions: cleaning, statistics, noise, readability, scores and the choice among candidates. Word lists are fixed values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from slatemill.functions import text as T

STOPS = ("【答案】", "【分析】", "【解答】", "【点评】", "答案：", "分析：", "解：")
CUES = "已知|如图|下列|则|求|设|若|满足|函数|方程|不等式|向量|中点|共面"
PATTERNS = {"cjk": r"[\x{4e00}-\x{9fff}]", "latin": "[A-Za-z]", "digit": "[0-9]", "pua": r"[\x{e000}-\x{f8ff}]", "math": r"[=+\-*/^<>≤≥(){}\[\]|_]", "option": "[A-D][．.、]", "noise": r"[\x{fffd}\x{f03e}\x{f0d7}\x{f051}\x{f05c}\x{f0b4}\x{f0b8}]"}
LEAD = r"^[0-9]+\s*[．.]"


def let(x: Column, f) -> Column:
    """f(x) with x computed once, however often f uses it: the element is bound as a lambda's variable."""
    return F.element_at(F.transform(F.array(x), f), 1)


def stats(x) -> dict[str, Column]:
    """Counts in the normalized text; ``length`` with them."""
    clean = T.norm(x)
    return {"length": F.length(clean).cast("long")} | {k: F.regexp_count(clean, F.lit(p)).cast("long") for k, p in PATTERNS.items()}


def excerpt(x) -> Column:
    """The text up to the first stop marker that is not at its beginning, without signs at the end."""

    def cut(clean):
        at = [F.when(F.instr(clean, m) > 1, F.instr(clean, m) - 1) for m in STOPS]
        return F.trim(F.regexp_replace(F.substring(clean, F.lit(1), F.coalesce(F.least(*at), F.length(clean))), r"[，,；;：:。.\s]+$", ""))

    return let(T.norm(x), cut)


def cleaned(x) -> Column:
    """A candidate without glyphs and bullets, cut at answers, from its question number on, with blanks as signs want them."""

    def from_lead(text):
        mark = F.regexp_extract(text, r"[0-9]+\s*[．.]", 0)
        lead = F.when(mark != "", F.instr(text, mark)).otherwise(0)
        return F.when((lead > 0) & (lead <= 81), F.substring(text, lead, F.length(text))).otherwise(text)

    out = let(excerpt(F.regexp_replace(T.norm(x), r"[\x{e000}-\x{f8ff}•◆◇■□]", " ")), from_lead)
    for pattern, new in ((r"\s+([，。；：！？）】》])", "$1"), (r"([（【《])\s+", "$1"), (r"\s+([A-D])\s*[．.]", " $1．"), (r"(^|[^0-9A-Za-z_])[0-9]{1,3}\s*$", "$1"), (r"\s+", " ")):
        out = F.regexp_replace(out, pattern, new)
    return F.trim(out)


def noisy(x) -> Column:
    """Whether a preview is empty, short, sparse, heavy with signs or holds glyphs."""
    s = stats(x)
    other = s["length"] - s["cjk"] - s["latin"] - s["digit"]
    return (
        (s["length"] < 10) | (s["noise"] >= 1) | (s["pua"] >= 1) | ((s["cjk"] <= 8) & (s["length"] >= 24)) | ((s["length"] >= 32) & (other > 0.24 * s["length"]) & (s["cjk"] < 20))
        | ((s["length"] >= 48) & (s["math"] >= 7) & (s["cjk"] < 48)) | ((s["option"] >= 3) & (s["math"] >= 6) & (s["cjk"] < 48)) | ((s["option"] >= 2) & (s["math"] >= 4) & (s["cjk"] < 56))
    )


def noisy_summary(x) -> Column:
    """The stricter rule for summaries: glyphs, hardly any ideographs, many signs or formulas."""
    s = stats(x)
    other = s["length"] - s["cjk"] - s["latin"] - s["digit"]
    return (s["length"] == 0) | T.norm(x).contains("\ufffd") | (s["pua"] >= 1) | ((s["cjk"] <= 8) & (s["length"] >= 24)) | ((s["length"] >= 32) & (other > 0.24 * s["length"]) & (s["cjk"] < 20)) | ((s["length"] >= 48) & (s["math"] >= 7) & (s["cjk"] < 48))


def noisy_export(x) -> Column:
    """The looser rule for exports; a run of six spaced signs is noise too."""
    s, clean = stats(x), T.norm(x)
    other = s["length"] - s["cjk"] - s["latin"] - s["digit"]
    operators = F.regexp_count(clean, F.lit(r"[=+\-*/^<>]"))
    runs = clean.rlike(r"([=+\-*/^(){}\[\]<>_.,:;|\\]+(\s+|$)){6,}")
    return (s["length"] == 0) | (s["pua"] >= 1) | runs | ((s["cjk"] <= 8) & (s["latin"] + s["digit"] + other > 40)) | ((s["length"] >= 48) & (other > 0.42 * s["length"]) & (s["cjk"] < 16)) | ((s["length"] >= 72) & (operators >= 10) & (s["cjk"] <= 36))


def readable(x, source) -> Column:
    """Whether an excerpt reads as a question."""
    s, clean = stats(x), T.norm(x)
    dense = ((s["length"] >= 20) & (s["cjk"] >= 8)) | ((T._c(source) == "ocr_fallback") & (s["length"] >= 18) & (s["cjk"] >= 6))
    return (s["noise"] == 0) & (s["pua"] == 0) & dense & (clean.rlike(LEAD) | clean.rlike(CUES) | clean.rlike(r"A[．.]|（\s*.*\s*）"))


def score(x, source) -> Column:
    s, clean = stats(x), T.norm(x)
    bonus = F.when(clean.rlike(LEAD), 24).otherwise(0) + F.when(clean.rlike(CUES), 20).otherwise(0) + F.when(T._c(source) == "pdf_text_layer", 6).when(T._c(source) == "ocr_fallback", 4).otherwise(0)
    return (F.least(s["length"], F.lit(140)) + 3 * s["cjk"] - 80 * s["noise"] - 120 * s["pua"] - 2 * F.greatest(s["math"] - 18, F.lit(0)) + bonus).cast("long")


def best(candidates: list[tuple[str, Column]]) -> Column:
    """struct(score, clean, source) of the readable candidate with the highest score, the first of equals; null if none is readable."""

    def rated(k, source):
        return lambda clean: F.struct((-score(clean, F.lit(source))).alias("minus"), F.lit(k).alias("place"), clean.alias("clean"), F.lit(source).alias("source"), readable(clean, F.lit(source)).alias("ok"))

    made = F.array(*[let(cleaned(c), rated(k, s)) for k, (s, c) in enumerate(candidates)])
    chosen = F.try_element_at(F.array_sort(F.filter(made, lambda x: (x["clean"] != "") & x["ok"])), F.lit(1))
    return let(chosen, lambda first: F.when(first.isNotNull(), F.struct((-first["minus"]).alias("score"), first["clean"].alias("clean"), first["source"].alias("source"))))
