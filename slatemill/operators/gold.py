"""Curation of gold questions: duplicate snippets, the ordered classifier, replenishing from pages, summaries with zero rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatemill.functions import rules as R
from slatemill.functions import text as T

STATUSES = ("USABLE_GOLD", "USABLE_WITH_REVIEW", "REVIEW_REQUIRED", "RE_CROP_REQUIRED")


def duplicate_counts(df: DataFrame, text: str, n: int = 160) -> DataFrame:
    """df with ``snippet`` (the first n characters, normalized) and how many rows share it; a blank snippet counts 0.

    The counts are aggregated first and joined back, so a snippet shared by many rows is no window in one task.
    """
    df = df.withColumn("snippet", T.prefix(text, n))
    counts = df.filter("snippet <> ''").groupBy("snippet").agg(F.count("*").alias("duplicate_count"))
    return df.join(counts, "snippet", "left").fillna(0, ["duplicate_count"])


def curate(df: DataFrame, evaluated: DataFrame) -> DataFrame:
    """Rows with (curation_status, priority, reason_code): the first rule that holds.

    df: test_question_id, question_text_ocr, selection_quality, status, duplicate_count; evaluated: test_question_id, point_hit, lesson_hit.
    """
    # all rules look at the beginning, which is made once
    df = df.withColumn("_head", T.prefix("question_text_ocr", 520))
    x = F.col("_head")
    marked, quality = R.question_marker(x), F.coalesce("selection_quality", F.lit(""))
    rules: list[tuple[Column, str]] = [
        ((F.coalesce("status", F.lit("")) != "ok") | (x == ""), "RE_CROP_REQUIRED|P0|no_text"),
        (R.navigation(x), "RE_CROP_REQUIRED|P0|navigation"),
        (F.col("duplicate_count") >= 3, "RE_CROP_REQUIRED|P0|shared_snippet"),
        (~marked, "REVIEW_REQUIRED|P1|no_question_marker"),
        (quality == "fallback_page_context", "REVIEW_REQUIRED|P1|fallback_page"),
        (F.col("point_hit").isNotNull() & ~F.col("point_hit") & F.col("lesson_hit"), "REVIEW_REQUIRED|P1|point_miss"),
        (F.col("point_hit").isNotNull() & ~F.col("point_hit"), "REVIEW_REQUIRED|P1|lesson_miss"),
        (quality == "nearby_question_match", "USABLE_WITH_REVIEW|P2|nearby_match"),
    ]
    verdict = F.split(R.choose(rules, "USABLE_GOLD|OK|gold"), r"\|")
    return df.join(evaluated, "test_question_id", "left").withColumn("_v", verdict).withColumns({"curation_status": F.col("_v")[0], "priority": F.col("_v")[1], "reason_code": F.col("_v")[2]}).drop("_v", "_head")


def zero_filled(df: DataFrame, status: str, statuses: tuple[str, ...], counts: dict[str, Column]) -> DataFrame:
    """One row for each listed status with its counts, 0 where it has no rows."""
    dim = df.sparkSession.createDataFrame([(s,) for s in statuses], f"{status} string")
    return dim.join(df.groupBy(status).agg(*[F.count_if(c).alias(n) for n, c in counts.items()]), status, "left").fillna(0, [*counts])


def pages_from(source: Column, last: Column, reach: int = 8) -> Column:
    """The pages from the source's on, as far as reach and the document go; none if the source is beyond it."""
    return F.when(source <= last, F.sequence(source, F.least(last, source + reach))).otherwise(F.array().cast("array<int>"))


def nested_sets(df: DataFrame, status: str, sets: dict[str, tuple[str, ...]]) -> DataFrame:
    """df with ``set_name``, a row for each set whose statuses it has; one pass, no union of scans."""
    names = F.array_compact(F.array(*[F.when(F.col(status).isin(*values), name) for name, values in sets.items()]))
    return df.withColumn("set_name", F.explode(names))


def grouped_summary(df: DataFrame, status: str, groups: list[str], statuses: tuple[str, ...] = ()) -> DataFrame:
    """Counts by status alone and by each group with status, in one pass of grouping sets: (group_name, group_value, status, n).

    Of all rows together each of the statuses has a row, 0 where there are none.
    """
    sets = [[F.col(status)], *[[F.col(g), F.col(status)] for g in groups]]
    out = df.groupingSets(sets, *groups, status).agg(F.count("*").alias("n"), *[F.grouping(g).alias(f"_{g}") for g in groups])
    name, value = F.lit("all"), F.lit("all")
    for g in groups:
        name, value = F.when(F.col(f"_{g}") == 0, g).otherwise(name), F.when(F.col(f"_{g}") == 0, F.coalesce(g, F.lit("None"))).otherwise(value)
    found = out.select(name.alias("group_name"), value.alias("group_value"), F.col(status).alias("status"), "n")
    if not statuses:
        return found
    empty = df.sparkSession.createDataFrame([(s,) for s in statuses], "status string").select(F.lit("all").alias("group_name"), F.lit("all").alias("group_value"), "status", F.lit(0).cast("long").alias("n"))
    return found.unionByName(empty).groupBy("group_name", "group_value", "status").agg(F.sum("n").alias("n"))


def page_score(terms: Column, text: Column, page: Column, source_page: Column) -> Column:
    """Score of a page for a knowledge point by the terms it holds, cues of questions and its distance."""
    hit = F.size(F.filter(terms, lambda t: text.contains(t)))
    far = F.least(F.abs(page - F.coalesce(F.nullif(source_page, F.lit(0)), F.lit(1))), F.lit(8))
    return (8 * hit + F.when(text.contains("例题"), 5).otherwise(0) + F.when(text.contains("强化训练"), 4).otherwise(0) + F.when(text.rlike(r"\d+\s*[．.、]"), 4).otherwise(0) - far).cast("long")


def heading_score(text: Column, target: Column, module: Column) -> Column:
    """Score of a page by the point and module it names, by headings, examples and answers, less aims and contents."""
    body, t, m = T.squeeze(text), T.squeeze(target), T.squeeze(module)
    score = F.when((t != "") & body.contains(t), 100).otherwise(0)
    score += F.when((F.coalesce(target, F.lit("")) != "") & F.regexp_like(text, F.concat(F.lit(r"考点\s*\d+\s*\Q"), F.coalesce(target, F.lit("")), F.lit(r"\E"))), 120).otherwise(0)
    score += F.when((m != "") & body.contains(m), 35).otherwise(0) + F.when(text.contains("考点"), 20).otherwise(0)
    score += F.when(text.rlike(r"(【\s*)?例\s*\d+"), 45).otherwise(0) + F.when(text.rlike("【答案】|【解答】|【分析】"), 10).otherwise(0)
    return (score - F.when(text.rlike("课程目标|知识导航") | F.substring(text, 1, 260).contains("知识导入"), 80).otherwise(0)).cast("long")


def replenish_status(method: Column, signal: Column) -> Column:
    """Whether a question taken from a page may be trusted, by how the page was found; one without a question's signal never."""
    return F.when(~F.coalesce(signal, F.lit(False)), "REPLENISHED_REVIEW_REQUIRED").when(method == "exact_min_point_page", "REPLENISHED_GOLD").when(method == "module_or_nearby_page", "REPLENISHED_WITH_REVIEW").otherwise("REPLENISHED_REVIEW_REQUIRED")


def page_method(score: Column) -> Column:
    """How a page was found, by its heading score."""
    return F.when(score >= 100, "exact_min_point_page").when(score >= 55, "module_or_nearby_page").when(score >= 25, "weak_nearby_page").otherwise("fallback_first_content_page")


def fallback_page(best: DataFrame, signals: DataFrame) -> DataFrame:
    """best (knowledge_id, page, score) with the page where a question is and the method it was found by.

    signals: (knowledge_id, other) of the pages that hold a question. A page without one gives way to the next or the one after,
    else, if it was found weakly, to the first page from the second on; one partial aggregation over the pages.
    """
    pages = best.withColumn("method", page_method(F.col("score"))).join(signals.select("knowledge_id", "other"), "knowledge_id", "left")
    first = lambda where: F.min(F.when(where, F.col("other")))
    near = F.col("other").isin(F.col("page") + 1, F.col("page") + 2)
    found = pages.groupBy("knowledge_id", "page", "method").agg(first(F.col("other") == F.col("page")).alias("here"), first(near).alias("near"), first(F.col("other") >= 2).alias("any"))
    weak = F.col("method").isin("fallback_first_content_page", "weak_nearby_page")
    return found.select(
        "knowledge_id",
        F.coalesce("here", "near", F.when(weak, F.col("any")), "page").cast("int").alias("page"),
        F.when(F.col("here").isNotNull(), F.col("method")).when(F.col("near").isNotNull(), "next_question_page_after_heading").when(weak & F.col("any").isNotNull(), "first_question_page_fallback").otherwise(F.col("method")).alias("method"),
    )


def best_of(candidates: DataFrame, key: list[str], score: Column, ties: list[Column]) -> DataFrame:
    """The candidate with the highest score for each key; of equals the one with the least ties. One partial aggregation."""
    rest = [c for c in candidates.columns if c not in key]
    return candidates.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(-score, *ties)).alias("_x")).select(*key, "_x.*")
