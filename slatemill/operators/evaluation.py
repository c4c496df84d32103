"""Evaluation of placements: gold rows against predicted candidates, hit rates at four levels, issues."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = {"knowledge_hit": "knowledge_id", "lesson_hit": "lesson_id", "module_hit": "module", "point_hit": "min_knowledge_point"}


def last_wins(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the last in the order; a partial aggregation, not a window over the group."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_x")).select(*key, "_x.*")


def blank_equal(a: Column, b: Column) -> Column:
    """Equality in which null, empty and blanks are one value."""
    return F.coalesce(F.trim(a), F.lit("")) == F.coalesce(F.trim(b), F.lit(""))


def hits(gold: DataFrame, predictions: DataFrame, catalog: DataFrame, strict: bool = False) -> DataFrame:
    """Gold rows (test_question_id, stage, grade, knowledge_id, lesson_id, module, min_knowledge_point) with predicted and the four flags of LEVELS.

    predictions: (test_question_id, knowledge_ids array, file, pos), the last of a question counts. A flag is true if any of
    the candidates agrees; unknown candidates have blank labels, and a blank label agrees with a blank one unless strict.
    Questions without a prediction have predicted false and all flags false; a null list has no candidates.
    """
    last = last_wins(predictions.select("test_question_id", "knowledge_ids", "file", "pos"), ["test_question_id"], [F.col("file"), F.col("pos")])
    labels = catalog.select(F.col("knowledge_id").alias("k"), *[F.col(c).alias(f"p_{c}") for c in ("lesson_id", "module", "min_knowledge_point")])
    named = last.select("test_question_id", F.explode_outer("knowledge_ids").alias("k")).withColumn("listed", F.col("k").isNotNull()).join(labels, "k", "left").withColumnRenamed("k", "p_knowledge_id")
    same = (lambda a, b: (a == b) & (F.trim(a) != "")) if strict else blank_equal
    flags = {flag: F.coalesce(F.col("listed") & same(F.col(f"p_{c}"), F.col(c)), F.lit(False)) for flag, c in LEVELS.items()}
    joined = gold.join(named.withColumn("predicted", F.lit(True)), "test_question_id", "left")
    keys = ["test_question_id", "stage", "grade", "knowledge_id", "lesson_id", "module", "min_knowledge_point"]
    return joined.groupBy(*keys).agg(F.max(F.coalesce("predicted", F.lit(False))).alias("predicted"), *[F.max(c).alias(f) for f, c in flags.items()])


def rates(scored: DataFrame, *by: str) -> DataFrame:
    """Questions, predicted ones and hit rates to four places, of all or of each group; an empty table has rates 0."""
    counted = [F.count("*").alias("n_questions"), F.count_if("predicted").alias("n_predicted")]
    rate = [F.round(F.coalesce(F.try_divide(F.count_if(f).cast("double"), F.count("*").cast("double")), F.lit(0.0)), 4).alias(f.replace("hit", "rate")) for f in LEVELS]
    return (scored.groupBy(*by) if by else scored).agg(*counted, *rate)


def issues(scored: DataFrame) -> DataFrame:
    """Questions without a full hit and what is wrong: missing_prediction, lesson_miss, module_miss, point_miss or id_mismatch."""
    kind = F.when(~F.col("predicted"), "missing_prediction").when(~F.col("lesson_hit"), "lesson_miss").when(~F.col("module_hit"), "module_miss").when(~F.col("point_hit"), "point_miss").when(~F.col("knowledge_hit"), "id_mismatch")
    return scored.withColumn("issue_type", kind).filter("issue_type is not null")


def leaking_terms(rows: DataFrame, terms: tuple[str, ...]) -> DataFrame:
    """(term, n_rows, in_names): in how many rows each term occurs in some column, and whether a column's name holds it; one scan for all terms."""
    x = F.concat_ws(" ", *[F.col(c).cast("string") for c in rows.columns])
    counts = rows.agg(*[F.count_if(x.contains(t)).alias(f"t{k}") for k, t in enumerate(terms)])
    listed = F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"t{k}").alias("n_rows"), F.lit(any(t in c for c in rows.columns)).alias("in_names")) for k, t in enumerate(terms)])
    return counts.select(F.explode(listed).alias("x")).select("x.*")


def placements(predictions: DataFrame, catalog: DataFrame, most: int = 3) -> DataFrame:
    """(prediction_id, rank, knowledge_id, lesson_title, module, confidence, reason, review_status) of the first candidates of each prediction.

    Only the first candidate keeps its own confidence, else ``medium``; labels come from the catalog and are empty where it has
    none; an empty status waits for a teacher. Null candidates keep their rank and give no row.
    """
    status = F.coalesce(F.nullif("review_status", F.lit("")), F.lit("needs_teacher_review"))
    rows = predictions.select("prediction_id", status.alias("review_status"), F.posexplode(F.slice("final_top3", 1, most)).alias("p", "x")).filter("x.knowledge_id is not null")
    first = F.col("p") == 0
    rows = rows.select("prediction_id", "review_status", (F.col("p") + 1).alias("rank"), F.col("x.knowledge_id").alias("knowledge_id"), F.when(first, F.coalesce(F.nullif("x.confidence", F.lit("")), F.lit("medium"))).otherwise("medium").alias("confidence"), F.when(first, "first").otherwise("alternative").alias("reason"))
    named = rows.join(catalog, "knowledge_id", "left")
    return named.select("prediction_id", "rank", "knowledge_id", F.coalesce("lesson_title", F.lit("")).alias("lesson_title"), F.coalesce("module", F.lit("")).alias("module"), "confidence", "reason", "review_status")


def top_distribution(predictions: DataFrame, first: Column, unmatched: str = "unmatched") -> DataFrame:
    """Counts of first candidates, the most frequent first; no candidate counts as unmatched."""
    counts = predictions.groupBy(F.coalesce(first, F.lit(unmatched)).alias("candidate")).agg(F.count("*").alias("n"))
    # only the different counts, far fewer than candidates, are ranked in one place
    ranks = counts.select("n").distinct().withColumn("rank", F.dense_rank().over(Window.orderBy(F.desc("n"))).cast("long"))
    return counts.join(ranks, "n").select("candidate", "n", "rank")
