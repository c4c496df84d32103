"""Queries of the training-text operators, and their SQL twins where SQL can say the same."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slatemill.llm import leak, mixing, neardup, noise, pairs, splitting, textnorm
from slatemill.plans.cut import cut
from slatemill.sources.tables import read, spread

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _tagged(spark: SparkSession, d: str, *sources: tuple[str, str, str]) -> DataFrame:
    """src, id and text of several tables, one below the other."""
    out = None
    for table, key, text in sources:
        part = spread(read(spark, d, table, key, text)).select(F.lit(table).alias("src"), F.col(key).alias("id"), F.col(text).alias("text"))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- problem 6: look-alike text


def _lookalike_texts(spark: SparkSession, d: str) -> DataFrame:
    return _tagged(spark, d, ("task", "task_id", "stem"), ("ocr_lines", "line_id", "text"))


def _look_alike_keys(spark: SparkSession, d: str) -> DataFrame:
    texts = _lookalike_texts(spark, d)
    return cut(textnorm.canonical(texts, "text", textnorm.count_bigrams(texts, "text"), drop_text=True))


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return textnorm.look_alikes(_look_alike_keys(spark, d))


@query
def p6_classes(spark: SparkSession, d: str) -> DataFrame:
    """The records that look like others but differ, each with its class and its spelling."""
    return textnorm.look_alike_classes(_look_alike_keys(spark, d))


@query
def p6_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every text in its canonical form, once for each id."""
    texts = _lookalike_texts(spark, d)
    return textnorm.canonical(texts, "text", textnorm.count_bigrams(texts, "text")).select("src", "id", "canonical").distinct()


# ---------------------------------------------------------------- problem 4: broken pairs


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(read(spark, d, "task", "task_id", "stem", "answer", "explanation"))
    return pairs.defective_pairs(rows, "stem", {"answer": True, "explanation": False})


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("task_id", "field_name", F.col("defects")[0].alias("defect")).distinct()


@query
def p4_all_defects(spark: SparkSession, d: str) -> DataFrame:
    """Every defect that was triggered, with its rank among those of its pair."""
    return _pairs(spark, d).select("task_id", "field_name", F.posexplode("defects").alias("rank", "defect")).distinct()


# ---------------------------------------------------------------- problem 1: near duplicates


def _questions(spark: SparkSession, d: str) -> DataFrame:
    return _tagged(spark, d, ("coverage_set_review", "test_question_id", "question_text_ocr"), ("task_projection", "task_projection_id", "stem"))


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.pairs_within(neardup.near_duplicates(_questions(spark, d))[0])


@query
def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row for each record with its class, named by its least record, and the number of records in it."""
    return neardup.named_classes(neardup.near_duplicates(_questions(spark, d))[0])


#: All pairs by sets of three-character sequences, closed over likeness: what the operator must find, by brute force.
_ALIKE = r"""
WITH RECURSIVE t AS (SELECT 'coverage_set_review' AS src, test_question_id AS id, question_text_ocr AS x FROM coverage_set_review UNION ALL SELECT 'task_projection', task_projection_id, stem FROM task_projection),
b AS (SELECT DISTINCT src, id, regexp_replace(x, '[\x{9}-\x{d} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', '', 'g') AS x FROM t), r AS (SELECT * FROM b WHERE x <> ''), u AS (SELECT *, row_number() OVER (ORDER BY src, x) AS k FROM (SELECT DISTINCT src, x FROM r)),
g AS (SELECT src, k, unnest(list_distinct(list_transform(range(1, len(x) - 1), lambda i: substr(x, i, 3)))) AS g FROM u), n AS (SELECT k, count(*) AS n FROM g GROUP BY k), o AS (SELECT a.k AS a, b.k AS b, count(*) AS o FROM g a JOIN g b ON a.src = b.src AND a.g = b.g AND a.k < b.k GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.k = a JOIN n y ON y.k = b WHERE o * 10 >= (x.n + y.n - o) * 7), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), c AS (SELECT k AS k, k AS m FROM u UNION SELECT c.k, e.b FROM c JOIN e ON e.a = c.m), m AS (SELECT k, min(m) AS m FROM c GROUP BY k), w AS (SELECT r.src, r.id, m.m FROM r JOIN u ON u.src = r.src AND u.x = r.x JOIN m ON m.k = u.k)
"""
SQL["p1_found"] = _ALIKE + "SELECT DISTINCT a.src, a.id AS id_a, b.id AS id_b FROM w a JOIN w b ON a.src = b.src AND a.m = b.m AND a.id < b.id"
SQL["p1_classes"] = _ALIKE + ", d AS (SELECT DISTINCT src, id, m FROM w) SELECT src, id, min(id) OVER (PARTITION BY src, m) AS class_id, count(*) OVER (PARTITION BY src, m) AS n_records FROM d"


# ---------------------------------------------------------------- problem 7: leaking evaluation texts


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    items = read(spark, d, "heldout_blind", "heldout_question_id", "text").withColumnRenamed("heldout_question_id", "item_id")
    return leak.leaked_items(spread(read(spark, d, "documents", "doc_id", "text")), items)


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", F.col("item_id").alias("heldout_question_id"))


@query
def p7_passages(spark: SparkSession, d: str) -> DataFrame:
    """Each leak with the share of the item that the document holds, to three places."""
    return _leaks(spark, d).select("doc_id", F.col("item_id").alias("heldout_question_id"), F.round("share", 3).alias("share"), F.round("agreement", 3).alias("agreement"))


# ---------------------------------------------------------------- problem 8: mixing sources


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(spread(read(spark, d, "documents", "doc_id", "source", "text")), read(spark, d, "mix_target", "source", "target_share", "max_repeat"))


@query
def p8_records(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


@query
def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of each listed source."""
    return _mix(spark, d)[1].withColumns({"actual_share": F.round("actual_share", 6), "planned_tokens": F.round("planned_tokens", 3)})


@query
def p8_by_characters(spark: SparkSession, d: str) -> DataFrame:
    """The same mix by characters: what each source holds, what it is filled to, and whether the records chosen keep to it."""
    docs = read(spark, d, "documents", "doc_id", "source", "n_chars")
    records, report = mixing.mix(docs, read(spark, d, "mix_target", "source", "target_share", "max_repeat"), size="n_chars")
    largest = docs.groupBy("source").agg(F.max("n_chars").alias("largest"))
    chosen = records.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n_repeat")).alias("chosen"), F.max("n_repeat").alias("most"))
    joined = report.join(largest, "source", "left").join(chosen, "source", "left").fillna(0, ["chosen", "most", "largest"])
    kept = (F.col("chosen") <= F.col("planned_tokens") + 0.5) & (F.col("planned_tokens") - F.col("chosen") <= F.col("largest")) & (F.col("most") <= F.col("max_repeat"))
    return joined.select("source", "available_tokens", F.round("planned_tokens", 2).alias("planned"), kept.alias("kept"))


# in SQL the fill level is found in closed form: sources in the order of cap by weight, full as long as the level reaches their cap
SQL["p8_by_characters"] = """
WITH s AS (SELECT source, max(target_share) AS w, arg_max(max_repeat, target_share) AS r FROM mix_target WHERE source IS NOT NULL GROUP BY 1), h AS (SELECT source, sum(n_chars)::DOUBLE AS h FROM documents GROUP BY 1), c AS (SELECT s.source, w, coalesce(h, 0) AS held, coalesce(h, 0) * greatest(coalesce(r, 0), 0) AS cap FROM s LEFT JOIN h USING (source)),
t AS (SELECT sum(held) AS total FROM c), o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM c WHERE w > 0 AND cap > 0),
f AS (SELECT *, cap / w <= (total - before) / rest AS is_full, (total - before) / rest AS level FROM o, t), v AS (SELECT arg_min(level, cap / w) FILTER (WHERE NOT is_full) AS level FROM f)
SELECT c.source, c.held::BIGINT AS available_tokens, round(CASE WHEN f.source IS NULL THEN 0 ELSE least(f.cap, f.w * coalesce(v.level, 1e300)) END, 2) AS planned, true AS kept FROM c LEFT JOIN f USING (source), v
"""


# ---------------------------------------------------------------- problem 9: splitting


@query
def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_documents(spread(read(spark, d, "documents", "doc_id", "text")), read(spark, d, "split_setting", "setting_id", "max_tokens", "overlap_tokens"))


@query
def p9_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """Each document by each setting put together again from its pieces (itself, if it has none), and how many pieces break a rule: over the limit, no progress, a gap, or too little repeated."""
    settings = read(spark, d, "split_setting", "setting_id", "max_tokens", "overlap_tokens")
    docs = read(spark, d, "documents", "doc_id", "text")
    order = Window.partitionBy("doc_id", "setting_id").orderBy("piece_no")
    pieces = splitting.split_documents(docs, settings).join(F.broadcast(settings), "setting_id").withColumns({"before": F.lag("end").over(order), "begun": F.lag("begin").over(order)})
    fault = (F.col("n_tokens") > F.col("max_tokens")) & (F.length("piece") > 1) | (F.col("begin") > F.coalesce("before", F.lit(0))) | (F.col("begin") <= F.coalesce("begun", F.lit(-1))) | (F.col("end") <= F.coalesce("before", F.lit(0))) | ((F.col("overlap_tokens") > 0) & (F.col("begin") == F.col("before")))
    fresh = F.struct("piece_no", F.expr("substring(piece, coalesce(before, 0) - begin + 1)").alias("t"))
    whole = pieces.groupBy("doc_id", "setting_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(fresh)), lambda x: x["t"]), "").alias("rebuilt"), F.count_if(fault).alias("faults"))
    names = settings.agg(F.array_distinct(F.collect_list("setting_id")).alias("s")).first()[0]
    every = docs.select("doc_id", "text", F.explode(F.array(*map(F.lit, names))).alias("setting_id"))
    return every.join(whole, ["doc_id", "setting_id"], "left").select("doc_id", "setting_id", F.md5(F.coalesce("rebuilt", "text")).alias("text_md5"), F.coalesce("faults", F.lit(0)).alias("faults"))


SQL["p9_rebuilt"] = "SELECT doc_id, setting_id, md5(text) AS text_md5, 0::BIGINT AS faults FROM documents, (SELECT DISTINCT setting_id FROM split_setting)"


# ---------------------------------------------------------------- problem 2: noise of scanned pages


_WRITTEN = ("coverage_set_review", "test_question_id", "question_text_ocr"), ("split_questions", "question_id", "text_preview")


def _page_lines(spark: SparkSession, d: str) -> DataFrame:
    return spread(read(spark, d, "ocr_lines", F.col("line_id").alias("id"), "doc_id", "page", "pos", "text"))


def _scanned(spark: SparkSession, d: str) -> DataFrame:
    return _tagged(spark, d, ("ocr_lines", "line_id", "text"), *_WRITTEN).withColumn("placed", F.col("src") == "ocr_lines")


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    texts = _scanned(spark, d)
    told = noise.page_furniture(_page_lines(spark, d)).select(F.lit("ocr_lines").alias("src"), "id", "kind")
    return noise.find_noise(texts, noise.learn(texts), told).select("src", F.col("id").alias("row_id"), "kind")


@query
def p2_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every question text and preview as continuous paragraphs, and the lines of each scanned page likewise as one text, without its furniture."""
    lines = _page_lines(spark, d)
    body = lines.join(noise.page_furniture(lines), "id", "left_anti").select("doc_id", "page", "pos", "text").distinct()
    page = body.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n").alias("text"))
    pages = page.select(F.lit("ocr_lines").alias("src"), F.concat_ws(":", "doc_id", "page").alias("id"), "text", F.lit(True).alias("placed"))
    texts = pages.unionByName(_tagged(spark, d, *_WRITTEN).distinct().withColumn("placed", F.lit(False)))
    return noise.repair(texts, noise.learn(texts))
