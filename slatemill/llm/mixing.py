"""Mixing sources to target weights: capped water-filling and seeded whole and fractional repetitions."""

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slatemill.llm import tokenizer
from slatemill.plans.cut import cut

#: Sources that a mix may list; bounds what the plan broadcasts.
MAX_SOURCES = 10_000
BINS = 4096


def water_fill(weights: list[float], caps: list[float], total: float) -> list[float]:
    """Amounts in proportion to the weights, none above its cap, that add up to total (to all caps, if that is less).

    Sources that would exceed their cap are clamped and the excess goes to the others by weight, until none exceeds.
    Weights that are zero, negative or null get nothing.
    """
    amount = [0.0] * len(weights)
    open_ = [k for k, (w, c) in enumerate(zip(weights, caps)) if w and w > 0 and c > 0]
    left = total
    while open_:
        whole = sum(weights[k] for k in open_)
        share = {k: left * (weights[k] / whole) for k in open_}  # by proportions, which hold for the smallest weights as well
        full = [k for k in open_ if share[k] >= caps[k]]
        if not full:
            for k in open_:
                amount[k] = share[k]
            break
        for k in full:
            amount[k] = float(caps[k])
            left -= caps[k]
        open_ = [k for k in open_ if k not in set(full)]
        if left <= 0:
            break
    return amount


def token_sizes(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with ``text`` replaced by ``n_tokens``, its length in tokens of a public tokenizer (null and empty texts: 0)."""
    path = path or tokenizer.default_path()
    rest = [c for c in docs.columns if c not in ("text", "n_tokens")]

    def measure(batches):
        model = tokenizer.pieces(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            sizes = [len(x) for a in range(0, len(texts), 200) for x in model.encode(texts[a : a + 200])]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in rest), pa.array(sizes, pa.int64())], names=[*rest, "n_tokens"])

    return docs.mapInArrow(measure, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in rest) + ", n_tokens long")


def place(seed: int, *key: Column) -> Column:
    """A seeded place of a record in [0, 2^32), the same on every run and partitioning."""
    return F.xxhash64(F.lit(seed), *key).bitwiseAND(F.lit((1 << 32) - 1))


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 17, path: str | None = None, size: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, report) of documents (doc_id, source, text) mixed to targets (source, target_share, max_repeat).

    total: tokens wanted, by default as many as the listed sources hold. size: a column of docs that holds the sizes, instead of
    tokens of the text; null counts 0. records: (doc_id, source, n_tokens, n_repeat), one
    row for each record used at least once. Each is used the whole number of times that its source's amount fits in; for the
    rest the records of the least places are used once more, up to the one that would pass the amount, so a source is
    short of it by less than one record. No record is used more than max_repeat times. report: one row a listed source,
    with target and actual share (of all chosen tokens) and planned_tokens, the amount it was filled to. Unlisted and null sources are not used; a listed source without
    documents gets nothing and its weight goes to the others. Repeated rows of one doc_id count once; of a source listed
    twice the row with the largest share counts. An empty table gives no records.
    """
    listed = targets.select("source", F.col("target_share").cast("double").alias("target_share"), F.col("max_repeat").cast("long").alias("max_repeat")).filter("source is not null")
    plan = listed.groupBy("source").agg(F.max_by("max_repeat", "target_share").alias("max_repeat"), F.max("target_share").alias("target_share")).orderBy("source").limit(MAX_SOURCES + 1).collect()
    if len(plan) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources are listed")
    spark = docs.sparkSession
    names = F.broadcast(spark.createDataFrame([(r["source"],) for r in plan], "source string"))
    used = docs.filter("doc_id is not null").join(names, "source", "left_semi")
    sizes_of = token_sizes(used.select("doc_id", "source", "text"), path) if size is None else used.select("doc_id", "source", F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("n_tokens"))
    sized = cut(sizes_of.groupBy("doc_id", "source").agg(F.max("n_tokens").alias("n_tokens")))
    bins = sized.groupBy("source", F.shiftright(place(seed, F.col("doc_id")), 20).alias("bin")).agg(F.sum("n_tokens").alias("t"))
    bins = cut(bins)
    held = {r["source"]: r["t"] for r in bins.groupBy("source").agg(F.sum("t").alias("t")).collect()}
    sizes = [held.get(r["source"], 0) for r in plan]
    repeats = [max(0, r["max_repeat"] or 0) for r in plan]
    amounts = water_fill([r["target_share"] or 0.0 for r in plan], [float(s * m) for s, m in zip(sizes, repeats)], float(sum(sizes) if total is None else total))
    rows = [(r["source"], r["target_share"], r["max_repeat"], s, a, min(m, int(a / s + 1e-12)) if s else 0, a - min(m, int(a / s + 1e-12)) * s if s else 0.0) for r, s, m, a in zip(plan, sizes, repeats, amounts)]
    quota = F.broadcast(spark.createDataFrame(rows, "source string, target_share double, max_repeat long, available_tokens long, amount double, whole long, part double"))
    # the bin in which the partial amount ends: at most BINS rows a source are ordered, then only that bin's records
    order = Window.partitionBy("source").orderBy("bin")
    edges = bins.join(quota, "source").withColumn("until", F.sum("t").over(order)).withColumn("before", F.col("until") - F.col("t"))
    edge = edges.filter("before <= part and until > part").groupBy("source").agg(F.min("bin").alias("edge"), F.min_by("before", "bin").alias("before"))
    ends = F.broadcast(quota.select("source", "whole", "part").join(edge, "source", "left").withColumn("edge", F.coalesce("edge", F.lit(BINS))))
    placed = sized.withColumn("at", place(seed, F.col("doc_id"))).join(ends, "source").withColumn("bin", F.shiftright("at", 20))
    inside = placed.filter("bin < edge").select("doc_id", "source", "n_tokens", F.col("whole") + F.lit(1))
    beyond = placed.filter("bin > edge").select("doc_id", "source", "n_tokens", "whole")
    run = Window.partitionBy("source").orderBy("at", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    last = placed.filter("bin = edge").withColumn("upto", F.col("before") + F.sum("n_tokens").over(run)).select("doc_id", "source", "n_tokens", F.col("whole") + F.when(F.col("upto") <= F.col("part"), 1).otherwise(0))
    records = inside.union(beyond).union(last).toDF("doc_id", "source", "n_tokens", "n_repeat").filter("n_repeat > 0")
    used = records.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n_repeat")).alias("chosen_tokens"), F.sum("n_repeat").alias("n_uses"), F.max("n_repeat").alias("most_repeats"))
    chosen = quota.select("source", "target_share", "max_repeat", "available_tokens", F.col("amount").alias("planned_tokens")).join(used, "source", "left").fillna(0, ["chosen_tokens", "n_uses", "most_repeats"])
    report = chosen.withColumn("actual_share", F.col("chosen_tokens") / F.nullif(F.sum("chosen_tokens").over(Window.partitionBy(F.lit(1))), F.lit(0)))
    return records, report
