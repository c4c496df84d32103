"""Ordered scans: forward fill, segments, ranges, numbering, as-of joins and folds, without one task having to hold a group.

A group that may be large (a document with a tenth of all lines) is scanned in its pages: each page on its own, then one row
for each page, then the pages with what came before them.
"""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatemill.plans.cut import cut


def page_lines(lines: DataFrame) -> DataFrame:
    """lines (doc_id, page, pos, ...) with redelivered ones once, brought together page by page, which serves both the comparison and what follows by page."""
    return lines.repartition("doc_id", "page").dropDuplicates(["doc_id", "page", "pos"])


def forward_fill(df: DataFrame, group: list[str], part: str, order: list[str], value: Column, to: str) -> DataFrame:
    """df with the last value that is not null up to each row of its group, in the order of part, then of order.

    part: a column that cuts the group into runs in order (a page); only parts are ever held by one task. Rows before the
    first value get null. Rows with equal order are taken in an order that does not matter only if their values are equal.
    """
    inside = Window.partitionBy(*group, part).orderBy(*order)
    df = df.withColumn("_v", value)
    df = df.withColumn("_in", F.last("_v", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    last = df.groupBy(*group, part).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct(*order))).alias("_last"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    last = last.select(*group, part, F.last("_last", ignorenulls=True).over(before).alias("_before"))
    return df.join(last, [*group, part], "left").withColumn(to, F.coalesce("_in", "_before")).drop("_v", "_in", "_before")


def segment_number(df: DataFrame, group: list[str], part: str, order: list[str], starts: Column, to: str) -> DataFrame:
    """df with the number of segment starts up to each row of its group (0 before the first), scanned part by part."""
    inside = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_s", F.coalesce(starts.cast("int"), F.lit(0)))
    total = df.groupBy(*group, part).agg(F.sum("_s").alias("_t"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    total = total.select(*group, part, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    return df.withColumn("_in", F.sum("_s").over(inside)).join(total, [*group, part], "left").withColumn(to, (F.col("_in") + F.col("_before")).cast("long")).drop("_s", "_in", "_before")


def next_start(df: DataFrame, group: list[str], order: list[str], value: Column, end: Column, to: str) -> DataFrame:
    """Rows (already reduced to starts) with the value of the next start of the group, else end."""
    return df.withColumn(to, F.coalesce(F.lead(value).over(Window.partitionBy(*group).orderBy(*order)), end))


def nth(df: DataFrame, group: list[str], order: list, to: str) -> DataFrame:
    """df with each row's place, from 1, in its group."""
    return df.withColumn(to, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long"))


def first_or_later(df: DataFrame, group: str, key: str, to: str) -> DataFrame:
    """df with 1 for the row of the least key in its group (each key once) and 2 for all others: where only the first place counts, no group has to be ordered."""
    first = df.groupBy(group).agg(F.min(key).alias("_first")).withColumnRenamed(group, "_g")
    return df.join(first, df[group].eqNullSafe(first["_g"]), "left").withColumn(to, F.when(F.col(key) == F.col("_first"), 1).otherwise(2)).drop("_g", "_first")


def numbered(df: DataFrame, order: list[str], to: str = "row_no") -> DataFrame:
    """df with a gapless number from 1 in the order of the columns, over all rows, without bringing them to one task.

    Rows are ranged, each range is numbered on its own, and the sizes of the ranges before it (one number a range) are
    added. Equal rows get numbers in any order. Nulls come first. The empty table stays empty.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    starts = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s"))
    placed = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return ranged.withColumn("_r", placed).join(F.broadcast(starts), "_p").withColumn(to, (F.col("_r") + F.col("_s")).cast("long")).drop("_p", "_r", "_s")


def as_of(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """left with the values of the latest right row at or before each row's time (null if none), by one union and one window.

    Of right rows at one time the greatest values win, taken together. Null times match nothing.
    """
    pack = F.struct(*values)
    stream = left.withColumn("_t", F.col(left_time)).withColumn("_right", F.lit(1)).withColumn("_w", F.lit(None).cast(right.select(pack.alias("x")).schema[0].dataType))
    other = right.filter(F.col(right_time).isNotNull()).groupBy(*by, F.col(right_time).alias("_t")).agg(F.max(pack).alias("_w")).withColumn("_right", F.lit(0))
    both = stream.unionByName(other, allowMissingColumns=True)
    order = Window.partitionBy(*by).orderBy(F.col("_t").asc_nulls_first(), "_right").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_w", F.last("_w", ignorenulls=True).over(order)).filter("_right = 1")
    return found.select(*left.columns, *[F.when(F.col(left_time).isNotNull(), F.col("_w")[v]).alias(v) for v in values])


def containing(points: DataFrame, spans: DataFrame, by: list[str], at: str, begin: str, end: str, width: float, values: list[str]) -> DataFrame:
    """Pairs of a point and each span [begin, end] that holds it, by an equi join on buckets of a width.

    Spans are repeated once for each bucket that they touch, so width should be about a usual span's length. Null limits match nothing.
    """
    bucket = lambda c: F.floor(F.col(c) / width)
    spread = spans.filter(F.col(begin) <= F.col(end)).select(*by, begin, end, *values, F.explode(F.sequence(bucket(begin), bucket(end))).alias("_b"))
    return points.withColumn("_b", bucket(at)).join(spread, [*by, "_b"]).filter(F.col(at).between(F.col(begin), F.col(end))).drop("_b")


def fold(df: DataFrame, group: list[str], order: list[str], state: Callable[[], object], step: Callable[[object, dict], tuple[object, bool]], needs: list[str] | None = None) -> DataFrame:
    """The rows of df that a fold keeps: step(state, row) gives the new state and whether the row is kept.

    needs: the columns that step looks at besides the group; only these leave the Arrow batch (all, if not given). Groups are hashed and sorted, and each task streams through its groups with one state at a time, so a group of any size
    takes constant memory. Null group keys make a group of their own.
    """
    names = df.columns
    seen = names if needs is None else [*dict.fromkeys([*group, *needs])]

    def scan(batches):
        now, kept_state = None, state()
        for batch in batches:
            rows, keep = batch.select(seen).to_pylist(), []
            for row in rows:
                key = tuple(row[g] for g in group)
                if key != now:
                    now, kept_state = key, state()
                kept_state, kept = step(kept_state, row)
                keep.append(kept)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.select(*names).repartition(*group).sortWithinPartitions(*group, *order).mapInArrow(scan, df.schema)


def spaced(df: DataFrame, group: list[str], at: str, gap) -> DataFrame:
    """Rows at least gap after the last row kept (not after the last row), the first of each group always; null places are dropped."""
    return fold(df.filter(F.col(at).isNotNull()), group, [at], lambda: None, lambda last, row: (row[at], True) if last is None or row[at] - last >= gap else (last, False), [at])


def counting(df: DataFrame, group: list[str], order: list[str], number: str) -> DataFrame:
    """Rows whose number goes on from the last one accepted: 1 first, then always one more; other rows are passed over."""
    return fold(df.filter(F.col(number).isNotNull()), group, order, lambda: 0, lambda last, row: (row[number], True) if row[number] == last + 1 else (last, False), [number])


def runs(df: DataFrame, group: list[str], order: list[str], key: Column, to: str) -> DataFrame:
    """df with the number of its run: a new run begins where key differs from the row before (nulls are equal)."""
    w = Window.partitionBy(*group).orderBy(*order)
    changed = F.when(F.row_number().over(w) == 1, 1).otherwise((~F.lag(key).over(w).eqNullSafe(key)).cast("int"))
    return df.withColumn("_c", changed).withColumn(to, F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_c")


def groups_of_parts(df: DataFrame, group: list[str], order: list[str], kind: str, label: str, kinds: tuple[str, ...], to: str, mark: str = "（续）") -> DataFrame:
    """The rows of the given kinds with the number of their group: a part marked as continuing belongs to the row before it if that
    has its kind and label, every other part begins a group, and a row of another kind closes the one before."""
    w = Window.partitionBy(*group).orderBy(*order)
    name = F.replace(F.coalesce(label, F.lit("")), F.lit(mark), F.lit(""))
    df = df.withColumns({"_k": F.when(F.col(kind).isin(*kinds), F.col(kind)), "_n": name})
    goes_on = F.coalesce(F.contains(F.col(label), F.lit(mark)) & (F.lag("_k").over(w) == F.col("_k")) & (F.lag("_n").over(w) == F.col("_n")), F.lit(False))
    df = df.withColumn("_c", F.when(F.col("_k").isNotNull() & ~goes_on, 1).otherwise(0))
    return df.withColumn(to, F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).filter("_k is not null").drop("_k", "_n", "_c")


def clipped_end(end: Column, parent_end: Column) -> Column:
    """An end that does not reach beyond its parent's; a null one is the parent's."""
    return F.least(F.coalesce(end, parent_end), parent_end)


def first_parent(points: DataFrame, spans: DataFrame, by: list[str], at: str, begin: str, end: str, key: str, of: str, width: float) -> DataFrame:
    """(of, key): for each point (its key of) the first of the spans that hold it, by where they begin; by buckets of a width, as ``containing``."""
    hold = containing(points.select(*by, of, at), spans, by, at, begin, end, width, [key])
    return hold.groupBy(of).agg(F.min_by(key, F.struct(begin, key)).alias(key))


def changes(df: DataFrame, group: list[str], order: list[str], value: Column) -> DataFrame:
    """The first row of each group and every row whose value differs from the one before."""
    before = F.lag(value).over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_b", before).filter(F.col("_b").isNull() | (F.col("_b") != value)).drop("_b")
