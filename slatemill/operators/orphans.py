"""Orphan references: child keys whose parent row is missing, deleted or later than the reference.

Parents and children are united in one long form, grouped by parent table and key, and the groups without a usable
parent flag are kept. Only the group's totals are shuffled (partial aggregation runs before the exchange), never its rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatemill.plans.cut import cut

#: A key with more than this share of all references is hot. There are at most 1 / HOT_SHARE such keys, so they may be broadcast.
HOT_SHARE = 1 / 1000

CHILD = ("ref_field", "parent_table", "row_id", "ref_key", "ref_time")
PARENT = ("parent_table", "ref_key", "deleted", "key_time")


def trimmed_key(key: Column) -> Column:
    """The key without outer blanks; null if nothing remains (a blank key is no reference)."""
    bare = F.regexp_replace(key, r"(?U)^\s+|\s+$", "")
    return F.when(bare != "", bare)


def key_status(children: DataFrame, parents: DataFrame) -> DataFrame:
    """One row for each referenced key: has_parent, deleted, key_time (of its first row), first_ref and n references."""
    tagged = parents.select(
        "parent_table", "ref_key", F.lit(True).alias("is_parent"), F.coalesce("deleted", F.lit(False)).alias("deleted"), "key_time", F.lit(None).cast("timestamp_ntz").alias("ref_time"), F.lit(0).cast("long").alias("n")
    ).unionByName(
        children.select("parent_table", "ref_key", F.lit(False).alias("is_parent"), F.lit(False).alias("deleted"), F.lit(None).cast("timestamp_ntz").alias("key_time"), "ref_time", F.lit(1).cast("long").alias("n"))
    )
    return (
        tagged.filter(F.col("ref_key").isNotNull())
        .groupBy("parent_table", "ref_key")
        .agg(F.max("is_parent").alias("has_parent"), F.max("deleted").alias("deleted"), F.min("key_time").alias("key_time"), F.min("ref_time").alias("first_ref"), F.sum("n").alias("n"))
        .filter("n > 0")
    )


def orphan_references(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Rows (ref_field, row_id, ref_key, reason, period) of references without a parent, each once.

    children: columns CHILD; parents: columns PARENT, any number of rows a key. Further columns are ignored. reason is the
    first that holds of missing, deleted (some row of the key is deleted), late (the key's first row came after the
    referring time); period is the referring month, yyyy-MM, null if the time is null (such a reference is never late).
    Null or blank keys are no references; keys are compared without outer blanks. Empty inputs give no rows.
    """
    children = children.select(*CHILD).withColumn("ref_key", trimmed_key(F.col("ref_key"))).filter(F.col("ref_key").isNotNull())
    parents = parents.select(*PARENT).withColumn("ref_key", trimmed_key(F.col("ref_key")))
    status = cut(key_status(children, parents).select("parent_table", "ref_key", "has_parent", "deleted", "key_time", "first_ref", "n"))
    total = status.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") > max(1.0, total * HOT_SHARE)
    suspect = (~F.col("has_parent")) | F.col("deleted") | (F.col("key_time") > F.col("first_ref"))
    facts = ("parent_table", "ref_key", "has_parent", "deleted", "key_time")
    hot = F.broadcast(status.filter(is_hot).select(*facts, suspect.alias("suspect")))
    cold = status.filter(suspect & ~is_hot).select(*facts)
    of_hot = children.join(hot, ["parent_table", "ref_key"]).filter("suspect").drop("suspect")
    of_cold = children.join(hot.select("parent_table", "ref_key"), ["parent_table", "ref_key"], "left_anti").join(cold, ["parent_table", "ref_key"])
    reason = F.when(~F.col("has_parent"), "missing").when(F.col("deleted"), "deleted").when(F.col("key_time") > F.col("ref_time"), "late")
    return (
        of_hot.unionByName(of_cold)
        .select("ref_field", "row_id", "ref_key", reason.alias("reason"), F.date_format("ref_time", "yyyy-MM").alias("period"))
        .filter(F.col("reason").isNotNull())
        .distinct()
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Counts of orphan references by field, reason and month."""
    return orphans.groupBy("ref_field", "reason", "period").agg(F.count("*").alias("n_refs"), F.count_distinct("ref_key").alias("n_keys"))
