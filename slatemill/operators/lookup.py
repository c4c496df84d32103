"""Ordered and strict lookups, and stages that can be taken up again."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.sources.files import exists


def strict_lookup(ids: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """rows of the ids, with the ids' own columns; an id without a row is an error that names some of them."""
    missing = ids.join(rows.select(key), key, "left_anti").select(key).limit(5).collect()
    if missing:
        raise KeyError(f"no row for {[r[0] for r in missing]}")
    return ids.join(rows, key)


def ordered_lookup(lists: DataFrame, items: str, rows: DataFrame, key: str) -> DataFrame:
    """One row for each listed id that has a row, with its ``place`` in the list, from 1; ids without a row are passed over."""
    places = lists.select(*[c for c in lists.columns if c != items], F.posexplode(items).alias("_p", key))
    return places.join(rows, key).withColumn("place", (F.col("_p") + 1).cast("long")).drop("_p")


def in_order(lists: DataFrame, key: str, items: str, rows: DataFrame, on: str, value: str) -> DataFrame:
    """(key, items): for each list the values of the rows that its entries name, in the order of the list, then of the values; lists without any are left out."""
    found = lists.select(key, F.posexplode(items).alias("_p", on)).join(rows.select(on, value), on)
    return found.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", value))), lambda x: x[value]).alias("items"))


def stage(root: str, name: str, part: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table of one stage and part: made and written once, read from its folder ever after.

    The folder counts only with Spark's success mark, so a stage that broke off is made again.
    """
    spark, path = SparkSession.active(), f"{root}/stage={name}/part={part}"
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
