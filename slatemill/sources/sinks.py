"""Sinks: versioned snapshots with a pointer, chunk files, capped history, one folder a sheet."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.operators.ordered import numbered
from slatemill.sources.files import exists


def _text(spark: SparkSession, path: str) -> str | None:
    return spark.read.text(path, wholetext=True).first()[0].strip() if exists(spark, path) else None


def snapshot(tables: dict[str, DataFrame], root: str, expected: str | None = None) -> str:
    """Writes all tables as a new version under root and then moves the pointer to it; gives the version's name.

    Readers see the old version until the pointer moves, in one rename. expected: the version the changes were made on; if
    the pointer has moved since, nothing is changed and an error is raised. Versions are named v and eight digits.
    """
    spark = next(iter(tables.values())).sparkSession
    now = current(spark, root)
    if expected is not None and expected != now:
        raise RuntimeError(f"version {expected} was expected, {now} is current")
    name = f"v{int((now or 'v0')[1:]) + 1:08d}"
    for table, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/{table}.parquet")
    jvm = spark.sparkContext._jvm
    target, fresh = jvm.org.apache.hadoop.fs.Path(f"{root}/CURRENT"), jvm.org.apache.hadoop.fs.Path(f"{root}/CURRENT-{uuid.uuid4().hex}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(fresh, True)
    out.write(bytearray(name.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    kinds[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, target, kinds)
    return name


def current(spark: SparkSession, root: str) -> str | None:
    """Name of the current version, None if there is none yet."""
    return _text(spark, f"{root}/CURRENT")


def read_snapshot(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{current(spark, root)}/{table}.parquet")


def chunked(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """df with ``chunk_no``, from 1, size rows each in the order of the columns."""
    return numbered(df, order).withColumn("chunk_no", F.floor((F.col("row_no") - 1) / size).cast("long") + 1)


def write_chunks(df: DataFrame, order: list[str], size: int, path: str) -> DataFrame:
    """Writes one folder a chunk and gives the manifest (chunk_no, n_rows, path)."""
    parts = chunked(df, order, size).drop("row_no")
    parts.write.mode("overwrite").partitionBy("chunk_no").json(path)
    return parts.groupBy("chunk_no").agg(F.count("*").alias("n_rows")).withColumn("path", F.format_string(f"{path}/chunk_no=%d", F.col("chunk_no")))


def history(old: DataFrame, new: DataFrame, created: str, cap: int = 30) -> DataFrame:
    """The latest cap entries of old and new together: a top-k, not a sort of all."""
    return old.unionByName(new).orderBy(F.desc_nulls_last(created)).limit(cap)


def sheets(tables: dict[str, DataFrame], path: str) -> None:
    """One CSV folder a relation; an empty relation is a header alone."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def write_prediction_chunks(df: DataFrame, file: str, order: list[str], path: str) -> None:
    """One JSON text ``{"predictions": [...]}`` a chunk, its rows in order; a chunk is bounded by its writer."""
    rest = [c for c in df.columns if c != file]
    held = df.groupBy(file).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*rest).alias("x")))), lambda r: r["x"]).alias("predictions"))
    held.select(file, F.to_json(F.struct("predictions")).alias("value")).write.mode("overwrite").partitionBy(file).text(path)


def report_lines(title: str, tables: list[tuple[str, DataFrame, list[str]]]) -> list[str]:
    """A report in Markdown: each small table (already aggregated) under its heading, in the order of its rows."""
    out = [f"# {title}"]
    for heading, df, columns in tables:
        out += ["", f"## {heading}", "", "| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
        out += ["| " + " | ".join("" if r[c] is None else str(r[c]) for c in columns) + " |" for r in df.select(*columns).limit(1000).collect()]
    return out
