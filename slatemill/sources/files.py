"""File sources: JSON documents with or without a byte order mark, prediction chunks, assignments, small YAML, TSV, page lines."""

import json
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slatemill.functions import text as T


def json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Whole-file JSON documents (an array gives a row an element); a missing path gives no rows, a broken file one row of nulls.

    A schema is required, so nothing is read twice to infer one. A byte order mark is taken off, which the reader itself would not parse.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    kind = schema.simpleString() if isinstance(schema, StructType) else f"struct<{schema}>"
    text = F.regexp_replace("value", r"^\x{feff}", "")
    rows = F.when(F.ltrim(text).startswith("["), F.from_json(text, f"array<{kind}>")).otherwise(F.array(F.from_json(text, kind)))
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.coalesce(rows, F.array(F.lit(None).cast(kind)))).alias("x")).select("x.*")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def prediction_chunks(spark: SparkSession, pattern: str, element: str) -> DataFrame:
    """Rows of chunk files that hold ``{"predictions": [...]}`` or a bare list, with their file and place in it.

    element: DDL of one prediction. Files whose payload is neither are skipped. Sorted by file name, file and pos give the reading order.
    """
    raw = spark.read.text(pattern, wholetext=True).select(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file"), F.regexp_replace("value", r"^\x{feff}", "").alias("value"))
    schema = f"array<struct<{element}>>"
    rows = F.coalesce(F.from_json("value", f"struct<predictions:{schema}>")["predictions"], F.when(F.trim("value").startswith("["), F.from_json("value", schema)))
    return raw.select("file", F.posexplode(rows).alias("pos", "x")).select("file", "pos", "x.*")


def assigned_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """df with ``data``, parsed from scripts of the form ``name = {...};``, without evaluating them."""
    body = F.regexp_replace(F.regexp_replace(F.col(column), r"(?s)^\s*[\w.$]+\s*=\s*", ""), r"(?s);\s*$", "")
    return df.withColumn("data", F.from_json(body, schema))


def small_yaml(text: str) -> dict:
    """A configuration in a subset of YAML: maps by two-blank indents, lists of scalars, quoted and plain scalars, comments."""
    root: dict = {}
    stack: list[tuple[int, object]] = [(-1, root)]
    pending: tuple[dict, str] | None = None
    for raw in text.splitlines():
        line = re.sub(r"(^|\s)#.*$", "", raw).rstrip()
        if not line.strip():
            continue
        depth = (len(line) - len(line.lstrip())) // 2
        while stack[-1][0] >= depth:
            stack.pop()
        body, holder = line.strip(), stack[-1][1]
        if body.startswith("- "):
            if pending and isinstance(pending[0].get(pending[1]), dict) and not pending[0][pending[1]]:
                pending[0][pending[1]] = []
                stack[-1] = (stack[-1][0], pending[0][pending[1]])
                holder = stack[-1][1]
            if not isinstance(holder, list):
                raise ValueError(f"list item outside a list: {raw!r}")
            holder.append(_scalar(body[2:].strip()))
            continue
        key, _, value = body.partition(":")
        key, value = key.strip().strip("'\""), value.strip()
        if value:
            holder[key] = _scalar(value)
        else:
            holder[key] = {}
            pending = (holder, key)
            stack.append((depth, holder[key]))
    return root


def _scalar(value: str):
    if value[:1] in "'\"" and value[-1:] == value[:1] and len(value) > 1:
        return value[1:-1]
    if value in ("true", "false"):
        return value == "true"
    if value in ("null", "~"):
        return None
    try:
        return json.loads(value) if re.fullmatch(r"-?\d+(\.\d+)?", value) else value
    except ValueError:
        return value


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest without header, tab-separated: subject, status, pages=, header=, visual=, path."""
    rows = spark.read.schema("subject string, status string, pages string, header string, visual string, path string").csv(path, sep="\t")
    number = lambda c: F.regexp_extract(c, r"=\s*(\d+)", 1).try_cast("int")
    return rows.select("subject", "status", number("pages").alias("pages"), F.regexp_extract("header", "=(.*)$", 1).alias("header"), F.regexp_extract("visual", "=(.*)$", 1).alias("visual"), "path")


def icon_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A JSON manifest ``{"icons": {key: {...}}}`` or a list of entries, as rows (key, entry)."""
    raw = spark.read.text(path, wholetext=True)
    entries = F.from_json(F.get_json_object("value", "$.icons"), "map<string, string>")
    return raw.select(F.explode(entries).alias("key", "entry"))


def jdbc_table(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16) -> DataFrame:
    """A database table; with a numeric key and its bounds read in parts, else by one connection. Filters and columns are pushed to the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return reader.load()


def retried(call, tries: int = 3, wait: float = 1.6):
    """call() again after a failure, waiting longer each time; the last failure is raised. For clients inside a partition's task."""
    for n in range(1, tries + 1):
        try:
            return call()
        except Exception:
            if n == tries:
                raise
            time.sleep(wait * n)


def text_lines(df: DataFrame, key: list[str], text: str, drop_page_numbers: bool = True) -> DataFrame:
    """One row a line (key, line_no, line): cleaned, blank lines and (if asked) bare page numbers left out, numbers of lines kept."""
    lines = df.select(*key, F.posexplode(F.split(text, "\r?\n")).alias("p", "raw")).select(*key, (F.col("p") + 1).alias("line_no"), T.clean_line("raw").alias("line"))
    return lines.filter((F.col("line") != "") & ~(F.lit(drop_page_numbers) & F.col("line").rlike(r"^\d{1,3}$")))
