"""Lines and anchors on pages: scaling and reading order, furniture by place, gutters, row tails, options, question starts, component kinds."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slatemill.functions import text as T
from slatemill.operators.ordered import containing, spaced

LINE = ("doc_id", "page", "x0", "y0", "x1", "y1", "text")


def reading_order(lines: DataFrame, scale: float = 1.6) -> DataFrame:
    """Lines (LINE, further columns stay) scaled to the picture, with normalized text and ``line_no`` by height, then side, of each page; blank lines are dropped."""
    box = {c: F.col(c) * scale for c in ("x0", "y0", "x1", "y1")}
    rows = lines.withColumns(box | {"text": T.norm("text")}).filter("text <> ''")
    return rows.withColumn("line_no", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("y0", "x0", "text")).cast("long"))


def without_footers(lines: DataFrame, height: float, margin: float = 55.0, near: float = 110.0) -> DataFrame:
    """Lines above the bottom margin, without lone numbers near it."""
    return lines.filter(~(F.col("y0") > height - margin) & ~((F.col("y0") > height - near) & F.trim("text").rlike(r"^\d{1,4}$")))


def without_own_number(lines: DataFrame) -> DataFrame:
    """Lines that are not just the number of the page they stand on; other bare numbers are content."""
    return lines.filter(F.trim("text") != F.col("page").cast("string"))


def left_edges(lines: DataFrame) -> DataFrame:
    """lines with ``left``: where the leftmost line of their page begins."""
    return lines.withColumn("left", F.min("x0").over(Window.partitionBy("doc_id", "page")))


def row_tails(lines: DataFrame, reach: float = 9.0) -> DataFrame:
    """Lines (LINE, line_no) with ``tail``: the texts to the right on the same row, from left to right; empty if none."""
    span = lines.select("doc_id", "page", F.col("line_no").alias("of"), F.col("x1").alias("of_x1"), (F.col("y0") - reach).alias("low"), (F.col("y0") + reach).alias("high"))
    near = containing(lines.select("doc_id", "page", "line_no", "x0", "y0", "text"), span, ["doc_id", "page"], "y0", "low", "high", 4 * reach, ["of", "of_x1"])
    near = near.filter("line_no <> of and x0 >= of_x1 and y0 > low and y0 < high")
    tails = near.groupBy("doc_id", "page", F.col("of").alias("line_no")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "line_no", "text"))), lambda x: x["text"]), "").alias("tail"))
    return lines.join(tails, ["doc_id", "page", "line_no"], "left").withColumn("tail", F.coalesce("tail", F.lit("")))


def question_anchors(lines: DataFrame, gutter: float = 125.0, apart: float = 12.0, least: int = 4) -> DataFrame:
    """Lines that begin a question: a number in the left gutter whose row goes on, at least ``apart`` below the last one kept on the page.

    lines: LINE and line_no. The gutter is measured from each page's own left edge. The number stands alone in ``number``; ``y`` is a little above the line.
    """
    numbered = row_tails(left_edges(lines)).withColumn("number", F.regexp_extract("text", r"^\s*(\d{1,3})\s*[．.、]", 1)).filter("number <> ''").withColumn("rest", F.regexp_replace("text", r"^\s*\d{1,3}\s*[．.、]\s*", ""))
    kept = numbered.filter((F.col("x0") <= F.col("left") + gutter) & (F.length(F.trim(F.concat("rest", "tail"))) >= least))
    starts = kept.select("doc_id", "page", "line_no", F.col("number").cast("int").alias("number"), (F.col("y0") - 12).alias("y"), "text")
    return spaced(starts, ["doc_id", "page"], "y", apart)


def with_options(lines: DataFrame, anchors: DataFrame, below: float = 240.0) -> DataFrame:
    """anchors (doc_id, page, line_no, y) with ``has_options``: lines beginning with A and with B stand within ``below`` under them."""
    options = lines.withColumn("o", F.regexp_extract("text", r"^\s*([AB])\s*[．.、]", 1)).filter("o <> ''").select("doc_id", "page", "y0", "o")
    spans = anchors.select("doc_id", "page", "line_no", "y", (F.col("y") + below).alias("until"))
    found = containing(options, spans, ["doc_id", "page"], "y0", "y", "until", below, ["line_no"]).groupBy("doc_id", "page", "line_no").agg((F.count_distinct("o") == 2).alias("has_options"))
    return anchors.join(found, ["doc_id", "page", "line_no"], "left").withColumn("has_options", F.coalesce("has_options", F.lit(False)))


def scanned(df: DataFrame, group: list[str], order: list[str], state: Callable[[], object], step: Callable[[object, dict], tuple[object, str]], to: str) -> DataFrame:
    """df with a text that an ordered scan gives each row: step(state, row) is the new state and the text. One state at a time is held."""

    def scan(batches):
        now, held = None, state()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                key = tuple(row[g] for g in group)
                if key != now:
                    now, held = key, state()
                held, text = step(held, row)
                out.append(text)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, to])

    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.repartition(*group).sortWithinPartitions(*group, *order).mapInArrow(scan, f"{spec}, {to} string")


def component_kinds(marks: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Kinds of banner marks (doc_id, page, y): course_goal and knowledge on the first page, then example, practice and after_class.

    The document's last mark is after_class unless a checkpoint (doc_id, page) is on its page; a mark high on a checkpoint's page
    begins an example, as does one on such a page after none or practice; all others are practice.
    """
    last = marks.filter("page <> 1").groupBy("doc_id").agg(F.max(F.struct("page", "y")).alias("last"))
    pages = checkpoints.select("doc_id", "page").distinct().withColumn("pointed", F.lit(True))
    rows = marks.join(last, "doc_id", "left").join(pages, ["doc_id", "page"], "left").select("doc_id", "page", "y", F.coalesce("pointed", F.lit(False)).alias("pointed"), F.coalesce((F.col("last.page") == F.col("page")) & (F.col("last.y") == F.col("y")), F.lit(False)).alias("is_last"))

    def step(before, row):
        if row["page"] == 1:
            return before, "course_goal" if row["y"] < 260 else "knowledge"
        if row["is_last"] and not row["pointed"]:
            return "after_class", "after_class"
        kind = "example" if row["pointed"] and (row["y"] < 260 or before in ("", "practice")) else "practice"
        return kind, kind

    return scanned(rows, ["doc_id"], ["page", "y"], lambda: "", step, "kind").select("doc_id", "page", "y", "kind")
