"""Queries over the tables of a data directory, and their SQL twins where SQL can say the same."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatemill.operators.nested import parse_triples, pivot_group, typed_tables
from slatemill.operators.orphans import orphan_references, orphan_report
from slatemill.plans.cut import cut
from slatemill.registry import QUERIES, SQL, query
from slatemill.sources.tables import read, spread


# ---------------------------------------------------------------- problem 3: orphan references


def _references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    def child(df, field, parent, row, key, time):
        return df.select(F.lit(field).alias("ref_field"), F.lit(parent).alias("parent_table"), F.col(row).alias("row_id"), F.col(key).alias("ref_key"), F.col(time).alias("ref_time"))

    def parent(df, table, key, status, time):
        return df.select(F.lit(table).alias("parent_table"), F.col(key).alias("ref_key"), (F.col(status) == "deleted").alias("deleted"), F.col(time).alias("key_time"))

    named = read(spark, d, "predictions", "prediction_id", "final_top3", "created_at").select("prediction_id", "created_at", F.explode(F.array_distinct(F.transform("final_top3", lambda x: x["knowledge_id"]))).alias("knowledge_id"))
    children = (
        child(named, "predictions.knowledge_id", "knowledge_points", "prediction_id", "knowledge_id", "created_at")
        .unionByName(child(read(spark, d, "task_projection", "task_projection_id", "lesson_revision_id", "created_at"), "task_projection.lesson_revision_id", "lesson_revision", "task_projection_id", "lesson_revision_id", "created_at"))
        .unionByName(child(read(spark, d, "lesson", "lesson_id", "published_revision_id", "updated_at"), "lesson.published_revision_id", "lesson_revision", "lesson_id", "published_revision_id", "updated_at"))
    )
    parents = parent(read(spark, d, "knowledge_points", "knowledge_id", "review_status", "loaded_at"), "knowledge_points", "knowledge_id", "review_status", "loaded_at").unionByName(
        parent(read(spark, d, "lesson_revision", "lesson_revision_id", "status", "created_at"), "lesson_revision", "lesson_revision_id", "status", "created_at")
    )
    return children, parents


@query()
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return orphan_references(*_references(spark, d))


@query()
def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(orphan_references(*_references(spark, d)))


_P3 = r"""
WITH refs AS (
  SELECT 'predictions.knowledge_id' AS ref_field, 'k' AS t, prediction_id AS row_id, u.x.knowledge_id AS k, created_at AS ts FROM predictions, unnest(final_top3) AS u(x)
  UNION ALL SELECT 'task_projection.lesson_revision_id', 'r', task_projection_id, lesson_revision_id, created_at FROM task_projection
  UNION ALL SELECT 'lesson.published_revision_id', 'r', lesson_id, published_revision_id, updated_at FROM lesson),
keyed AS (SELECT ref_field, t, row_id, regexp_replace(k, '^[\s\x{3000}]+|[\s\x{3000}]+$', '', 'g') AS ref_key, ts FROM refs),
par AS (
  SELECT 'k' AS t, knowledge_id AS ref_key, bool_or(coalesce(review_status = 'deleted', false)) AS deleted, min(loaded_at) AS since FROM knowledge_points GROUP BY 2
  UNION ALL SELECT 'r', lesson_revision_id, bool_or(coalesce(status = 'deleted', false)), min(created_at) FROM lesson_revision GROUP BY 2),
found AS (
  SELECT DISTINCT ref_field, row_id, c.ref_key, CASE WHEN p.ref_key IS NULL THEN 'missing' WHEN deleted THEN 'deleted' WHEN since > ts THEN 'late' END AS reason, strftime(ts, '%Y-%m') AS period
  FROM keyed c LEFT JOIN par p USING (t, ref_key) WHERE c.ref_key <> '')
"""
SQL["p3_found"] = _P3 + "SELECT * FROM found WHERE reason IS NOT NULL"
SQL["p3_report"] = _P3 + "SELECT ref_field, reason, period, count(*) AS n_refs, count(DISTINCT ref_key) AS n_keys FROM found WHERE reason IS NOT NULL GROUP BY ALL"


# ---------------------------------------------------------------- problem 5: nested records

_NODE = ("order_index", "node_type", "phase", "title", "visibility", "text")
_TASK = ("question_no", "student_stem", "visibility", "answer", "answer_status")
_SPLIT_LEAVES = {"node_id": "node_id", "@key": "entry_key", "parent_id": "parent_ref", "task_id": "task_id", "section_id": "section_ref", "source_pages.student": "student_page", "source_pages.teacher": "teacher_page", "@value": "member"}


def _prediction_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return typed_tables(read(spark, d, "predictions", "prediction_id", "final_top3"), "prediction_id", "final_top3")


def _split_tables(spark: SparkSession, d: str, extra: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The tables node, task and page of lesson_split, each with record_id, own_id, parent_id and the extra leaves.

    Producers nest the same records differently, so a kind is found under several repeated ancestors. A group belongs to the
    kind whose id its instances carry; entries of a map carry it as their key, and which kind they are the map's name tells.
    Ids of nodes and tasks hold within their record.
    """
    leaves = _SPLIT_LEAVES | {k: k for k in extra}
    keep = [*leaves, "student", "teacher"]
    rows = spread(read(spark, d, "lesson_split", "split_id", "nodes", "tasks"))
    parsed = parse_triples(rows, "split_id", "nodes", "nodes", keep).unionByName(parse_triples(rows, "split_id", "tasks", "tasks", keep))
    flat = pivot_group(parsed, leaves)
    in_tasks = F.col("path").rlike(r"(^|\.)(tasks|items)$")
    task_id = F.coalesce("task_id", F.when(in_tasks & F.col("node_id").isNull(), F.col("entry_key")))
    node_id = F.coalesce("node_id", F.when(~in_tasks & F.col("task_id").isNull(), F.col("entry_key")))
    flat = flat.withColumns({"kind": F.when(task_id.isNotNull(), "task").when(node_id.isNotNull(), "node").when(F.col("member").isNotNull(), "page"), "own_id": F.coalesce(task_id, node_id)}).filter("kind is not null")
    owner = flat.filter("kind <> 'page'").select("record_id", F.col("instance").alias("parent"), F.col("own_id").alias("parent_own"), F.col("kind").alias("parent_kind"))
    linked = cut(flat.join(owner, ["record_id", "parent"], "left"))  # three tables are taken from it, and parsing is the costly part
    blank = lambda c: F.when(F.trim(c) != "", F.col(c))
    above = F.when(F.col("parent_kind") == "node", F.col("parent_own"))
    node = linked.filter("kind = 'node'").withColumn("parent_id", F.coalesce(blank("parent_ref"), above, "record_id"))
    task = linked.filter("kind = 'task'").withColumn("parent_id", F.coalesce(blank("section_ref"), above, "record_id"))
    side = F.regexp_extract("path", r"source_pages\.(student|teacher)$", 1)
    page = lambda side, number, of: (side.alias("side"), number.alias("page"), F.concat_ws(":", side, number).alias("own_id"), F.col(of).alias("parent_id"))
    listed = linked.filter("kind = 'page' and parent_kind = 'task'").select("record_id", *page(side, F.col("member"), "parent_own")).filter("side <> ''")
    alone = task.select("record_id", F.explode(F.array(F.struct(F.lit("student").alias("side"), F.col("student_page").alias("page")), F.struct(F.lit("teacher").alias("side"), F.col("teacher_page").alias("page")))).alias("x"), "own_id").filter("x.page is not null")
    return {"node": node, "task": task, "page": listed.unionByName(alone.select("record_id", *page(F.col("x.side"), F.col("x.page"), "own_id")))}


@query()
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    places = F.col("places").cast("array<string>")
    out = None
    for kind, path in (("candidate", "final_top3"), ("evidence", "final_top3.evidence")):
        parent = F.col("record_id") if kind == "candidate" else F.array_join(F.slice(places, 1, F.size("places") - 1), ".")
        rows = _prediction_tables(spark, d)[path].select(F.lit("predictions").alias("src"), "record_id", F.lit(kind).alias("child_kind"), F.array_join(places, ".").alias("child_id"), parent.alias("parent_id"))
        out = rows if out is None else out.unionByName(rows)
    for kind, table in _split_tables(spark, d).items():
        out = out.unionByName(table.select(F.lit("lesson_split").alias("src"), "record_id", F.lit(kind).alias("child_kind"), F.col("own_id").alias("child_id"), "parent_id"))
    return out.distinct()


#: The tree of every split record, by whatever layout: objects with their ids, and the nearest object above that is a node.
_TREE = """
WITH RECURSIVE raw AS (SELECT DISTINCT split_id, 'n' AS src, nodes::JSON AS c FROM lesson_split WHERE nodes IS NOT NULL UNION SELECT DISTINCT split_id, 't', tasks::JSON FROM lesson_split WHERE tasks IS NOT NULL),
once AS (SELECT split_id, src, CASE WHEN json_type(c) = 'VARCHAR' THEN (c ->> '$')::JSON ELSE c END AS c FROM raw), doc AS (SELECT split_id, src, CASE WHEN json_type(c) = 'VARCHAR' THEN (c ->> '$')::JSON ELSE c END AS c FROM once),
tree AS (SELECT split_id, src, t.id, t.parent, CASE WHEN t.type = 'OBJECT' THEN coalesce(t.value ->> 'node_id', CASE WHEN t.value ->> 'node_type' IS NOT NULL THEN t.key END) END AS nid, CASE WHEN t.type = 'OBJECT' THEN t.value ->> 'task_id' END AS tid, CASE WHEN t.type = 'OBJECT' THEN t.value ->> 'parent_id' END AS pid, CASE WHEN t.type = 'OBJECT' THEN t.value ->> 'section_id' END AS sid, CASE WHEN t.type = 'OBJECT' THEN t.value -> 'source_pages' END AS pages, CASE WHEN t.type = 'OBJECT' THEN t.value END AS v FROM doc, json_tree(doc.c) t),
own AS (SELECT * FROM tree WHERE nid IS NOT NULL OR tid IS NOT NULL), up AS (SELECT split_id, src, id AS start, parent AS cur FROM own UNION ALL SELECT up.split_id, up.src, up.start, tree.parent FROM up JOIN tree ON tree.split_id = up.split_id AND tree.src = up.src AND tree.id = up.cur WHERE tree.nid IS NULL),
above AS (SELECT up.split_id, up.src, up.start, tree.nid FROM up JOIN tree ON tree.split_id = up.split_id AND tree.src = up.src AND tree.id = up.cur WHERE tree.nid IS NOT NULL), linked AS (SELECT own.*, above.nid AS anid FROM own LEFT JOIN above ON above.split_id = own.split_id AND above.src = own.src AND above.start = own.id),
sides AS (SELECT split_id, tid, 'student' AS side, pages -> 'student' AS p FROM own WHERE tid IS NOT NULL UNION ALL SELECT split_id, tid, 'teacher', pages -> 'teacher' FROM own WHERE tid IS NOT NULL), page AS (SELECT split_id, tid, side, unnest(CASE WHEN json_type(p) = 'ARRAY' THEN from_json(p, '["VARCHAR"]') ELSE [p ->> '$'] END) AS page FROM sides WHERE p IS NOT NULL AND json_type(p) <> 'NULL')"""
SQL["p5_found"] = _TREE + """, pr AS (SELECT DISTINCT prediction_id, final_top3 AS f FROM predictions WHERE len(final_top3) > 0), ca AS (SELECT prediction_id, unnest(range(1, len(f) + 1)) AS i, f FROM pr), ev AS (SELECT prediction_id, i, unnest(range(1, len(f[i].evidence) + 1)) AS j, f[i].evidence AS e FROM ca WHERE f[i] IS NOT NULL)
SELECT DISTINCT 'predictions' AS src, prediction_id AS record_id, 'candidate' AS child_kind, i::VARCHAR AS child_id, prediction_id AS parent_id FROM ca WHERE f[i] IS NOT NULL UNION ALL SELECT DISTINCT 'predictions', prediction_id, 'evidence', i || '.' || j, i::VARCHAR FROM ev WHERE e[j] IS NOT NULL
UNION ALL SELECT DISTINCT 'lesson_split', split_id, 'node', nid, coalesce(nullif(trim(pid, ' '), ''), anid, split_id) FROM linked WHERE tid IS NULL UNION ALL SELECT DISTINCT 'lesson_split', split_id, 'task', tid, coalesce(nullif(trim(sid, ' '), ''), anid, split_id) FROM linked WHERE tid IS NOT NULL
UNION ALL SELECT DISTINCT 'lesson_split', split_id, 'page', side || ':' || page, tid FROM page WHERE page IS NOT NULL
"""
SQL["p5_pages"] = _TREE + " SELECT DISTINCT split_id AS record_id, tid AS task_id, side, page::INT AS page FROM page WHERE page IS NOT NULL"



@query("""
SELECT DISTINCT prediction_id, i AS position, c.knowledge_id, c.grade, c.lesson_title, c.module, c.min_knowledge_point, c.confidence
FROM (SELECT prediction_id, i::INT AS i, final_top3[i] AS c FROM (SELECT *, unnest(range(1, len(final_top3) + 1)) AS i FROM predictions)) WHERE c IS NOT NULL
""")
def p5_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The candidate table with all its columns, each linked to its prediction."""
    table = _prediction_tables(spark, d)["final_top3"]
    return table.select(F.col("record_id").alias("prediction_id"), F.col("places")[0].alias("position"), *[c for c in table.columns if c not in ("record_id", "places")]).distinct()


@query("""
SELECT DISTINCT prediction_id, i AS position, j AS evidence_no, e.page AS page, e.quote AS quote
FROM (SELECT prediction_id, i, j::INT AS j, ev[j] AS e FROM (SELECT prediction_id, i, ev, unnest(range(1, len(ev) + 1)) AS j FROM (SELECT prediction_id, i::INT AS i, final_top3[i].evidence AS ev FROM (SELECT *, unnest(range(1, len(final_top3) + 1)) AS i FROM predictions)))) WHERE e IS NOT NULL
""")
def p5_evidence(spark: SparkSession, d: str) -> DataFrame:
    """The evidence table with all its columns, each linked to its candidate by prediction and position."""
    table = _prediction_tables(spark, d)["final_top3.evidence"]
    return table.select(F.col("record_id").alias("prediction_id"), F.col("places")[0].alias("position"), F.col("places")[1].alias("evidence_no"), "page", "quote").distinct()


def _whole(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row for each record, own_id and parent_id: of an element given several times the fullest copy, taken as a whole."""
    full = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    row = F.struct(*columns)
    return rows.groupBy("record_id", "own_id", "parent_id").agg(F.max_by(row, F.struct(full, row)).alias("x")).select("record_id", "own_id", "parent_id", "x.*")


def _whole_sql(kind: str, own: str, above: str, columns: tuple[str, ...]) -> str:
    values = ", ".join(f"v ->> '{c}' AS {c}" for c in columns)
    full = " + ".join(f"({c} IS NOT NULL)::INT" for c in columns)
    order = ", ".join(f"{c} DESC NULLS LAST" for c in columns)
    return f"{_TREE}, w AS (SELECT split_id AS record_id, {own} AS {kind}_id, coalesce(nullif(trim({above}, ' '), ''), anid, split_id) AS parent_id, {values} FROM linked WHERE tid IS {'NOT' if kind == 'task' else ''} NULL) SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY record_id, {kind}_id, parent_id ORDER BY {full} DESC, {order}) = 1"


SQL["p5_nodes"] = _whole_sql("node", "nid", "pid", _NODE)
SQL["p5_tasks"] = _whole_sql("task", "tid", "sid", _TASK)


@query()
def p5_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The node table of lesson_split with its scalar columns, each linked to its parent node or record."""
    return _whole(_split_tables(spark, d, _NODE)["node"], _NODE).withColumnRenamed("own_id", "node_id")


@query()
def p5_tasks(spark: SparkSession, d: str) -> DataFrame:
    """The task table of lesson_split with its scalar columns, each linked to its section or record."""
    return _whole(_split_tables(spark, d, _TASK)["task"], _TASK).withColumnRenamed("own_id", "task_id")


@query()
def p5_pages(spark: SparkSession, d: str) -> DataFrame:
    """The source pages of tasks, each linked to its task."""
    return _split_tables(spark, d)["page"].select("record_id", F.col("parent_id").alias("task_id"), "side", F.col("page").cast("int").alias("page")).distinct()


from slatemill import catalog_queries, extract_queries, graph_queries, io_queries, line_queries, quality_queries, store_queries, text_queries  # noqa: E402, F401

__all__ = ["QUERIES", "SQL"]
